import pytest

from isotherm.sources import scratch


def parquet_folders(spark):
    from pathlib import Path

    return {str(p.parent) for p in Path(scratch.shared_folder(spark)).rglob("*.parquet")}


def test_staged_files_stay_and_brief_ones_go(spark):
    before = parquet_folders(spark)
    kept = scratch.staged(spark.range(3), "kept")
    assert kept.count() == 3
    with scratch.briefly_staged(spark.range(5), "brief") as frame:
        assert frame.count() == 5
        assert len(parquet_folders(spark) - before) == 2
    assert len(parquet_folders(spark) - before) == 1
    with pytest.raises(RuntimeError), scratch.briefly_staged(spark.range(5), "brief"):
        raise RuntimeError
    assert len(parquet_folders(spark) - before) == 1


def test_the_shared_folder_is_the_sessions(spark):
    assert scratch.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")


def test_without_a_shared_folder_the_warehouse_is_used():
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://store/tables/"}.get(key, default)

    class Session:
        conf = Conf()

    assert scratch.shared_folder(Session()) == "hdfs://store/tables/_scratch"


def test_a_cleared_block_leaves_lasting_frames_alone(spark):
    from pathlib import Path

    folder = lambda frame: Path(frame.inputFiles()[0].removeprefix("file:")).parent
    outer = scratch.staged(spark.range(3), "outer")
    with scratch.cleared(spark):
        inner = folder(scratch.staged(spark.range(3), "inner"))
        with scratch.cleared(spark):
            nested = folder(scratch.staged(spark.range(3), "nested"))
            kept = scratch.staged(spark.range(5), "kept", lasting=True)
        assert inner.exists() and not nested.exists()
    assert not inner.exists() and outer.count() == 3 and kept.count() == 5

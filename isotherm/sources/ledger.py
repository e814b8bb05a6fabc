"""Which steps of a run are done, so that a run that died goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.sources.readers import table_exists

SCHEMA = "step string, fingerprint string, token string, detail string, finished_at string"


def digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, default=str, sort_keys=True).encode()).hexdigest()


def content_fingerprint(listing: DataFrame) -> str:
    """Of a listing of files (file_path, modified_at): their number and a sum over their names and times.

    Both are aggregates, so a zone of millions of files sends two numbers.
    """
    each = F.xxhash64("file_path", "modified_at").cast("decimal(38,0)")
    found = listing.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(each), F.lit(0)).alias("content")).first()
    return digest(found["n"], found["content"])


@dataclass
class Ledger:
    """A log of finished steps under `path`, one writer at a time.

    A step is described by a fingerprint of what it reads: its settings and the tokens of the steps
    before it. A finished step gets a token of its own, so a step that is done again makes those
    behind it due as well. What a step returns must be small; it is kept with its line.
    """

    spark: SparkSession
    path: str
    after_step: Callable[[str], None] | None = None
    lines: dict[str, dict] = field(default_factory=dict)
    ran: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        if table_exists(self.spark, self.path):
            rows = self.spark.read.schema(SCHEMA).json(self.path)
            latest = rows.groupBy("step").agg(F.max_by(F.struct(*rows.columns), "finished_at").alias("line"))
            # one line for each step of the job
            self.lines = {r["line"]["step"]: r["line"].asDict() for r in latest.collect()}

    def step(
        self,
        name: str,
        inputs: Mapping[str, object],
        action: Callable[[], object],
        present: Callable[[], bool] = lambda: True,
    ) -> object:
        """Run `action` unless this very step is done and its output `present`; returns what it returned."""
        fingerprint = digest(name, dict(inputs))
        done = self.lines.get(name)
        if done and done["fingerprint"] == fingerprint and present():
            return json.loads(done["detail"])
        result = action()
        line = {
            "step": name,
            "fingerprint": fingerprint,
            "token": uuid.uuid4().hex,
            "detail": json.dumps(result),
            "finished_at": datetime.now(timezone.utc).isoformat(timespec="microseconds"),
        }
        self.spark.createDataFrame([line], SCHEMA).coalesce(1).write.mode("append").json(self.path)
        self.lines[name] = line
        self.ran.append(name)
        if self.after_step:
            self.after_step(name)
        return result

    def tokens(self, *steps: str) -> list[str]:
        """Tokens of finished steps, as inputs of a later one."""
        return [self.lines[s]["token"] for s in steps]

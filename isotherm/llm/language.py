"""Language of texts by a linear-chain conditional random field over their words."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.batches import map_pieces, mixed, offsets_of

UNKNOWN = "und"
GRAM_BITS, WORD_BITS = 18, 16
N_FEATURES = (1 << GRAM_BITS) + (1 << WORD_BITS)
_SPACED = bytes(b if chr(b).isalpha() or b >= 0x80 else 32 for b in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")

#: Words that a chunk of the scan holds; entries of the chunks' matrices that are held at once.
CHUNK = 32
CELLS = 1 << 22


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit. The sample is at most `documents` x `words` words."""

    documents: int = 1600
    words: int = 300
    run: int = 30
    sequence: int = 64
    rounds: int = 40
    rate: float = 0.1
    decay: float = 1e-4
    seed: int = 7


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray  # from x to, logarithms


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters; bytes beyond ASCII count as letters."""
    return text.lower().encode().translate(_SPACED).split()


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text)))


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, one after another, and the offsets of each word.

    Two to four bytes in a row of the word between its edge marks (those with a mark are the
    affixes), and the whole word, whose weight makes the lexicon.
    """
    lengths = np.array([len(w) for w in words], np.int64) + 2
    flat = np.frombuffer(b"\x01" + b"\x02\x01".join(words) + b"\x02", np.uint8).astype(np.uint64)
    offsets = offsets_of(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    keys, owners = [], []
    code = flat.copy()
    total = np.zeros(len(flat) + 1, np.uint64)
    place = np.arange(len(flat)) - offsets[:-1][owner]
    np.cumsum(mixed(flat * np.uint64(257) + place.astype(np.uint64)), out=total[1:])
    for n in (2, 3, 4):
        code = code[:-1] * np.uint64(256) + flat[n - 1 :]
        inside = owner[: len(code)] == owner[n - 1 :]
        keys.append((mixed(code[inside] * np.uint64(8) + np.uint64(n)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
        owners.append(owner[: len(code)][inside])
    whole = mixed(total[offsets[1:]] - total[offsets[:-1]])
    keys.append((whole >> np.uint64(64 - WORD_BITS)).astype(np.int64) + (1 << GRAM_BITS))
    owners.append(np.arange(len(words)))
    key, own = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return key[order], offsets_of(np.bincount(own, minlength=len(words)))


def emissions(words: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Summed feature weights of each word, a row of languages each."""
    key, offsets = features(words)
    return np.add.reduceat(weights[key], offsets[:-1], axis=0)


def marginal_sums(emission: np.ndarray, transition: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text the sum over its words of their marginal probabilities, exactly.

    Forward-backward on all texts at once: chunks of words become matrices in parallel, the chunks
    of a text are passed through in order, and the words of all chunks again in parallel. So the
    longest text costs one small step for each of its chunks only.
    """
    k = emission.shape[1]
    out = np.zeros((len(offsets) - 1, k))
    chunks = -(-np.diff(offsets) // CHUNK)
    limit = max(1, CELLS // (k * max(k, CHUNK)))
    first = 0
    while first < len(chunks):
        held = np.cumsum(chunks[first:])
        last = first + max(1, int(np.searchsorted(held, limit, side="right")))
        some = slice(offsets[first], offsets[last])
        out[first:last] = _scanned(emission[some], transition, offsets[first : last + 1] - offsets[first])
        first = last
    return out


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.max(axis=-1, keepdims=True), 1e-300)


def _scanned(emission: np.ndarray, transition: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    k = emission.shape[1]
    lengths = np.diff(offsets)
    chunks = -(-lengths // CHUNK)
    heads = offsets_of(chunks)
    c = int(heads[-1])
    out = np.zeros((len(lengths), k))
    if not c:
        return out
    owner = np.repeat(np.arange(len(lengths)), chunks)
    begin = offsets[owner] + (np.arange(c) - heads[owner]) * CHUNK
    size = np.minimum(CHUNK, offsets[owner + 1] - begin)
    word = np.minimum(begin[:, None] + np.arange(CHUNK)[None, :], len(emission) - 1)
    real = np.arange(CHUNK)[None, :] < size[:, None]
    through = np.broadcast_to(np.eye(k), (c, k, k)).copy()
    for t in range(CHUNK):
        rows = np.flatnonzero(real[:, t])
        step = (through[rows] @ transition) * emission[word[rows, t]][:, None, :]
        through[rows] = step / np.maximum(step.max(axis=(1, 2), keepdims=True), 1e-300)
    enter, leave = np.ones((c, k)), np.ones((c, k))
    for j in range(1, int(chunks.max())):
        now = heads[:-1][chunks > j] + j
        enter[now] = _scaled(np.einsum("ca,cab->cb", enter[now - 1], through[now - 1]))
        now = heads[1:][chunks > j] - j
        leave[now - 1] = _scaled(np.einsum("cab,cb->ca", through[now], leave[now]))
    ahead = np.empty((CHUNK, c, k))
    state = enter
    for t in range(CHUNK):
        step = _scaled((state @ transition) * emission[word[:, t]])
        state = np.where(real[:, t, None], step, state)
        ahead[t] = state
    state, total = leave, np.zeros((c, k))
    for t in range(CHUNK - 1, -1, -1):
        both = ahead[t] * state
        total += both / both.sum(axis=1, keepdims=True) * real[:, t, None]
        step = _scaled((state * emission[word[:, t]]) @ transition.T)
        state = np.where(real[:, t, None], step, state)
    np.add.at(out, owner, total)
    return out


def fit(runs: list[list[bytes]], labels: list[int], languages: list[str], settings: Training) -> Model:
    """Maximize the likelihood of word labels in code-switched sequences.

    The labelled runs are cut into short pieces, shuffled and joined, so that sequences change
    language inside; emissions and transitions are learned together from the exact gradient.
    """
    rng = np.random.default_rng(settings.seed)
    known: dict[bytes, int] = {}
    pieces: list[tuple[np.ndarray, int]] = []
    for words, label in zip(runs, labels):
        ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
        cuts = np.cumsum(rng.integers(1, 2 * settings.run, size=len(ids) // settings.run * 2 + 2))
        pieces += [(p, label) for p in np.split(ids, cuts[cuts < len(ids)]) if len(p)]
    order = rng.permutation(len(pieces))
    stream = np.concatenate([pieces[i][0] for i in order])
    gold = np.concatenate([np.full(len(pieces[i][0]), pieces[i][1]) for i in order])
    n = len(stream) // settings.sequence * settings.sequence
    if not n:
        settings = Training(sequence=len(stream))
        n = len(stream)
    stream, gold = stream[:n].reshape(-1, settings.sequence), gold[:n].reshape(-1, settings.sequence)
    k = len(languages)
    key, offsets = features(list(known))
    used, column = np.unique(key, return_inverse=True)
    by_feature = np.argsort(column, kind="stable")
    bounds = np.flatnonzero(np.r_[True, np.diff(column[by_feature]) > 0])
    owner = np.repeat(np.arange(len(known)), np.diff(offsets))[by_feature]
    weights, transitions = np.zeros((len(used), k), np.float32), np.zeros((k, k))
    truth = np.zeros((len(known), k))
    np.add.at(truth, (stream.ravel(), gold.ravel()), 1)
    moves = np.zeros((k, k))
    np.add.at(moves, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros((k, k)), np.zeros((k, k))]
    for step in range(1, settings.rounds + 1):
        emission = np.add.reduceat(weights[column], offsets[:-1], axis=0).astype(np.float64)
        emission = np.exp(emission - emission.max(axis=1, keepdims=True))
        expected, passed = _expected(stream, emission, np.exp(transitions), len(known))
        by_word = (truth - expected) / n
        slope = np.add.reduceat(by_word[owner].astype(np.float32), bounds, axis=0)
        slope -= settings.decay * weights / len(used)
        move = (moves - passed) / n - settings.decay * transitions
        for value, grad, i in ((weights, slope, 0), (transitions, move, 2)):
            moments[i] = 0.9 * moments[i] + 0.1 * grad
            moments[i + 1] = 0.99 * moments[i + 1] + 0.01 * grad * grad
            ahead = moments[i] / (1 - 0.9**step)
            value += settings.rate * ahead / (np.sqrt(moments[i + 1] / (1 - 0.99**step)) + 1e-9)
    full = np.zeros((N_FEATURES, k), np.float32)
    full[used] = weights
    return Model(languages, full, transitions)


def _expected(stream: np.ndarray, emission: np.ndarray, transition: np.ndarray, n_words: int):
    """Expected counts of (word, label) and of (label, label) in the sequences."""
    rows, length = stream.shape
    k = emission.shape[1]
    ahead = np.empty((length, rows, k))
    state = np.ones((rows, k))
    for t in range(length):
        state = _scaled((state @ transition) * emission[stream[:, t]])
        ahead[t] = state
    back = np.ones((rows, k))
    marginal = np.empty((rows, length, k))
    passed = np.zeros((k, k))
    for t in range(length - 1, -1, -1):
        both = ahead[t] * back
        marginal[:, t] = both / both.sum(axis=1, keepdims=True)
        seen = emission[stream[:, t]] * back
        if t:
            pair = ahead[t - 1][:, :, None] * transition[None] * seen[:, None, :]
            passed += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = _scaled(seen @ transition.T)
    expected = np.zeros((n_words, k))
    flat = stream.ravel()
    for j in range(k):
        expected[:, j] = np.bincount(flat, weights=marginal[:, :, j].ravel(), minlength=n_words)
    return expected, passed


def sample_runs(labelled: DataFrame, settings: Training) -> tuple[list[list[bytes]], list[str]]:
    """A bounded sample: equal numbers of documents for each language, a run of words from each.

    Documents are drawn by a hash of their id, runs by a hash too; only the runs leave the tasks.
    """
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return [], []
    each = max(1, settings.documents // len(counts))
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 20)) / float(1 << 20)
    drawn = labelled.where(draw < F.element_at(share, F.col("lang")))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = []
        for number, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            spare = len(words) - settings.words
            at = int(mixed(np.array([number]))[0] % np.uint64(spare + 1)) if spare > 0 else 0
            runs.append(b" ".join(words[at : at + settings.words]))
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "run": pa.array(runs, pa.binary())}
        )

    rows = map_pieces(drawn.select("doc_id", "lang", "text"), "text", step, "doc_id bigint, lang string, run binary")
    kept = sorted(rows.limit(2 * settings.documents).collect(), key=lambda r: (r["doc_id"], r["lang"], r["run"]))
    kept = [r for r in kept if r["run"]]
    return [bytes(r["run"]).split() for r in kept], [r["lang"] for r in kept]


def train(labelled: DataFrame, settings: Training = Training()) -> Model | None:
    """Fit on rows (doc_id, text, lang) without nulls; None if there is nothing to learn from."""
    runs, labels = sample_runs(labelled, settings)
    languages = sorted(set(labels))
    if not languages:
        return None
    place = {lang: i for i, lang in enumerate(languages)}
    return fit(runs, [place[x] for x in labels], languages, settings)


def predicted(texts: list[str | None], model: Model | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the largest share of the words' marginal probabilities."""
    rows = [words_of(t) if has_letter(t) else [] for t in texts]
    lengths = np.array([len(r) for r in rows], np.int64)
    if model is None or not lengths.sum():
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for row in rows for w in row], np.int64)
    emission = emissions(list(known), model.weights).astype(np.float64)
    emission = np.exp(emission - emission.max(axis=1, keepdims=True))[ids]
    totals = marginal_sums(emission, np.exp(model.transitions), offsets_of(lengths))
    best = totals.argmax(axis=1)
    score = np.where(lengths > 0, totals[np.arange(len(best)), best] / np.maximum(lengths, 1), 0.0)
    names = [model.languages[b] if n else UNKNOWN for b, n in zip(best, lengths)]
    return names, np.clip(score, 0.0, 1.0)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def identify(documents: DataFrame, settings: Training = Training()) -> DataFrame:
    """doc_id, held_out, lang_pred and score for each row of `documents`.

    The model learns from a bounded sample (`Training`) of rows with text, lang and doc_id outside
    the held-out fold; only the text enters a prediction. Null text, or text without a letter: `und`
    with score 0. Very long texts are labelled whole. Repeated rows are predicted each. Without any
    row to learn from, all is `und`. Ties go to the language first in code point order.
    """
    labelled = documents.where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("doc_id", "text", "lang")
    return apply(documents, train(labelled, settings))


def apply(documents: DataFrame, model: Model | None) -> DataFrame:
    """Predictions of a model, whose size is bounded by features x languages, for each row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = predicted(batch.column("text").to_pylist(), shared.value)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(score),
            }
        )

    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_pieces(rows, "text", step, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_identified(documents: DataFrame, least: float = 0.4, settings: Training = Training()) -> DataFrame:
    """The rows whose language is found with a score of at least `least`, with all their columns.

    `lang` becomes the language found. Rows without a letter, or without a clear language, go. The
    model learns as in `identify`; if there is nothing to learn from, no row is rejected and `lang`
    stays as it is.
    """
    labelled = documents.where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("doc_id", "text", "lang")
    model = train(labelled, settings)
    if model is None:
        return documents
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = predicted(batch.column("text").to_pylist(), shared.value)
        columns = dict(zip(batch.schema.names, batch.columns))
        columns["lang"] = pa.array(names, pa.string())
        keep = (np.array(names) != UNKNOWN) & (score >= least) if names else np.zeros(0, bool)
        return pa.RecordBatch.from_pydict(columns).filter(pa.array(keep, pa.bool_()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return map_pieces(documents, "text", step, fields)

"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on pieces of good and one on pieces of bad labelled text.
A text is compressed piece by piece with each; its compressed sizes under the two, their difference
over their sum, and its length are the inputs of a logistic calibration that is fitted on labelled
rows which the dictionaries have not seen. Nothing but the text decides a score.

Fitting uses a bounded sample of the labelled rows: for each label the `ROWS_PER_CLASS` rows whose
ids have the smallest digests, half for the dictionaries (`PIECES_PER_ROW` pieces spread evenly over
the text) and half for the calibration. Only these pieces and four numbers a row reach the driver.
Scoring covers whole texts of all rows in one pass without a shuffle.

Cases: null and empty texts are scored as texts of length 0; an id with several labels counts as bad
if one of them says so; null ids and null labels are not learnt from; without at least
`LEAST_PER_CLASS` rows of either label in both halves nothing can be learnt, and every score is 1, so
that no document is lost; repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalake.llm.hashing import utf8
from zonalake.session import settle

ROWS_PER_CLASS = 4_000
PIECES_PER_ROW = 4
PIECE = 2_048
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
LEAST_PER_CLASS = 4
ACCEPT = 0.7
HELD_OUT = 2
#: Bytes of a compressed piece that do not depend on it.
FRAME = 3


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)] or [b""]


class Compressors:
    """Compressed sizes of texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.pair = []
        for content in (good, bad):
            known = zstandard.ZstdCompressionDict(content)
            known.precompute_compress(level=LEVEL)
            self.pair.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False,
                    write_dict_id=False,
                )
            )

    def measures(self, text: bytes) -> tuple[float, float, float]:
        """(difference over sum, size under good per byte, log of length)."""
        parts = pieces(text)
        good, bad = (
            sum(len(c.compress(p)) for p in parts) - FRAME * len(parts) for c in self.pair
        )
        n = max(1, len(text))
        return (bad - good) / max(1, bad + good), good / n, float(np.log(n))


@lru_cache(maxsize=2)
def compressors(good: bytes, bad: bytes) -> Compressors:
    return Compressors(good, bad)


def _terms(x: np.ndarray) -> np.ndarray:
    d, a, n = np.clip(x[:, 0], -0.3, 0.3) * 10, np.clip(x[:, 1], 0, 1) * 4 - 1, (x[:, 2] - 7) / 2
    one = np.ones_like(d)
    return np.stack([one, d, a, n, d * d, a * a, n * n, d * a, d * n, a * n, d**3, a**3], 1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Newton's method with a small ridge, each step halved until the loss falls."""
    terms, weights = _terms(x), np.zeros(12)

    def loss(w: np.ndarray) -> float:
        z = terms @ w
        return float(np.logaddexp(0, z).sum() - y @ z + ridge * w @ w / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(terms @ weights, -500, 500)))
        slope = terms.T @ (p - y) + ridge * weights
        curve = (terms * (p * (1 - p))[:, None]).T @ terms + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        scale, now = 1.0, loss(weights)
        while scale > 1e-4 and loss(weights - scale * step) > now:
            scale /= 2
        weights = weights - scale * step
    return weights


class Model:
    """Dictionaries and calibration; None for either means that nothing was learnt."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray | None):
        self.good, self.bad, self.weights = good, bad, weights

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(texts))
        both = compressors(self.good, self.bad)
        if not texts:
            return np.zeros(0)
        z = _terms(np.array([both.measures(t) for t in texts])) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _train(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few for training."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 4), samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


def _sampled_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, good, out = batch.column("id").to_pylist(), batch.column("good").to_pylist(), []
        for key, label, text in zip(ids, good, utf8(batch.column("text")), strict=True):
            parts = pieces(text)
            step = max(1, len(parts) // PIECES_PER_ROW)
            out += [(key, label, i, p) for i, p in enumerate(parts[::step][:PIECES_PER_ROW])]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        columns = zip(*out, strict=True) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["id", "good", "place", "piece"],
        )


def _measured(good: bytes, bad: bytes):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = compressors(good, bad)
        for batch in batches:
            found = [both.measures(t) for t in utf8(batch.column("text"))]
            columns = zip(*found, strict=True) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("good"), *(pa.array(c, pa.float64()) for c in columns)],
                names=["id", "good", "d", "a", "n"],
            )

    return measure


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows outside the held-out fold."""
    key = F.col("doc_id").cast("long")
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    usable = usable.where(fold(F.col("doc_id")) != HELD_OUT)
    usable = usable.groupBy(key.alias("id")).agg(F.min("quality").cast("int").alias("good"))
    digest = F.xxhash64(F.col("id"), F.lit("quality"))
    chosen = None
    for label in (0, 1):
        best = usable.where(F.col("good") == label).orderBy(digest, "id").limit(ROWS_PER_CLASS)
        chosen = best if chosen is None else chosen.unionByName(best)
    chosen = settle(chosen.withColumn("half", F.pmod(digest, F.lit(2))), "quality-sample")
    # At most 2 * ROWS_PER_CLASS ids go out; of the rows of an id that with the smallest hash learns.
    texts = docs.select(key.alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    texts = texts.join(F.broadcast(chosen), "id").groupBy("id", "good", "half").agg(first)
    texts = texts.select("id", "good", "half", "first.text")
    texts = settle(texts, "quality-texts")

    for_dictionaries = texts.where(F.col("half") == 0).select("id", "good", "text")
    kinds = "id bigint, good int, place int, piece binary"
    rows = sorted(for_dictionaries.mapInArrow(_sampled_pieces, kinds).collect())
    samples = {label: [bytes(r["piece"]) for r in rows if r["good"] == label] for label in (0, 1)}
    counts = {label: len({r["id"] for r in rows if r["good"] == label}) for label in (0, 1)}
    if min(counts.values()) < LEAST_PER_CLASS:
        return Model(b"", b"", None)
    good, bad = _train(samples[1]), _train(samples[0])

    for_calibration = texts.where(F.col("half") == 1).select("id", "good", "text")
    kinds = "id bigint, good int, d double, a double, n double"
    rows = sorted(for_calibration.mapInArrow(_measured(good, bad), kinds).collect())
    x = np.array([[r["d"], r["a"], r["n"]] for r in rows]).reshape(-1, 3)
    y = np.array([r["good"] for r in rows], dtype=float)
    if min(y.sum(), len(y) - y.sum()) < LEAST_PER_CLASS:
        return Model(b"", b"", None)
    return Model(good, bad, fit_logistic(x, y))


def score_rows(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.scores(utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(values, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    scored = slim.mapInArrow(score, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_rows(docs, fit(docs, labels))


def accepted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` whose predicted label is 1, with all columns."""
    model = fit(docs, labels)

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array(model.scores(texts) >= ACCEPT, pa.bool_()))

    return docs.mapInArrow(accept, docs.schema)

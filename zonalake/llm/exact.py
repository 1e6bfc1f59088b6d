"""Exact de-duplication by an extendible-hash index on shared files.

Texts are equal when identical after deleting every character of `[\\x20\\x09-\\x0D]`.

1. `entries`: each task merges equal texts of its split, comparing bytes, and writes one entry per
   text: hash, bytes, number of rows and the row to keep. A text with a third of all rows becomes
   one entry per task.
2. `directory`: buckets are prefixes of the hash. A bucket above the capacity is split by one more
   bit, again and again; bytes are added up in Spark and each round looks at overfull buckets only. A
   bucket of a single hash cannot be split and stays whole.
3. `build_index`: each bucket's entries go to one owner in order of hash. It reads them as a stream,
   chains those of equal hash, compares bytes, and writes one record per distinct text.
4. `keep_flags`: every row looks its group up in the index by hash and digest.

Cases: a null text counts as empty, empty texts are equal to one another; a null id sorts before
all others, so among rows of equal length it is kept; repeated rows are rows of the same group, each
with its own line in the result (all rows with the kept id and text are kept); an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalake.session import settle

SPACES = " \t\n\x0b\x0c\r"
#: Bytes of entries that a bucket may hold before it is split.
CAPACITY = 64 << 20
#: Bytes of distinct texts that a task of `entries` holds before it hands them on.
TASK_BYTES = 48 << 20
NO_ID = -(2**63)

ENTRY = "hash bigint, sha256 string, norm binary, n_rows bigint, n_cp bigint, keep bigint"
RECORD = "hash bigint, sha256 string, keep bigint, group_size bigint"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _keyed(docs: DataFrame) -> DataFrame:
    norm = normalised(F.col("text"))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(norm).alias("hash"),
        norm.cast("binary").alias("norm"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_cp"),
    )


def _better(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    """Of two (code points, id): the longer, then the smaller id."""
    return a if (-a[0], a[1]) <= (-b[0], b[1]) else b


def _entry_batch(groups: dict[bytes, list]) -> pa.RecordBatch:
    norms = list(groups)
    values = list(groups.values())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([v[0] for v in values], pa.int64()),
            pa.array([hashlib.sha256(n).hexdigest() for n in norms]),
            pa.array(norms, pa.binary()),
            pa.array([v[1] for v in values], pa.int64()),
            pa.array([v[2][0] for v in values], pa.int64()),
            pa.array([v[2][1] for v in values], pa.int64()),
        ],
        names=["hash", "sha256", "norm", "n_rows", "n_cp", "keep"],
    )


def _merge_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[bytes, list] = {}
    held = 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("id", "hash", "norm", "n_cp"))
        for key, hashed, norm, n_cp in zip(*columns, strict=True):
            group = groups.get(norm)
            if group is None:
                groups[norm] = [hashed, 1, (n_cp, key)]
                held += len(norm) + 200
            else:
                group[1] += 1
                group[2] = _better(group[2], (n_cp, key))
        if held > TASK_BYTES:
            yield _entry_batch(groups)
            groups, held = {}, 0
    if groups:
        yield _entry_batch(groups)


def entries(docs: DataFrame) -> DataFrame:
    """One row per distinct text of each split, in the shared folder."""
    return settle(_keyed(docs).mapInArrow(_merge_split, ENTRY), "exact-entries")


def directory(entry_rows: DataFrame, capacity: int = CAPACITY, most_bits: int = 63) -> DataFrame:
    """Rows (bits, prefix): hashes whose first `bits` bits are `prefix` form a bucket.

    The rounds end when no bucket is above `capacity` that more than one hash falls into.
    """
    spark = entry_rows.sparkSession
    sizes = entry_rows.select("hash", (F.length("norm") + 100).alias("size"))
    done: DataFrame | None = None
    bits, over = 0, None
    while True:
        prefix = F.expr(f"shiftrightunsigned(hash, {64 - bits})") if bits else F.lit(0).cast("long")
        rows = sizes
        if over is not None:
            rows = rows.withColumn("parent", F.expr(f"shiftrightunsigned(hash, {65 - bits})")
                                   if bits > 1 else F.lit(0).cast("long"))
            rows = rows.join(over, "parent", "left_semi")
        counted = settle(
            rows.groupBy(prefix.alias("prefix")).agg(
                F.sum("size").alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high")
            ),
            "exact-directory",
        )
        full = (F.col("size") > capacity) & (F.col("low") < F.col("high"))
        full = full if bits < most_bits else F.lit(False)
        fits = counted.where(~full).select(F.lit(bits).alias("bits"), "prefix")
        done = fits if done is None else done.unionByName(fits)
        over = counted.where(full).select(F.col("prefix").alias("parent"))
        if over.isEmpty():
            return settle(done, "exact-directory") if bits else spark.createDataFrame(
                [(0, 0)], "bits int, prefix long"
            )
        bits += 1


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the chains of equal hash in a stream sorted by hash; holds one chain at a time."""
    chain: dict[bytes, list] = {}
    current = None
    out: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["hash", "sha256", "keep", "group_size"],
        )

    def close() -> None:
        out.extend((current, sha, best[1], n) for sha, n, best in chain.values())

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("hash", "sha256", "norm", "n_rows", "n_cp", "keep"))
        for hashed, sha, norm, n, n_cp, keep in zip(*columns, strict=True):
            if hashed != current:
                close()
                chain, current = {}, hashed
            link = chain.get(norm)  # compares bytes
            if link is None:
                chain[norm] = [sha, n, (n_cp, keep)]
            else:
                link[1] += n
                link[2] = _better(link[2], (n_cp, keep))
        if len(out) >= 10_000:
            yield batch_of(out)
            out.clear()
    close()
    if out:
        yield batch_of(out)


def build_index(entry_rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """One record per distinct text, in shared files by owner."""
    depths = [r["bits"] for r in buckets.select("bits").distinct().collect()]  # at most 64 numbers
    owner = None
    for bits in depths:
        here = F.expr(f"shiftrightunsigned(hash, {64 - bits})") if bits else F.lit(0).cast("long")
        pair = F.struct(F.lit(bits).alias("bits"), here.alias("prefix"))
        owner = F.array(pair) if owner is None else F.concat(owner, F.array(pair))
    slim = entry_rows.select("hash").distinct().withColumn("at", F.explode(owner))
    slim = slim.select("hash", F.col("at.bits").alias("bits"), F.col("at.prefix").alias("prefix"))
    owned = slim.join(buckets, ["bits", "prefix"], "left_semi")
    owned = owned.select("hash", F.xxhash64("bits", "prefix").alias("bucket"))
    placed = entry_rows.join(owned, "hash") if len(depths) > 1 else entry_rows.withColumn(
        "bucket", F.xxhash64(owner.getItem(0)["bits"], owner.getItem(0)["prefix"])
    )
    chained = placed.repartition("bucket").sortWithinPartitions("bucket", "hash").select(
        "hash", "sha256", "norm", "n_rows", "n_cp", "keep"
    )
    return settle(chained.mapInArrow(_own, RECORD), "exact-index")


def keep_flags(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    entry_rows = entries(docs)
    index = build_index(entry_rows, directory(entry_rows, capacity))
    norm = normalised(F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(norm).alias("hash"),
        F.sha2(norm.cast("binary"), 256).alias("sha256"),
    )
    keep_id = F.when(F.col("keep") != NO_ID, F.col("keep"))
    return rows.join(index, ["hash", "sha256"]).select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


REPORT_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_cp DESC, doc_id NULLS FIRST) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g"""

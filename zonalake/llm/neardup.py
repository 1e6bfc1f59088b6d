"""Near-duplicate documents by MinHash bands and odd sketches, confirmed on full shingle sets.

1. `signatures`: per row the size and a 128-bit digest of its set of distinct 5-word shingles, `BANDS`
   keys of `BAND_ROWS` MinHash values each, and an odd sketch: all samples toggle a bit each of a
   bitmap, so that for similar sets the XOR of two bitmaps has few bits, and the number of bits gives
   the similarity precisely where it is high.
2. Rows with equal sets form a class. The smallest id stands for it, so copies cost one row each.
3. Star rounds: in every band bucket all members are compared with one of them, which is linear in the
   bucket; later rounds take another centre and only members that are not yet connected with it.
4. Pairs of the same bucket that are still not connected are compared inside joins: sizes and sketches
   first, which gives the rows that have a likely partner at all; then those with their full sets, each
   pair in the first bucket it shares. Only links come out of it, so a group of texts that are all
   somewhat below the similarity makes no rows. A large bucket is a grid of blocks of `BLOCK` members.
5. A pair is a link if 100 * intersection >= 75 * union on the full sets. Components follow from
   the links by star steps.

A pair with similarity 0.75 shares no bucket with a probability of (1 - 0.75^4)^32 = 5e-6, and a
sketch rejects it only if it is almost five standard deviations off. Everything else is exact.

Cases: null texts and texts without words have an empty set and are linked with nothing; rows with
equal id are one document, whose links are those of all its rows; a null id counts as the smallest;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalake.llm.components import components
from zonalake.llm.files import settled_alone, written
from zonalake.llm.hashing import U64, mixed, shingles, utf8
from zonalake.llm.wordcodes import groups
from zonalake.session import settle, work_path, work_scope

BANDS, BAND_ROWS = 32, 4
SAMPLES = BANDS * BAND_ROWS
SKETCH_WORDS = 16
SKETCH_BITS = 64 * SKETCH_WORDS
PERCENT = 75
#: Odd sketches must put the similarity at this at least.
LEAST_ESTIMATE = 0.55
#: Star rounds before the remaining pairs are compared.
STAR_ROUNDS = 2
#: Members of a bucket that meet the others of it in one task; a larger bucket is compared by several.
BLOCK = 1000
NO_ID = -(2**63)

_rng = np.random.default_rng(11)
_MULTIPLIERS = _rng.integers(0, 2**63, SAMPLES, dtype=U64) * U64(2) + U64(1)
_SALTS = _rng.integers(0, 2**63, SAMPLES, dtype=U64)
_SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]
SIGNATURE = (
    "id bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>, "
    + ", ".join(f"{c} bigint" for c in _SKETCH)
)


def most_differing_bits(least: float = LEAST_ESTIMATE) -> int:
    """Bits in which the sketches of two sets of similarity `least` differ on average."""
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * SAMPLES * (1 - least))))


def minhashes(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SAMPLES minima for each text; texts begin at `starts` and have a shingle at least."""
    out = np.empty((len(starts), SAMPLES), dtype=U64)
    for k, multiplier in enumerate(_MULTIPLIERS):
        out[:, k] = np.minimum.reduceat(hashes * multiplier, starts)
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    rows = mixed(minima + _SALTS).reshape(len(minima), BANDS, BAND_ROWS)
    return mixed((rows * _MULTIPLIERS[:BAND_ROWS]).sum(axis=2, dtype=U64) + np.arange(BANDS, dtype=U64))


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Bit b of a sketch is the parity of the samples that fall on b."""
    at = (mixed(mixed(minima) ^ _SALTS) % U64(SKETCH_BITS)).astype(np.int64)
    flat = (np.arange(len(minima))[:, None] * SKETCH_BITS + at).ravel()
    parity = np.bincount(flat, minlength=len(minima) * SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(parity.reshape(len(minima), SKETCH_BITS), axis=1, bitorder="little").view("<u8")


def distinct_shingles(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    for _, group in shingles(texts):
        for a, b in zip(group.bounds, group.bounds[1:], strict=False):
            yield np.unique(group.hashes[a:b])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in groups(whole)):
        ids, texts = batch.column("id"), utf8(batch.column("text"))
        for begin, group in shingles(texts):
            sets = [np.unique(group.hashes[a:b]) for a, b in zip(group.bounds, group.bounds[1:], strict=False)]
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            m, filled = len(sets), np.flatnonzero(sizes)
            digests = np.zeros((2, m), dtype=U64)
            bands = np.zeros((m, BANDS), dtype=U64)
            sketches = np.zeros((m, SKETCH_WORDS), dtype=U64)
            if len(filled):
                hashes = np.concatenate([sets[i] for i in filled])
                starts = np.cumsum(sizes[filled]) - sizes[filled]
                for i in (0, 1):
                    digests[i, filled] = np.add.reduceat(mixed(hashes ^ _SALTS[i]), starts)
                minima = minhashes(hashes, starts)
                bands[filled], sketches[filled] = band_keys(minima), odd_sketches(minima)
            keys = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(np.where(sizes > 0, BANDS, 0)))), pa.int32()),
                pa.array(bands[sizes > 0].ravel().view(np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(begin, m), pa.array(sizes), *(pa.array(d.view(np.int64)) for d in digests),
                    keys, *(pa.array(np.ascontiguousarray(s).view(np.int64)) for s in sketches.T),
                ],
                names=["id", "n", "set_a", "set_b", "bands", *_SKETCH],
            )


def _numbered(docs: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(key.alias("id"), F.col("text").cast("string").alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    return settle(_numbered(docs).mapInArrow(_sign, SIGNATURE), "near-signatures")


def _likely(left: str, right: str) -> Column:
    """Sizes and sketches allow a link."""
    a, b = (lambda c: F.col(f"{left}.{c}")), (lambda c: F.col(f"{right}.{c}"))
    differing = sum(
        (F.bit_count(a(c).bitwiseXOR(b(c))) for c in _SKETCH), start=F.lit(0)
    )
    sizes = F.least(a("n"), b("n")) * 100 >= F.greatest(a("n"), b("n")) * PERCENT
    return sizes & (differing <= most_differing_bits())


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in groups(whole)):
        texts, at = utf8(batch.column("text")), 0
        for begin in range(0, len(texts), 256):
            sets = list(distinct_shingles(texts[begin : begin + 256]))
            sizes = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
            values = np.concatenate(sets) if sets else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(at, len(sets)),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values.view(np.int64))),
                ],
                names=["node", "shingles"],
            )
            at += len(sets)


def shingle_sets(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles): the full sets of the documents in `nodes`, which has the column id."""
    needed = settle(nodes.distinct(), "near-needed")
    texts = _numbered(docs).join(needed, "id", "left_semi").dropDuplicates(["id", "text"])
    return settle(texts.mapInArrow(_shingle_sets, "node bigint, shingles array<bigint>"), "near-sets")


def _is_link(left: Column, right: Column) -> Column:
    shared = F.size(F.array_intersect(left, right))
    return shared * (100 + PERCENT) >= (F.size(left) + F.size(right)) * PERCENT


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links on their full sets."""
    sets = shingle_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs)
    left = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    both = pairs.join(left, "b").join(right, "a")
    return both.where(_is_link(F.col("set_a"), F.col("set_b"))).select("a", "b")


def _stars(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of a bucket's centre and its members in other components."""
    order = F.col("node") if turn == 0 else F.xxhash64("node", "key", F.lit(turn))
    centres = members.groupBy("key").agg(
        F.min_by("node", order).alias("centre"), F.min_by("component", order).alias("other"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    )
    centres = centres.where(F.col("low") < F.col("high")).select("key", "centre", "other")
    pairs = members.join(centres, "key").where(F.col("component") != F.col("other"))
    return pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _filtered(pairs: DataFrame, known: DataFrame) -> DataFrame:
    return (
        pairs.join(known.alias("x"), F.col("x.node") == pairs["a"])
        .join(known.alias("y"), F.col("y.node") == pairs["b"])
        .where(_likely("x", "y"))
        .select(pairs["a"], pairs["b"])
    )


def _placed(members: DataFrame, joined: DataFrame) -> DataFrame:
    return members.join(joined, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )


def _grid(members: DataFrame) -> DataFrame:
    """Members of buckets in the cells of their bucket's grid, (key, i, j) with i <= j; `mine` is i or j.

    Members of blocks i and j meet in cell (i, j), members of one block in (i, i).
    """
    blocks = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")
    spread = members.join(blocks, "key").withColumn("mine", mine)
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    return spread.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")}).drop("other")


def _meet(x: str, y: str) -> Column:
    """Rows of a cell that are compared there, from different components."""
    a, b = (lambda c: F.col(f"{x}.{c}")), (lambda c: F.col(f"{y}.{c}"))
    cell = (a("key") == b("key")) & (a("i") == b("i")) & (a("j") == b("j"))
    return cell & ((a("i") == a("j")) | (a("mine") != b("mine"))) & (a("component") != b("component"))


def _links_left(placed: DataFrame, known: DataFrame, bands: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) of members that share a bucket and lie in different components."""
    open_keys = placed.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q"))
    open_keys = open_keys.where(F.col("p") < F.col("q")).select("key")
    members = settle(placed.join(open_keys, "key"), "near-open")
    cells = _grid(members.join(known, "node"))
    some = cells.alias("x").join(cells.alias("y"), _meet("x", "y") & _likely("x", "y"), "left_semi")
    likely = settle(some.select("node").distinct(), "near-likely")

    sets = shingle_sets(likely.select(F.col("node").alias("id")), docs)
    whole = members.join(likely, "node", "left_semi").join(known, "node").join(bands, "node").join(sets, "node")
    cells = _grid(whole)
    apart = _meet("x", "y") & (F.col("x.node") < F.col("y.node")) & _likely("x", "y")
    apart &= F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.key")
    apart &= _is_link(F.col("x.shingles"), F.col("y.shingles"))
    found = cells.alias("x").join(cells.alias("y"), apart)
    return found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _components(docs: DataFrame) -> DataFrame:
    """Per row: id, n and its component."""
    spark = docs.sparkSession
    content = ["n", "set_a", "set_b"]
    places = [work_path(spark, label) for label in ("near-rows", "near-leaders")]
    with work_scope(spark):
        signed = signatures(docs)
        classes = signed.where(F.col("n") > 0).groupBy(*content).agg(F.min("id").alias("node"))
        rows = signed.select("id", *content).join(classes, content, "left")
        rows = written(rows.select("id", "n", "node"), places[0])
        leaders = signed.join(classes.select(F.col("node").alias("id"), *content), ["id", *content])
        leaders = leaders.dropDuplicates(["id", *content]).withColumnRenamed("id", "node")
        leaders = written(leaders, places[1])

    bucketed = leaders.select("node", F.explode("bands").alias("key"))
    buckets = bucketed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    buckets = buckets.where(F.col("low") < F.col("high")).select("key")
    members = settle(bucketed.join(buckets, "key"), "near-buckets")
    known = leaders.drop("bands", "set_a", "set_b")

    placed = members.withColumn("component", F.col("node"))
    tried = links = joined = None
    for turn in range(STAR_ROUNDS):
        pairs = _filtered(_stars(placed, turn), known)
        pairs = settle(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "near-pairs")
        found = settled_alone(spark, "near-links", lambda pairs=pairs: confirmed(pairs, docs))
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        joined = settled_alone(spark, "near-components", lambda links=links: components(links))
        placed = _placed(members, joined)

    bands = leaders.select("node", "bands")
    last = settled_alone(spark, "near-links", lambda: _links_left(placed, known, bands, docs))
    # Rows of one id are one document, so the classes that it stands in belong together.
    shared = rows.groupBy(F.col("id").alias("own")).agg(F.min("node").alias("a"), F.max("node").alias("top"))
    shared = shared.where(F.col("a") < F.col("top")).join(rows, F.col("own") == F.col("id"))
    shared = shared.where(F.col("a") < F.col("node")).select("a", F.col("node").alias("b")).distinct()
    final = settle(components(links.unionByName(last).unionByName(shared)), "near-components")
    return rows.join(final, "node", "left").select(
        "id", "n", F.coalesce("component", "node", "id").alias("component")
    )


def near_components(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    own = settled_alone(docs.sparkSession, "near-documents", lambda: _components(docs))
    component = F.when(F.col("component") != NO_ID, F.col("component"))
    doc_id = F.when(F.col("id") != NO_ID, F.col("id"))
    return own.select(
        doc_id.alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def first_of_groups(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, one of each component, with all columns.

    Where several rows carry the id that stays, the one whose columns have the smallest hash does.
    """
    kept = near_components(docs).where("kept").groupBy(F.col("doc_id").alias("__near_id"))
    kept = settle(kept.agg(F.count(F.lit(1)).alias("__near_rows")), "near-kept")
    same = docs["doc_id"].cast("long").eqNullSafe(kept["__near_id"])
    once = docs.join(kept.where(F.col("__near_rows") == 1), same, "left_semi")
    several = kept.where(F.col("__near_rows") > 1)
    if several.isEmpty():
        return once
    marked = [x for c in docs.columns for x in (F.col(c), F.col(c).isNull())]
    first = F.min_by(F.struct(*docs.columns), F.struct(F.xxhash64(*marked), "text")).alias("row")
    rest = docs.join(several, same, "left_semi").groupBy("doc_id").agg(first).select("row.*")
    return once.unionByName(rest)

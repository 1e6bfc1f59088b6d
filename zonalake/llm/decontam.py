"""Benchmark decontamination: which documents contain which test items.

MinHash containment search with size partitions. A test item is short and a document may be long, so
the two as wholes have a tiny Jaccard similarity, even if one lies inside the other. Every document
is therefore cut into windows of shingles, in sizes that double, each half overlapping the next, and
an item is looked for among the windows of its size partition only: windows at least twice as long as
the item, so that a passage of its length lies within one of them as a whole. An item is a candidate
for a document if in any window one of `N_HASHES` minima is the item's own. With the window at most
`4 * size` an item that stands in it as a whole has a similarity of about 1/4 or more, and is missed
with a probability of (3/4)^64 = 1e-8 at most; with 3/4 of its shingles there it is about 0.18, and the
miss 4e-6. Both hold for shingles that stand together; the fewer of them lie in one window, the likelier
is a miss. Windows of a size are unions of two of the next smaller, so all sizes cost little more than
the smallest. The smallest would be too long for items with fewer than `FEW` shingles. These are looked
up exactly instead: of n shingles, of which `needed` must be there, any n - needed + 1 contain one that
is, so those that fewest items share are looked up among a document's. Candidates are verified on the
full shingle sets of item and document in the task that has the document: nothing is shuffled but the
result.

The items are the stated query set. They go out in blocks of `ITEMS_PER_BLOCK` items with at most
`BLOCK_SHINGLES` shingles, so what a task gets is bounded; more items mean more passes.

Cases: null and empty texts contain nothing and are contained in nothing; an item with fewer words
than a shingle is looked for as one shingle, so it is found only in documents that consist of it;
equal items are all reported; a repeated document row is reported per row; without documents or items
the result is empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalake.llm.hashing import U64, mixed, shingles, utf8

THRESHOLD = 0.75
N_HASHES = 64
#: Shingles in a step: windows have 2, 4, 8, ... steps.
STEP = 32
#: Items with fewer shingles are looked up: the smallest window, 2 steps, is more than 4 times as long.
FEW = STEP // 2
ITEMS_PER_BLOCK = 20_000
BLOCK_SHINGLES = 4_000_000
PAIR = "row_key bigint, doc_id bigint, item_id bigint, n_shared bigint, n_item bigint"

_MULTIPLIERS = np.random.default_rng(7).integers(0, 2**63, N_HASHES, dtype=U64) * U64(2) + U64(1)


class ItemBlock:
    """The items of a block: shingle sets, minima, and for each size and hash the sorted minima.

    Items with fewer than `FEW` shingles have looked-up shingles in place of minima.
    """

    def __init__(self, ids: list[int], texts: list[bytes], threshold: float = THRESHOLD):
        self.ids = ids
        self.sets: list[np.ndarray] = []
        for _, group in shingles(texts):
            for a, b in zip(group.bounds, group.bounds[1:], strict=False):
                self.sets.append(np.unique(group.hashes[a:b]))
        sizes = np.array([len(s) for s in self.sets])
        # windows of STEP << level shingles, level 1 at least, twice the item's size or more
        self.levels = {
            i: max(1, int(np.ceil(np.log2(2 * n / STEP)))) for i, n in enumerate(sizes) if n >= FEW
        }
        self.tables: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for level in sorted(set(self.levels.values())):
            members = np.array([i for i, at in self.levels.items() if at == level])
            minima = np.array([[(self.sets[i] * m).min() for m in _MULTIPLIERS] for i in members])
            by_hash = []
            for k in range(N_HASHES):
                order = np.argsort(minima[:, k], kind="stable")
                by_hash.append((minima[order, k], members[order]))
            self.tables[level] = by_hash
        self._look_up([i for i, n in enumerate(sizes) if 0 < n < FEW], threshold)

    def _look_up(self, short: list[int], threshold: float) -> None:
        """The shingles by which short items are found, sorted, with their items."""
        every, counts = np.unique(np.concatenate([self.sets[i] for i in short] or [np.empty(0, U64)]), return_counts=True)
        keys, members = [], []
        for i in short:
            own = self.sets[i]
            needed = max(1, int(np.ceil(threshold * len(own) - 1e-9)))
            rarest = np.argsort(counts[np.searchsorted(every, own)], kind="stable")
            keys.append(own[rarest[: max(0, len(own) - needed + 1)]])
            members.append(np.full(len(keys[-1]), i))
        self.keys = np.concatenate(keys or [np.empty(0, U64)])
        self.key_items = np.concatenate(members or [np.empty(0, np.int64)])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.key_items = self.keys[order], self.key_items[order]
        self.prefixes = np.zeros(1 << 20, dtype=bool)
        self.prefixes[self.keys >> U64(44)] = True

    def looked_up(self, hashes: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
        """Pairs (text, short item) that share a looked-up shingle."""
        if not len(self.keys):
            return set()
        at = np.flatnonzero(self.prefixes[hashes >> U64(44)])
        left = np.searchsorted(self.keys, hashes[at], "left")
        right = np.searchsorted(self.keys, hashes[at], "right")
        text_of = np.searchsorted(bounds, at, "right") - 1
        return {
            (int(text_of[j]), int(i))
            for j in np.flatnonzero(right > left)
            for i in self.key_items[left[j] : right[j]]
        }

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
        """Pairs (text, item) of which a window shares a minimum, or the text a looked-up shingle."""
        found = self.looked_up(hashes, bounds)
        lengths = np.diff(bounds)
        filled = np.flatnonzero(lengths)
        if not len(filled) or not self.tables:
            return found
        n_steps = -(-lengths[filled] // STEP)
        first = np.cumsum(n_steps) - n_steps
        text_of = np.repeat(filled, n_steps)
        within = np.arange(len(text_of)) - np.repeat(first, n_steps)
        starts = bounds[text_of] + within * STEP
        for k, multiplier in enumerate(_MULTIPLIERS):
            level, width = 0, 1
            low = np.minimum.reduceat(hashes * multiplier, starts)
            for wanted, by_hash in self.tables.items():
                while level < wanted:  # steps beyond a text's end are left out
                    ahead = np.concatenate((low[width:], np.full(min(width, len(low)), ~U64(0))))[: len(low)]
                    same = np.concatenate((text_of[width:], np.full(min(width, len(low)), -1)))[: len(low)]
                    low = np.where(same == text_of, np.minimum(low, ahead), low)
                    level, width = level + 1, width * 2
                values, members = by_hash[k]
                left = np.searchsorted(values, low, "left")
                right = np.searchsorted(values, low, "right")
                for at in np.flatnonzero(right > left):
                    text = int(text_of[at])
                    found.update((text, int(i)) for i in members[left[at] : right[at]])
        return found


def item_blocks(items: DataFrame) -> Iterator[tuple[list[int], list[bytes]]]:
    """The query set in blocks of bounded size, as streamed by Spark."""
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0
    rows = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text")
    for item, text in rows.toLocalIterator():
        if ids and (len(ids) >= ITEMS_PER_BLOCK or size + len(text) // 2 > BLOCK_SHINGLES):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text.encode())
        size += len(text) // 2
    if ids:
        yield ids, texts


def _search(ids: list[int], texts: list[bytes], threshold: float):
    held: dict[int, ItemBlock] = {}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.setdefault(0, ItemBlock(ids, texts, threshold))
        for batch in batches:
            docs = utf8(batch.column("text"))
            doc_ids, row_keys = batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist()
            rows: list[tuple] = []
            for begin, group in shingles(docs):
                sets: dict[int, np.ndarray] = {}
                for text, item in sorted(block.candidates(group.hashes, group.bounds)):
                    if text not in sets:
                        sets[text] = group.hashes[group.bounds[text] : group.bounds[text + 1]]
                    wanted = block.sets[item]
                    shared = int(np.isin(wanted, sets[text]).sum())
                    if shared and shared >= threshold * len(wanted) - 1e-9:
                        at = begin + text
                        rows.append((row_keys[at], doc_ids[at], block.ids[item], shared, len(wanted)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                    names=["row_key", "doc_id", "item_id", "n_shared", "n_item"],
                )

    return search


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, item_id, n_shared, n_item, containment) with containment >= threshold."""
    slim = docs.select(
        F.lit(0).cast("long").alias("row_key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    found = None
    for ids, texts in item_blocks(items):
        part = slim.mapInArrow(_search(ids, texts, threshold), PAIR)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], PAIR)
    return found.select(
        "doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment")
    )


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per contaminated document: doc_id, item_ids (sorted), n_items, highest containment."""
    return (
        contained_items(docs, items)
        .groupBy("doc_id")
        .agg(
            F.sort_array(F.collect_set("item_id")).alias("item_ids"),
            F.max("containment").alias("containment"),
        )
        .withColumn("n_items", F.size("item_ids").cast("long"))
    )


def clean_rows(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that contain no item; all columns and repeats are kept.

    The same search as a filter in place: each batch keeps its clean rows, so no join is needed.
    """
    kept = docs
    for ids, texts in item_blocks(items):
        kept = kept.mapInArrow(_clean(ids, texts, threshold), kept.schema)
    return kept


def _clean(ids: list[int], texts: list[bytes], threshold: float):
    search = _search(ids, texts, threshold)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("text")),
                    pa.array(np.arange(batch.num_rows)),
                    pa.array(np.zeros(batch.num_rows, np.int64)),
                ],
                names=["text", "row_key", "doc_id"],
            )
            dirty = np.zeros(batch.num_rows, bool)
            for found in search(iter([numbered])):
                dirty[found.column("row_key").to_numpy()] = True
            yield batch.filter(pa.array(~dirty))

    return clean



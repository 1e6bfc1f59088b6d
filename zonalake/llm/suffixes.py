"""Repeated byte strings by distributed prefix doubling over a sparse suffix array.

Removed is every byte covered by a string of `LENGTH` bytes that also starts anywhere else.

Suffixes are not ranked at every byte but at anchors: of every `SPAN` successive grams of `GRAM` bytes
the one with the smallest hash. Anchors depend on the bytes around them only, so equal strings of
`LENGTH` bytes hold the same anchors, and between two anchors lies a phrase.

1. `phrases`: every anchor's rank pair starts with its phrase. Phrases that occur once drop out.
2. `doubled`: pairs (rank at anchor i, rank at anchor i + offset), offset 1, 2, 4, ...; Spark sorts the
   pairs and counts them, those that occur once drop out, the others get new ranks. A position is
   done when it is unique or when its run of phrases is past the length.
3. `covered`: a window lies between the last anchor before it and the first after it. Two overlapping
   runs of known rank name this outer run; where the name occurs again, the window is repeated.
4. `inner_runs`: a window that is not covered is repeated only if the phrases between its own first and
   last anchor are; those name its inner run.
5. `edge_windows`: windows at the edges of repeats have a repeated inner run, but not a repeated outer
   run. Only these are compared one by one, by 128-bit hashes of their bytes, with one another and
   with one window of each repeated outer run that has the same inner run.

All counting is by aggregations that combine in the map tasks, and all ways back to the positions are
joins that adaptive execution can split, so thousands of copies of a text do not meet in one task.
Phrase names are 64-bit hashes; a window's outer run has two phrases or more in the same order.

Cases: null texts are empty; texts shorter than `LENGTH` lose nothing; rows with equal id are separate
documents; equal rows repeat each other; a null id is an id of its own and null in the result; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalake.llm.files import settled_alone
from zonalake.llm.hashing import U64, mixed, prefix_sums, substring_hashes, utf8
from zonalake.session import limit_batches, settle

LENGTH = 400
GRAM = 8
SPAN = 144
NO_ID = -(2**63)
GROUP_BYTES = 1 << 20
#: Of what occurs twice or more, each value is one short row: its share of a partition is hashed, so that the
#: places, which are many more, need not be sorted.
HASHED = "shuffle_hash"
#: Documents that a Python worker is sent at once; each may come with hundreds of runs and windows.
BATCH_ROWS = 1_000
#: Runs and phrases of documents whose windows are found at once.
GROUP_RUNS = 200_000
KEY = ["id", "tag"]
LOW = U64(0xFFFFFFFF)
#: From a window to the start of its last SPAN grams, and to its last gram.
INNER_END, OUTER_END = LENGTH - GRAM - SPAN + 1, LENGTH - GRAM

PHRASE = "id bigint, tag bigint, place bigint, shape bigint, name bigint"
NAME = ["n", "ra", "rb"]
OUTER = "id bigint, tag bigint, first int, last int, n int, ra bigint, rb bigint, offset int"
INNER = "id bigint, tag bigint, first int, last int, n int, ra bigint, rb bigint, open boolean"
SPANS = "array<struct<first:int,last:int,chosen:boolean>>"
COVERED = f"id bigint, tag bigint, covered {SPANS}"
EDGE = "id bigint, tag bigint, at int, h1 bigint, h2 bigint"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _sliding_argmin(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every `span` successive values."""
    n = len(values)
    full = -(-n // span) * span
    padded = np.full(full, ~U64(0))
    padded[:n] = values
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - span + 1], ahead[span - 1 : n])


def anchors_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, span: int = SPAN):
    """Anchors of texts that lie one after the other in `data`, each `span + GRAM` bytes or more.

    Returns (text, position in data, first): `first` is the first of the starts of `span` grams whose
    smallest is this anchor. A text's first and last gram are added where they are no anchors; their
    `first` lies before and after all others.
    """
    grams = np.ndarray((len(data) - GRAM + 1,), "<u8", data, strides=(1,))
    place = np.arange(len(grams), dtype=U64)
    low = _sliding_argmin((mixed(grams) & ~LOW) | place, span) & LOW
    text = np.repeat(np.arange(len(starts)), ends - starts)[: len(low)]
    inside = np.arange(len(low)) + span - 1 + GRAM <= ends[text]
    window, at, owner = np.flatnonzero(inside), low[inside].astype(np.int64), text[inside]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    at, owner, first = at[new], owner[new], window[new]
    tops, tails = np.ones(len(at), dtype=bool), np.ones(len(at), dtype=bool)
    tops[1:] = owner[1:] != owner[:-1]
    tails[:-1] = tops[1:]
    early = np.flatnonzero(tops & (at != starts[owner]))
    late = np.flatnonzero(tails & (at != ends[owner] - GRAM))
    owner_all = np.concatenate((owner, owner[early], owner[late]))
    at_all = np.concatenate((at, starts[owner[early]], ends[owner[late]] - GRAM))
    first_all = np.concatenate((first, starts[owner[early]] - 1, ends[owner[late]] - GRAM))
    order = np.argsort(at_all, kind="stable")
    return owner_all[order], at_all[order], first_all[order]


def _groups(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Long enough texts in groups: (numbers, data, starts, ends)."""
    numbers = [i for i, t in enumerate(texts) if len(t) >= LENGTH]
    while numbers:
        size, n = 0, 0
        while n < len(numbers) and (n == 0 or size + len(texts[numbers[n]]) <= GROUP_BYTES):
            size += len(texts[numbers[n]])
            n += 1
        part, numbers = numbers[:n], numbers[n:]
        ends = np.cumsum([len(texts[i]) for i in part])
        data = np.frombuffer(b"".join(texts[i] for i in part), np.uint8)
        yield np.array(part), data, np.concatenate(([0], ends[:-1])), ends


def _emit_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, tags = batch.column("id").to_numpy(), batch.column("tag").to_numpy()
        for part, data, starts, ends in _groups(utf8(batch.column("text"))):
            owner, at, first = anchors_of(data, starts, ends)
            follows = owner[1:] == owner[:-1]
            # an anchor's last window start: before the next one's first, or the text's last
            last = ends[owner] - GRAM - SPAN + 1
            last[:-1] = np.where(follows, np.minimum(first[1:] - 1, last[:-1]), last[:-1])
            who, pos, nxt = owner[:-1][follows], at[:-1][follows], at[1:][follows]
            names = substring_hashes(prefix_sums(data), pos, nxt + GRAM)
            new = np.concatenate(([True], who[1:] != who[:-1]))[: len(who)]
            begin = np.maximum.accumulate(np.where(new, np.arange(len(who)), 0))
            back, next_first = pos - first[:-1][follows], first[1:][follows]
            shape = (nxt - pos) | (back << 8) | ((nxt - next_first) << 16)
            shape |= (nxt - last[1:][follows]) << 24
            rows = part[who]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[rows]), pa.array(tags[rows]),
                    pa.array(((np.arange(len(who)) - begin) << 32) | (pos - starts[who])),
                    pa.array(shape), pa.array(names.view(np.int64)),
                ],
                names=["id", "tag", "place", "shape", "name"],
            )


def _ranked(pairs: DataFrame, on: list[str]) -> DataFrame:
    """Ranks of the values of `on` that occur twice or more, in sorted order. The values are distinct, so a task
    that runs again ranks them as before."""
    again = pairs.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return again.orderBy(*on).select(*on, F.monotonically_increasing_id().alias("rank")).hint(HASHED)


def phrases(docs: DataFrame, several: bool) -> DataFrame:
    """Rows (id, tag, i, pos, nxt, shape, rank) of the phrases that occur twice or more; equal rows count once,
    if there may be some as an id has `several` rows.

    `shape` holds four small numbers: the phrase's length, how far its anchor lies after the first
    window start that chose it, the same for the next anchor, and how far the next anchor lies after
    the last window start that chose it.
    """

    def found() -> DataFrame:
        rows = docs.mapInArrow(_emit_phrases, PHRASE)
        rows = settle(rows.dropDuplicates([*KEY, "place"]) if several else rows, "suffix-anchors")
        named = rows.join(_ranked(rows, ["name"]), "name").drop("name")
        i, pos = F.shiftright("place", 32).cast("int"), F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")
        nxt = (pos + F.col("shape").bitwiseAND(0xFF)).cast("int")
        return named.select(*KEY, i.alias("i"), pos.alias("pos"), nxt.alias("nxt"), "shape", "rank")

    return settled_alone(docs.sparkSession, "suffix-phrases", found)


def doubled(level_0: DataFrame) -> list[tuple[int, DataFrame]]:
    """[(h, rows (id, tag, i, rank))]: runs of h = 2, 4, 8, ... phrases that occur twice or more."""
    now = level_0.select(*KEY, "i", "pos", "nxt", "rank", F.col("nxt").alias("end"))
    levels, h = [], 1
    order = Window.partitionBy(*KEY).orderBy("i")

    def following(now: DataFrame, h: int) -> DataFrame:
        pairs = (
            now.withColumn("there", F.lead("i", h).over(order))
            .withColumn("r2", F.lead("rank", h).over(order))
            .withColumn("far", F.lead("end", h).over(order))
            .where((F.col("there") == F.col("i") + h) & (F.col("end") + GRAM < F.col("nxt") + LENGTH))
            .select(*KEY, "i", "pos", "nxt", F.col("far").alias("end"), F.col("rank").alias("r1"), "r2")
        )
        pairs = settle(pairs, "suffix-pairs")
        return pairs.join(_ranked(pairs, ["r1", "r2"]), ["r1", "r2"]).drop("r1", "r2")

    while True:
        now = settled_alone(level_0.sparkSession, "suffix-level", lambda now=now, h=h: following(now, h))
        if now.isEmpty():
            return levels
        h *= 2
        levels.append((h, now.select(*KEY, "i", "rank")))


def _by_document(level_0: DataFrame, levels: list[tuple[int, DataFrame]]) -> DataFrame:
    """One row per document with the ranks of its runs, and the places and ranks of its phrases."""
    rows = level_0.select(*KEY, F.lit(1).alias("h"), "i", "rank", "pos", "shape")
    for h, level in levels:
        rows = rows.unionByName(level.withColumn("h", F.lit(h)), allowMissingColumns=True)
    place = F.when(F.col("h") == 1, F.struct("i", "pos", "shape", "rank"))
    run = F.when(F.col("h") > 1, F.struct("h", "i", "rank"))
    return rows.groupBy(*KEY).agg(F.collect_list(run).alias("runs"), F.collect_list(place).alias("places"))


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ..., `size` numbers each, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _fields(column: pa.ListArray, rows: slice, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of lists of structs in rows of a batch: each struct's row, counted from the first of `rows`, and fields."""
    offsets = column.offsets.to_numpy()[rows.start : rows.stop + 1]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    return owner, [inside.field(name).to_numpy(zero_copy_only=False) for name in names]


class _Stretches:
    """Stretches of successive phrases, of several documents at once.

    The documents lie one after the other, far apart: a document's positions begin at `shift`, and each of its
    anchors has a slot of its own. A stretch has an anchor more than phrases. Windows low..high of a stretch are
    those whose first and last anchor lie in it.
    """

    def __init__(self, batch: pa.RecordBatch, rows: slice):
        owner, columns = _fields(batch.column("places"), rows, "i", "pos", "shape", "rank")
        order = np.lexsort((columns[0], owner))
        owner, (i, pos, shape, rank) = owner[order], (x[order].astype(np.int64) for x in columns)
        final = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))  # every document has a phrase
        widths, counts = pos[final] + 4 * LENGTH, i[final] + 2
        self.shift, base = np.cumsum(widths) - widths + LENGTH, np.cumsum(counts) - counts
        slot, pos = base[owner] + i, pos + self.shift[owner]
        top = np.append(True, np.diff(slot) != 1)
        tail = np.append(top[1:], True)
        end_at = pos[tail] + (shape[tail] & 0xFF)
        place = np.arange(len(slot)) + np.cumsum(top) - 1
        close = place[tail] + 1
        self.slot, self.at, self.first = (np.empty(len(slot) + len(close), np.int64) for _ in range(3))
        for into, phrase, end in (
            (self.slot, slot, slot[tail] + 1), (self.at, pos, end_at),
            (self.first, pos - (shape >> 8 & 0xFF), end_at - (shape[tail] >> 16 & 0xFF)),
        ):
            into[place], into[close] = phrase, end
        self.document = owner[top]
        self.tops, self.tails = self.at[place[top]], end_at
        self.low = np.maximum(self.shift[self.document], self.first[place[top]])
        self.high = end_at - (shape[tail] >> 24) - INNER_END
        owner, (h, i, higher) = _fields(batch.column("runs"), rows, "h", "i", "rank")
        self.table = np.full((int(h.max(initial=1)).bit_length(), int(counts.sum()) + 1), -1, dtype=np.int64)
        self.table[0, slot] = rank
        self.table[np.log2(h).astype(np.int64), base[owner] + i] = higher

    def names(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n, ra, rb) of the runs between two anchors of a stretch; n is 0 where the name is not known."""
        begin, end = self.slot[begin], self.slot[end]
        n = end - begin
        level = np.log2(np.maximum(n, 1)).astype(np.int64)
        ok = (n > 0) & (level < len(self.table))
        level = np.where(ok, level, 0)
        ra = self.table[level, np.where(ok, begin, -1)]
        rb = self.table[level, np.where(ok, end - (1 << level), -1)]
        return np.where(ok & (ra >= 0) & (rb >= 0), n, 0), ra, rb

    @staticmethod
    def cut(marks: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows low..high cut at marks: (stretch, first, last)."""
        some = np.flatnonzero(low <= high)
        low, high = low[some], high[some]
        if not len(some):
            return some, low, high
        marks = np.unique(np.concatenate((marks, low)))
        within = np.searchsorted(low, marks, "right") - 1
        inside = (within >= 0) & (marks <= high[within])
        marks, within = marks[inside], within[inside]
        last = np.append(marks[1:], 0) - 1
        final = np.append(within[1:] != within[:-1], True)
        last[final] = high[within[final]]
        return some[within], marks, last

    def outer(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Windows by outer run: documents, and columns (first, last, n, ra, rb, offset)."""
        low, high = np.maximum(self.low, self.tops), np.minimum(self.high, self.tails - OUTER_END)
        of, first, last = self.cut(np.concatenate((self.at, self.at - OUTER_END + 1)), low, high)
        before = np.searchsorted(self.at, first, "right") - 1
        names = self.names(before, np.searchsorted(self.at, first + OUTER_END, "left"))
        return self._rows(of, first, last, names, first - self.at[before], names[0] > 0)

    def inner(self, owner: np.ndarray, begin: np.ndarray, end: np.ndarray, chosen: np.ndarray):
        """Windows by inner run: documents, and columns (first, last, n, ra, rb, open); of the covered windows
        begin..end only the chosen ones."""
        begin, end = begin + self.shift[owner], end + self.shift[owner]
        marks = np.concatenate((self.first, self.first - INNER_END, begin, end + 1))
        of, first, last = self.cut(marks, self.low, self.high)
        before = np.searchsorted(self.first, first, "right") - 1
        names = self.names(before, np.searchsorted(self.first, first + INNER_END, "right") - 1)
        span = np.searchsorted(begin, first, "right") - 1
        covered, taken = (np.zeros(len(first), dtype=bool) for _ in range(2))
        if len(begin):
            covered = (span >= 0) & (first <= end[span])
            taken = covered & chosen[span]
        return self._rows(of, first, last, names, ~covered, (names[0] > 0) & (~covered | taken))

    def _rows(self, of, first, last, names, extra, keep) -> tuple[np.ndarray, list[np.ndarray]]:
        document = self.document[of[keep]]
        shift = self.shift[document]
        return document, [first[keep] - shift, last[keep] - shift, *(x[keep] for x in (*names, extra))]


def _slices(batch: pa.RecordBatch) -> Iterator[slice]:
    """Rows whose documents have GROUP_RUNS runs and phrases together, or a longer one."""
    offsets = sum(batch.column(c).offsets.to_numpy() for c in ("runs", "places"))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + GROUP_RUNS, "right")) - 1)
        yield slice(begin, end)
        begin = end


def _window_rows(batch: pa.RecordBatch, rows: slice, document, columns, last: str, kind) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), kind)
    keys = [batch.column(c).to_numpy()[rows][document] for c in KEY]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, keys), *(pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True))],
        names=[*KEY, "first", "last", *NAME, last],
    )


def _emit_outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in _slices(batch):
            yield _window_rows(batch, rows, *_Stretches(batch, rows).outer(), "offset", pa.int32())


def _emit_inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in _slices(batch):
            owner, spans = _fields(batch.column("covered"), rows, "first", "last", "chosen")
            found = _Stretches(batch, rows).inner(owner, *spans)
            yield _window_rows(batch, rows, *found, "open", pa.bool_())


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each document in order, those that follow one another as one."""
    for batch in batches:
        whole = slice(0, batch.num_rows)
        owner, (first, last, chosen) = _fields(batch.column("covered"), whole, "first", "last", "chosen")
        order = np.lexsort((first, owner))
        owner, first, last, chosen = owner[order], first[order], last[order], chosen[order]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (first[1:] != last[:-1] + 1) | (chosen[1:] != chosen[:-1])
        columns = [pa.array(first[new]), pa.array(last[np.append(new[1:], True)[: len(new)]]), pa.array(chosen[new])]
        offsets = np.append(0, np.cumsum(np.bincount(owner[new], minlength=batch.num_rows)))
        spans = pa.StructArray.from_arrays(columns, names=["first", "last", "chosen"])
        merged = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tag"), merged], names=[*KEY, "covered"])


def covered_windows(documents: DataFrame) -> DataFrame:
    """(id, tag, covered): per document, its windows of repeated outer runs; one of each run is chosen."""

    def repeated() -> DataFrame:
        outer = settle(documents.mapInArrow(_emit_outer, OUTER), "suffix-outer")
        here, name = F.xxhash64(*KEY, "first"), [*NAME, "offset"]
        again = outer.groupBy(*name).agg(F.count(F.lit(1)).alias("m"), F.min(here).alias("low"))
        both = outer.join(again.where(F.col("m") > 1).hint(HASHED), name)
        span = F.struct("first", "last", (F.col("low") == here).alias("chosen"))
        return both.groupBy(*KEY).agg(F.collect_list(span).alias("covered")).mapInArrow(_merge, COVERED)

    return settled_alone(documents.sparkSession, "suffix-covered", repeated)


def inner_runs(documents: DataFrame, covered: DataFrame) -> DataFrame:
    """(id, tag, first, last, n, ra, rb, open) of windows that are not covered, and of the chosen ones."""
    spans = F.coalesce("covered", F.array().cast(SPANS)).alias("covered")
    rows = documents.join(covered, KEY, "left").select(*KEY, "runs", "places", spans)
    return settle(rows.mapInArrow(_emit_inner, INNER), "suffix-inner")


def _emit_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, tags = batch.column("id").to_numpy(), batch.column("tag").to_numpy()
        offsets = batch.column("spans").offsets.to_numpy()
        _, (first, last) = _fields(batch.column("spans"), slice(0, batch.num_rows), "first", "last")
        for part, data, starts, _ in _groups(utf8(batch.column("text"))):
            sizes = np.diff(offsets)[part]
            own = _ranges(offsets[part] - offsets[0], sizes)
            n = last[own] - first[own] + 1
            at = _ranges(first[own].astype(np.int64), n.astype(np.int64))
            number = np.repeat(np.repeat(np.arange(len(part)), sizes), n)
            begin, row = at + starts[number], part[number]
            h1, h2 = (
                substring_hashes(prefix_sums(data, base), begin, begin + LENGTH, base).view(np.int64) for base in (0, 1)
            )
            columns = (ids[row], tags[row], at.astype(np.int32), h1, h2)
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["id", "tag", "at", "h1", "h2"])


def edge_windows(docs: DataFrame, inner: DataFrame) -> DataFrame:
    """Rows (id, tag, at): starts of windows that occur again, found one by one."""
    runs = inner.groupBy(*NAME).agg(
        F.sum(F.col("open").cast("int")).alias("open"), F.count(F.lit(1)).alias("all")
    )
    runs = runs.where((F.col("open") > 0) & (F.col("all") > 1)).select(*NAME).hint(HASHED)
    wanted = inner.join(runs, NAME)
    spans = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    rows = docs.join(spans, KEY).select(*KEY, "text", "spans")
    edges = settle(rows.mapInArrow(_emit_edges, EDGE), "suffix-edges")
    again = edges.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return edges.join(again.drop("n").hint(HASHED), ["h1", "h2"]).select(*KEY, "at")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column("text"))
        out = []
        whole = slice(0, batch.num_rows)
        owner, (first, last) = _fields(batch.column("covered"), whole, "first", "last")
        edges = batch.column("edges")
        points = edges.offsets.to_numpy()
        at = edges.values.to_numpy()
        spans = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        columns = (batch.column(c).to_pylist() for c in ("id", "n_rows"))
        for row, (key, n_rows, text) in enumerate(zip(*columns, texts, strict=True)):
            begins, ends = first[spans[row] : spans[row + 1]], last[spans[row] : spans[row + 1]]
            single = at[points[row] : points[row + 1]]
            n_removed, n_spans, kept = 0, 0, text
            if n_rows > 1 and len(text) >= LENGTH:
                n_removed, n_spans, kept = len(text), 1, b""
            elif len(begins) or len(single):
                size = len(text) + 1
                change = np.bincount(begins, minlength=size) + np.bincount(single, minlength=size)
                change -= np.bincount(ends + LENGTH, minlength=size) + np.bincount(single + LENGTH, minlength=size)
                gone = np.cumsum(change)[:-1] > 0
                n_removed = int(np.count_nonzero(gone))
                n_spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            out.append(
                (None if key == NO_ID else key, len(text), n_removed, n_spans, hashlib.sha256(kept).hexdigest(), kept)
            )
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        columns = zip(*out, strict=True) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Rows (id, tag, text), the tag telling rows of equal id apart by their text; whether an id has several."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(key.alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    several = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    several = settle(several.select("id", F.lit(True).alias("several")), "suffix-ids")
    if several.isEmpty():
        return rows.withColumn("tag", F.lit(0).cast("long")), False
    tag = F.when(F.col("several"), F.xxhash64("text")).otherwise(F.lit(0)).cast("long")
    return rows.join(several, "id", "left").withColumn("tag", tag).drop("several"), True


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and `kept`, the remaining bytes."""
    spark = docs.sparkSession
    limit_batches(spark, BATCH_ROWS)
    rows, several = _keyed(docs)

    def gathered() -> DataFrame:
        level_0 = phrases(rows, several)
        return _by_document(level_0, doubled(level_0))

    documents = settled_alone(spark, "suffix-documents", gathered)
    covered = covered_windows(documents)
    edges = settled_alone(spark, "suffix-repeats", lambda: edge_windows(rows, inner_runs(documents, covered)))
    singles = edges.groupBy(*KEY).agg(F.collect_list("at").alias("edges"))
    equal = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    facts = covered.join(singles, KEY, "full").join(equal.where(F.col("n_rows") > 1), KEY, "full")
    facts = settle(facts, "suffix-facts")
    whole = rows.join(facts, KEY, "left").select(
        "id", F.coalesce("n_rows", F.lit(1)).alias("n_rows"),
        F.coalesce("covered", F.array().cast(SPANS)).alias("covered"),
        F.coalesce("edges", F.array().cast("array<int>")).alias("edges"), "text",
    )
    return whole.mapInArrow(_cut, RESULT)

"""Periodic runs in the word sequence of each text.

A run is a stretch of consecutive words with smallest period q, of at least max(LEAST, 2 * q) words,
that no neighbouring word extends keeping q. All runs come from Lyndon roots: under one of the two
orders of the words, the run holds a position whose longest Lyndon word is the run's period. That word
ends at the next position with a smaller suffix, so each position gives one candidate an order. Suffix
trees of the words and of their reversal (`suffixtree`) tell in constant time how far a candidate
extends to the right and to the left.

A word of a run of at least 12 words stands in a group of GRAM words that stands again one period
later, and the stretches between equal groups join up over the whole run. So trees are built over such
stretches only; in most texts there are none. The stretches of a text are handled one after the other,
so the memory needed follows the longest stretch (see `suffixtree`).

Cases: a null text is an empty one, and a text without words has no runs; repeated ids are separate
rows; no row depends on another, so an empty table gives an empty result; other columns pass through,
and one named `runs` or `collapsed` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from zonalake.llm.hashing import U64, mixed
from zonalake.llm.suffixtree import Extensions
from zonalake.llm.wordcodes import Words, coded_words, groups

LEAST = 12
GRAM = 6
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))
WORD = r"[^\x20\x09-\x0D]+"


def _next_smaller(values: list[int]) -> np.ndarray:
    """The next position with a smaller value, or the length."""
    out, waiting = np.full(len(values), len(values), np.int64), []
    for at, value in enumerate(values):
        while waiting and values[waiting[-1]] > value:
            out[waiting.pop()] = at
        waiting.append(at)
    return out


def runs_of(s: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows of start, length and period, by start and period, of the runs of a number sequence."""
    n = len(s)
    ahead = Extensions(s.tolist())
    rank = ahead.rank[:n]
    first = np.tile(np.arange(n), 2)
    second = np.concatenate((_next_smaller(rank.tolist()), _next_smaller((-rank).tolist())))
    first, second = first[second < n], second[second < n]
    stop = second + ahead(first, second)
    del ahead, rank
    back = Extensions(s[::-1].tolist())
    start = first - back(n - first, n - second)
    period, length = second - first, stop - start
    is_run = length >= np.maximum(least, 2 * period)
    found = np.stack((start, length, period), axis=1)[is_run]
    found = np.unique(found, axis=0)  # by start, then length; a start's runs differ in period
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(words: Words) -> Iterator[tuple[int, int]]:
    """Bounds, in the words of several texts, of the parts that can hold runs; each lies in one text."""
    n = len(words.codes)
    if n < LEAST:
        return
    spread = mixed(words.codes.astype(U64) + U64(1))
    grams = np.zeros(n - GRAM + 1, dtype=U64)
    for i in range(GRAM):
        grams = mixed(grams + spread[i : n - GRAM + 1 + i])
    row = words.row
    at = np.flatnonzero(row[: n - GRAM + 1] == row[GRAM - 1 :])
    grams = mixed(grams[at] ^ mixed(row[at].astype(U64)))
    order = np.argsort(grams, kind="stable")
    same = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    begin, again = at[order[same]], at[order[same + 1]]
    near = row[begin] == row[again]
    begin, again = begin[near], again[near]
    depth = np.bincount(begin, minlength=n + 1) - np.bincount(again + GRAM, minlength=n + 1)
    inside = np.cumsum(depth)[:n] > 0
    joined = inside[1:] & inside[:-1] & (row[1:] == row[:-1])
    starts = np.flatnonzero(inside & ~np.concatenate(([False], joined)))
    stops = np.flatnonzero(inside & ~np.concatenate((joined, [False]))) + 1
    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
        if b - a >= LEAST:
            yield a, b


def _runs_by_row(words: Words, n_rows: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Runs of each text, and which words stand in a run behind its first period."""
    first = np.searchsorted(words.row, np.arange(n_rows))
    found: list[list[np.ndarray]] = [[] for _ in range(n_rows)]
    depth = np.zeros(len(words.codes) + 1, np.int64)
    for a, b in stretches(words):
        part = runs_of(words.codes[a:b])
        if len(part):
            np.add.at(depth, a + part[:, 0] + part[:, 2], 1)
            np.add.at(depth, a + part[:, 0] + part[:, 1], -1)
            row = int(words.row[a])
            part[:, 0] += a - first[row]
            found[row].append(part)
    none = np.zeros((0, 3), np.int64)
    return [np.concatenate(parts or [none]) for parts in found], np.cumsum(depth)[:-1] > 0


def _joined(words: Words, kept: np.ndarray, n_rows: int) -> pa.Array:
    """The kept words of each text with one space between them."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(words.row[kept], minlength=n_rows))))
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), words.known.take(pa.array(words.codes[kept])))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def with_runs(docs: DataFrame) -> DataFrame:
    """`docs` with `runs`, the start (word number from 0), length and period of each run of the text, by
    start, then period; and with `collapsed`, the text's words joined by one space, without those that
    any run holds behind its first period."""
    rest = docs.drop("runs", "collapsed")
    names = [f"c{i}" for i in range(len(rest.columns))]
    text = names[rest.columns.index("text")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch, text):
                words = coded_words(part.column(text))
                found, dropped = _runs_by_row(words, part.num_rows)
                rows = np.concatenate(found)
                runs = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], fields=list(RUN))
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                added = [pa.ListArray.from_arrays(pa.array(offsets), runs), _joined(words, ~dropped, part.num_rows)]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*names, "runs", "collapsed"])

    plain = rest.toDF(*names)
    schema = StructType([*plain.schema.fields]).add("runs", RUNS).add("collapsed", "string")
    return plain.mapInArrow(find, schema).toDF(*rest.columns, "runs", "collapsed")


def _planted(docs: DataFrame) -> DataFrame:
    """One text in ten, by its id, becomes periodic from some word on; ids that are null never do."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("__words")
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    period = 1 + F.floor((n - F.col("__a")) / (3 + F.col("__g") % 8))
    cycle = F.slice("__words", F.col("__a") + 1, F.col("__p"))
    times = F.ceil((n - F.col("__a")) / F.col("__p")).cast("int")
    turns = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), n - F.col("__a"))
    whole = F.array_join(F.concat(F.slice("__words", F.lit(1), F.col("__a")), turns), " ")
    return (
        docs.select("doc_id", F.col("text").cast("string").alias("text"), words.alias("__words"), g.alias("__g"))
        .withColumn("__a", F.when(n > 0, F.col("__g") % n).cast("int"))
        .withColumn("__p", period.cast("int"))
        .select("doc_id", F.when(F.col("__a").isNotNull(), whole).otherwise(F.col("text")).alias("text"))
    )


def run_report(docs: DataFrame) -> DataFrame:
    """Per document, after one in ten has been made periodic: its runs, the longest of them, and digests
    of all runs and of the text without repeats."""
    found = with_runs(_planted(docs))
    order = lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    best = F.array_min(F.transform("runs", order))
    lines = F.transform(
        "runs",
        lambda r: F.concat(F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period"))), F.lit("\n")),
    )
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("b.start").alias("start"), (-F.col("b.less")).alias("length"),
        F.col("b.period").alias("period"), F.expr("(-1000 * b.less) DIV b.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )

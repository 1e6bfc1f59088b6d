"""Phrase collocations by dynamic itemset counting.

The texts are dealt into SHARDS by a hash of their content, and the shards are scanned in a cycle. The
first scans count single words. As soon as both words of a pair have reached the threshold in the
shards read so far, the pair is active: it is counted from the next scan on, through one full cycle.
Pairs that reach the threshold activate phrases of three words in the same way, so lengths are counted
side by side. The scans end when every active phrase has its full cycle. A phrase at the threshold has
parts at the threshold, so each one is activated at some time, and its count is then exact.

What is active is told to the tasks by a Bloom filter for each scan that made words or pairs reach the
threshold. A filter has FILTER_BITS bits at most, whatever the data, so that its broadcast is bounded.
A false positive, more frequent in a full filter, only has another phrase counted, through a full cycle
too: a phrase's first scan follows from the filters alone, in every task alike. So filters never change
a count. Tasks count each group of texts before anything is shuffled, and partial sums are taken again
before the shuffle, so that a frequent phrase brings a row a task.

Cases: a null text is an empty one, a null language is `und`; languages are compared as they are;
repeated ids and rows count each; an empty table gives an empty result; other columns are ignored.
Pieces end at `[.,;:!?\\x0A-\\x0D]` and with their text; A-Z is lowered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from zonalake.llm.hashing import U64, mixed, prefix_sums, substring_hashes
from zonalake.llm.wordcodes import byte_table, coded_words, groups
from zonalake.session import settle, work_path

SHARDS = 2
THRESHOLD = 10
FILTER_BITS = 1 << 27
#: Bits and probes a key in a filter below its bound.
BITS_PER_KEY, PROBES = 16, 4
PIECES = byte_table(np.frombuffer(b" \t", np.uint8), b".,;:!?\n\x0b\x0c\r", lower=True)
NEVER = 1_000
#: lang, a line end, and the words with a space between them; a word holds neither.
COUNTS = "key string, words tinyint, start tinyint, n bigint"


def text_hashes(values: pa.Array) -> np.ndarray:
    """64-bit hashes of strings without nulls."""
    values = values.cast(pa.large_string())
    if not len(values):
        return np.zeros(0, U64)
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    return substring_hashes(prefix_sums(data), ends[:-1], ends[1:])


def _phrase_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Of a phrase from that of its front part (at first, the language) and its last word."""
    return mixed(mixed(before + U64(0x9E3779B97F4A7C15)) ^ (word * U64(0xD6E8FEB86659FD93)))


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    step = mixed(hashes) | U64(1)
    return np.stack([(hashes + U64(i) * step) & U64(bits - 1) for i in range(PROBES)])


@dataclass
class Filters:
    """Bloom filters by the scan after which their words or pairs had reached the threshold."""

    layers: dict[int, list] = field(default_factory=lambda: {1: [], 2: []})  # (scan, broadcast)

    def scans(self, words: int, hashes: np.ndarray) -> np.ndarray:
        """The earliest of these scans for each phrase of so many words, NEVER if there is none."""
        out = np.full(len(hashes), NEVER, np.int64)
        for scan, bits in self.layers[words]:
            table = bits.value
            left = np.flatnonzero(out == NEVER)
            at = _probes(hashes[left], 64 * len(table))
            held = (table[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1)
            out[left[held.all(axis=0)]] = scan
        return out


def _joined(*parts: pa.Array) -> pa.Array:
    """All but the last joined element by element; the last is a string between them."""
    *columns, between = (pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in parts)
    return pc.binary_join_element_wise(*columns, between)


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each distinct number stands first, the number of each place's value, and counts."""
    numbers, values = pd.factorize(codes)
    first = np.empty(len(values), np.int64)
    first[numbers[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return first, numbers, np.bincount(numbers, minlength=len(values))


def _count_group(batch: pa.RecordBatch, scan: int, shards: int, filters: Filters) -> pa.RecordBatch:
    """What a scan counts in a group of texts: words in the first cycle, and active phrases."""
    words = coded_words(batch.column("text"), PIECES)
    langs = batch.column("lang").dictionary_encode()
    lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.row]
    out: list[tuple[pa.Array, int, np.ndarray, np.ndarray]] = []
    front = _joined(langs.dictionary.cast(pa.large_string()), "", "\n")
    if scan < shards and len(lang):
        totals = np.bincount(lang, minlength=len(front))
        out.append((front, 0, np.zeros(len(front), np.int64), totals))

    # Phrases of one length at a time: `places` has where they begin and `code` numbers the distinct ones.
    many = len(words.known)
    first, code, counts = _counted(lang * many + words.codes)
    word_hashes = text_hashes(words.known)
    hashes = _phrase_hash(text_hashes(langs.dictionary)[lang[first]], word_hashes[words.codes[first]])
    names = _joined(front.take(pa.array(lang[first])), words.known.take(pa.array(words.codes[first])), "")
    if scan < shards:
        out.append((names, 1, np.zeros(len(first), np.int64), counts))
    places = np.arange(len(words.codes))
    for length in (2, 3):
        reached = filters.scans(length - 1, hashes)
        if not (reached < NEVER).any():
            break
        # A phrase's parts are its front, numbered by `code`, and the one that begins a word later.
        front_of = np.full(len(words.codes) + 1, -1, np.int64)
        front_of[places] = code
        behind = front_of[places + 1]
        begin = np.where(behind >= 0, np.maximum(reached[code], reached[behind]), NEVER) + 1
        whole = begin < NEVER
        whole[whole] = words.piece[places[whole]] == words.piece[places[whole] + length - 1]
        places, fronts, begin = places[whole], code[whole], begin[whole]
        ends = words.codes[places + length - 1]
        first, code, counts = _counted(fronts * many + ends)
        hashes = _phrase_hash(hashes[fronts[first]], word_hashes[ends[first]])
        names = _joined(names.take(pa.array(fronts[first])), words.known.take(pa.array(ends[first])), " ")
        begin = begin[first]
        active = (begin <= scan) & (scan < begin + shards)
        out.append((names.filter(pa.array(active)), length, begin[active], counts[active]))
    return pa.RecordBatch.from_arrays(
        [
            pa.chunked_array([o[0] for o in out], pa.large_string()).combine_chunks().cast(pa.string()),
            pa.array(np.concatenate([np.full(len(o[0]), o[1]) for o in out] or [[]]).astype(np.int8)),
            pa.array(np.concatenate([o[2] for o in out] or [[]]).astype(np.int8)),
            pa.array(np.concatenate([o[3] for o in out] or [[]]).astype(np.int64)),
        ],
        names=["key", "words", "start", "n"],
    )


def _scan(shard: DataFrame, scan: int, shards: int, filters: Filters) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch):
                yield _count_group(part, scan, shards, filters)

    return shard.mapInArrow(count, COUNTS)


def _key_hashes(keys: list[str]) -> np.ndarray:
    split = [key.rpartition("\n") for key in keys]
    hashes = text_hashes(pa.array([lang for lang, _, _ in split], pa.large_string()))
    by_length: dict[int, list[int]] = {}
    words = [phrase.split(" ") for _, _, phrase in split]
    for i, own in enumerate(words):
        by_length.setdefault(len(own), []).append(i)
    for length, members in by_length.items():
        for n in range(length):
            column = pa.array([words[i][n] for i in members], pa.large_string())
            hashes[members] = _phrase_hash(hashes[members], text_hashes(column))
    return hashes


def _bloom_filter(keys: DataFrame, count: int, most_bits: int):
    """A broadcast of the bits of a filter that holds all `keys`, `most_bits` at most."""
    bits = min(most_bits, 1 << max(16, math.ceil(math.log2(count * BITS_PER_KEY))))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _probes(_key_hashes(batch.column(0).to_pylist()), bits).ravel()
            places, inverse = np.unique(at >> U64(6), return_inverse=True)
            masks = np.zeros(len(places), U64)
            np.bitwise_or.at(masks, inverse, U64(1) << (at & U64(63)))
            columns = [pa.array(places.astype(np.int64)), pa.array(masks.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "mask"])

    probed = keys.select("key").mapInArrow(probe, "place bigint, mask bigint")
    found = probed.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(bits // 64, U64)
    table[found.column("place").to_numpy()] = found.column("mask").to_numpy().view(U64)
    return keys.sparkSession.sparkContext.broadcast(table)


def _dealt(docs: DataFrame, shards: int) -> str:
    """Write the texts by shard, so that a scan reads its own."""
    location = work_path(docs.sparkSession, "phrase-shards")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    dealt = docs.select(lang.alias("lang"), text.alias("text"), shard.alias("shard"))
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(location)
    return location


def count_phrases(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    shards: int = SHARDS,
    most_bits: int = FILTER_BITS,
) -> DataFrame:
    """Exact counts of all words and phrases of two and three words that occur `threshold` times or more
    in a language: (lang, phrase, words, n). A row of no words and an empty phrase has the number of all
    words of a language."""
    spark = docs.sparkSession
    texts = spark.read.schema("lang string, text string, shard int").parquet(_dealt(docs, shards))
    filters, counted, pending = Filters(), [], None
    for scan in range(3 * shards):
        shard = texts.filter(F.col("shard") == scan % shards).select("lang", "text")
        rows = _scan(shard, scan, shards, filters).withColumn("reached", F.lit(None).cast("tinyint"))
        if pending is not None:
            rows = rows.unionByName(pending)
        enough = F.col("n") >= threshold
        done = F.col("start") + shards - 1 <= scan
        reached = F.coalesce("reached", F.when(enough, F.lit(scan).cast("tinyint")))
        sums = (
            rows.groupBy("key", "words", "start")
            .agg(F.sum("n").alias("n"), F.min("reached").alias("reached"))
            .withColumn("reached", reached)
            .filter(~done | enough | (F.col("words") == 0))
        )
        sizes = Observation(f"scan-{scan}")
        is_new = {words: (F.col("words") == words) & (F.col("reached") == scan) for words in (1, 2)}
        sums = sums.observe(
            sizes,
            F.count_if(~done).alias("pending"),
            *(F.count_if(new).alias(f"new{words}") for words, new in is_new.items()),
        )
        sums = settle(sums, "phrase-counts")
        counted.append(sums.filter(done))
        pending = sums.filter(~done)
        found = sizes.get
        for words, new in is_new.items():
            if found.get(f"new{words}"):
                layer = _bloom_filter(sums.filter(new), found[f"new{words}"], most_bits)
                filters.layers[words].append((scan, layer))
        if scan >= shards - 1 and not any(found.values()):
            break
    phrase = F.substring_index("key", "\n", -1)
    lang = F.expr("substring(key, 1, length(key) - length(substring_index(key, '\n', -1)) - 1)")
    return reduce(DataFrame.unionByName, counted).select(
        lang.alias("lang"), phrase.alias("phrase"), F.col("words").cast("int").alias("words"), "n"
    )


def scored(counts: DataFrame) -> DataFrame:
    """The candidates among counted phrases with their lowest-scoring cut: lang, phrase, words, a, l, r,
    score. What a frequent longer phrase covers is left out."""
    phrases = counts.filter(F.col("words") > 1).withColumnRenamed("n", "a")
    own = F.split("phrase", " ")
    part = lambda begin, length: F.array_join(F.slice(own, begin, length), " ")
    cuts = phrases.select(
        "lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    ).withColumns({"head": part(F.lit(1), F.col("k")), "tail": part(F.col("k") + 1, F.col("words") - F.col("k"))})
    parts = counts.filter(F.col("words").isin(1, 2))
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    cuts = cuts.withColumns(
        {"above": F.lit(1_000_000).cast("decimal(7,0)") * wide("a") * wide("a"), "below": wide("l") * wide("r")}
    ).withColumn("score", F.expr("above DIV below"))
    best = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    longer = phrases.filter("words = 3").select(
        "lang", F.explode(F.array_distinct(F.array(part(F.lit(1), F.lit(2)), part(F.lit(2), F.lit(2))))).alias("phrase"), "a"
    )
    cover = longer.groupBy("lang", "phrase").agg(F.max("a").alias("covered"))
    kept = best.join(cover, ["lang", "phrase"], "left").filter(
        F.col("covered").isNull() | (wide("covered") * 100 < wide("a") * 50)
    )
    return kept.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, top: int = 2_000, **options) -> DataFrame:
    """The first `top` phrases of each language by score, count and phrase, with their counts and the
    number n of all words of the language."""
    counts = count_phrases(docs, **options)
    spark: SparkSession = docs.sparkSession
    found = scored(counts)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    lots = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = found.withColumn("lot", F.pmod(F.xxhash64("phrase"), F.lit(lots)))
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*order)))
    best = best.filter(F.col("place") <= top)  # so that no task ranks a whole language
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    totals = counts.filter(F.col("words") == 0).select("lang", "n")
    ranked = best.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same over `documents` for DuckDB.
REPORT_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, row_number() OVER () AS doc,
         unnest(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM lists, range(1, 4) AS t(k)
  WHERE len(ws) >= k
), f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cands AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, t.cut, array_to_string(ws[1:cut], ' ') AS head, array_to_string(ws[cut + 1:], ' ') AS tail
  FROM cands c, range(1, 3) AS t(cut) WHERE t.cut < c.k
), priced AS (
  SELECT cuts.*, h.n AS l, t.n AS r,
         ((1000000::HUGEINT * a * a) // (h.n::HUGEINT * t.n))::BIGINT AS score
  FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = cuts.head AND h.k = cuts.cut
  JOIN f t ON t.lang = cuts.lang AND t.phrase = cuts.tail AND t.k = cuts.k - cuts.cut
), best AS (
  SELECT * FROM priced QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), cover AS (
  SELECT lang, phrase, max(a) AS covered FROM (
    SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
    FROM cands WHERE k = 3) GROUP BY lang, phrase
), kept AS (
  SELECT b.* FROM best b LEFT JOIN cover c ON c.lang = b.lang AND c.phrase = b.phrase
  WHERE c.covered IS NULL OR 100 * c.covered < 50 * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT ranked.lang, rank, phrase, a, l, r, totals.n, score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""

"""Main text of web pages, with a suffix array of each host for boilerplate.

1. `markup.blocks` splits a page into blocks and tells their zone: article, content, chrome (menus,
   footers, adverts, forms, comments, ...) or neutral.
2. `repeated_runs`: the words of all blocks form a page's token stream, those outside articles first, those
   inside after a gap; the streams of a host are concatenated and sorted by prefix doubling: rank pairs
   at offsets 1, 2, 4 within a page, sorted and counted in Spark, where only those on two or more pages
   of the host go on. What is left are the substrings of `RUN` = 8 tokens that repeat across distinct
   documents. A neutral block counts as a unit of its own too, so that repeated blocks of fewer words
   are found. Words inside articles are left out where they cannot matter: a run that half of a host's
   pages have has words only that half of its pages have in some task (`_common_words`).
3. `main_text`: a page that marks its article has the text of that zone, less the blocks that are
   boilerplate of the host. On other pages the neutral blocks count: those covered by repeated runs are
   boilerplate and are removed, the unique ones stay.

What counts are documents, not pages: pages of a host with equal blocks have one stream, and streams are
one document if their marked text is equal or, without marked text, if they hardly differ: fewer than
`RUN` words, and less than a tenth, stand in blocks of their own, and their rarest shared block is the
same. So a page that stands on its host under two urls keeps its text. A run or block is boilerplate if
`SHARED` documents of the host have it, or both on a host of two; so text that two of many pages quote
stays, as does a menu on two of many, which looks the same.

Passages inside a marked article that some pages of the host quote stay. A block of it is boilerplate only
if it is covered by runs that half of the host's pages, and half of its documents, `SHARED_INSIDE` at least, have: a
notice that stands in every article. An article of which such blocks are half the words or more is a
version of the others and stays whole.

Ranks are counted with a combination in the map tasks and go back by joins that can be split, so a
host with a third of all pages is spread over tasks. Pages are parsed once and their blocks are written; later
passes read those. Blocks are shuffled only to tell them of runs: those of pages that mark no article, and those of
others if articles hold such runs in more pages than can be broadcast.

Cases: null and empty html have an empty text; a null url is a host of its own; equal rows are one page;
a null page_id is kept as null; a page without any block has an empty text; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalake.llm.hashing import prefix_sums, substring_hashes, utf8
from zonalake.llm.markup import NEUTRAL, best_zone, blocks
from zonalake.llm.wordcodes import groups
from zonalake.session import settle

RUN = 8
#: Documents of a host that must have a run, if the host has as many.
SHARED = 3
#: Documents of a host that must have a run inside articles, beside half of them: on small hosts three of five
#: documents also share sentences of their own.
SHARED_INSIDE = 10
#: Bytes of html or text whose words are found at once.
GROUP_BYTES = 1 << 20
#: n is 0 for a word; for a neutral block its words, with i = -1 - its number; or one of those below.
TOKEN = "host bigint, page bigint, i int, rank bigint, n int"
#: rank is the key of a page with this stream; rank is the hash of the stream's marked text.
PAGE_KEY, MARKED = -1, -2
#: rank is the hash of a word that half of the host's pages of a task have.
COMMON = -3
#: rank is the key of a page without blocks.
NO_BLOCKS = -4
#: Number of the first word inside articles.
INSIDE = 1 << 30
#: Words of pages that a task counts before it hands the common ones on.
COUNTED = 2_000_000
#: Tokens; rows with the key of a page have its blocks too: a zone each, and the texts, a line each.
PARSED = TOKEN + ", page_id bigint, url string, zones binary, text string, undecided boolean"
RESULT = "page_id bigint, url string, text string, n_chars bigint, n_left_out bigint"


def _keyed(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    url = F.col("url").cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        html.alias("html"),
        F.xxhash64(host).alias("host"),
        F.xxhash64("page_id", "url", html).alias("page"),
    )


def _words(found: list[tuple[int, str]], inside: bool = False) -> tuple[list[str], list[int]]:
    """Words outside articles, or those inside, and for each block how many words end with it."""
    words: list[str] = []
    ends: list[int] = []
    for zone, text in found:
        if (zone < NEUTRAL) == inside:
            words += text.split(" ")
        ends.append(len(words))
    return words, ends


def _words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts with a block a line, and the block of each, counted over all texts."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    breaks = np.flatnonzero((data == ord(" ")) | (data == ord("\n")))
    starts, ends = np.concatenate(([0], breaks + 1)), np.append(breaks, len(data))
    block = np.concatenate(([0], np.cumsum(data[breaks] == ord("\n"))))
    return substring_hashes(prefix_sums(data), starts, ends).view(np.int64), block


def _zones_of(zones: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Zone and page of each block."""
    return np.frombuffer(b"".join(zones), np.uint8), np.repeat(np.arange(len(zones)), [len(z) for z in zones])


def _blocks_of(zones: bytes, text: str) -> list[tuple[int, str]]:
    return list(zip(zones, text.split("\n"), strict=True)) if zones else []


def _text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _stream(host: int, found: list[tuple[int, str]]) -> int:
    return _text_hash(f"{host}\n" + "\n".join(f"{zone} {text}" for zone, text in found))


def _token_rows(*columns) -> pa.RecordBatch:
    """Rows of PARSED that are no pages, from host, page, i, rank and n."""
    own, other = _kinds(PARSED)[:5], _kinds(PARSED)[5:]
    arrays = [pa.array(np.asarray(c).astype(kind.to_pandas_dtype())) for c, (_, kind) in zip(columns, own, strict=True)]
    arrays += [pa.nulls(len(arrays[0]), kind) for _, kind in other]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in own + other])


def _kinds(schema: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return [(name, kinds[kind]) for name, kind in (column.split() for column in schema.split(", "))]


def _common_words(counts: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
    """Words that half of a host's pages have, of the pages counted; a word that half of all its pages have is
    among them in some task."""
    hosts, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for host, own in counts.items():
        words, n = np.unique(np.concatenate(own), return_counts=True)
        hashes.append(words[2 * n >= len(own)])
        hosts.append(np.full(len(hashes[-1]), host))
    counts.clear()
    none = np.zeros(sum(map(len, hashes)), np.int64)
    return _token_rows(np.concatenate(hosts), none, none, np.concatenate(hashes), none + COMMON)


def _page_rows(batch: pa.RecordBatch, parsed: list[list[tuple[int, str]]], streams: list[int]) -> pa.RecordBatch:
    n = batch.num_rows
    columns = [
        batch.column("host"), pa.array(streams, pa.int64()), pa.array(np.zeros(n, np.int32)), batch.column("page"),
        pa.array([PAGE_KEY if found else NO_BLOCKS for found in parsed], pa.int32()),
        batch.column("page_id"), batch.column("url"),
        pa.array([bytes(zone for zone, _ in found) for found in parsed], pa.binary()),
        pa.array(["\n".join(text for _, text in found) for found in parsed], pa.string()),
        pa.array(list(map(_undecided, parsed))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in _kinds(PARSED)])


def _units(host: int, stream: int, found: list[tuple[int, str]]) -> Iterator[tuple[int, int, int, int, int]]:
    marked = "\n".join(text for zone, text in found if zone < NEUTRAL)
    if marked:
        yield host, stream, 0, _text_hash(marked), MARKED
    for b, (zone, text) in enumerate(found):
        if zone == NEUTRAL:
            yield host, stream, -1 - b, _text_hash(text), text.count(" ") + 1


def _emit_parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of all pages, tokens of what lies outside articles, and common words."""
    counts: dict[int, list[np.ndarray]] = {}
    counted = 0
    for whole in batches:
        for batch in groups(whole, "html", GROUP_BYTES):
            hosts = batch.column("host").to_pylist()
            parsed = [blocks(html) for html in batch.column("html").to_pylist()]
            streams = [_stream(host, found) for host, found in zip(hosts, parsed, strict=True)]
            pages = _page_rows(batch, parsed, streams)
            yield pages
            units = [row for page in zip(hosts, streams, parsed, strict=True) for row in _units(*page)]
            if units:
                yield _token_rows(*np.array(units, dtype=np.int64).T)
            some = [k for k, found in enumerate(parsed) if found]
            if not some:
                continue
            texts, own = utf8(pages.column("text")), pages.column("zones").to_pylist()
            hashes, block = _words_of([texts[k] for k in some])
            zones, page_of = _zones_of([own[k] for k in some])
            page = page_of[block]
            ends = np.searchsorted(page, np.arange(len(some) + 1))
            for k, begin, end in zip(some, ends, ends[1:], strict=False):
                words = np.unique(hashes[begin:end])
                counts.setdefault(hosts[k], []).append(words)
                counted += len(words)
            outside = zones[block] >= NEUTRAL
            page, hashes = page[outside], hashes[outside]
            number = np.arange(len(page)) - np.searchsorted(page, page)
            of = np.array(some)[page]
            yield _token_rows(np.array(hosts)[of], np.array(streams)[of], number, hashes, np.zeros(len(page)))
            if counted > COUNTED:
                yield _common_words(counts)
                counted = 0
    yield _common_words(counts)


def _emit_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words inside articles that stand in runs of RUN words that are all common on their host."""
    for whole in batches:
        for batch in groups(whole, "text", GROUP_BYTES):
            hosts, streams = batch.column("host").to_numpy(), batch.column("page").to_numpy()
            hashes, block = _words_of(utf8(batch.column("text")))
            zones, page_of = _zones_of(batch.column("zones").to_pylist())
            inside = zones[block] < NEUTRAL
            hashes, page = hashes[inside], page_of[block][inside]
            ends = np.searchsorted(page, np.arange(batch.num_rows + 1))
            known, common = np.zeros(len(hashes), dtype=bool), {}
            for row, (begin, end) in enumerate(zip(ends, ends[1:], strict=False)):
                if end - begin < RUN:
                    continue
                if hosts[row] not in common:
                    common[hosts[row]] = np.sort(batch.column("common")[row].values.to_numpy())
                own, words = common[hosts[row]], hashes[begin:end]
                known[begin:end] = own[np.minimum(np.searchsorted(own, words), len(own) - 1)] == words
            rare = np.concatenate(([0], np.cumsum(~known)))
            begins = np.flatnonzero(rare[RUN:] == rare[:-RUN])
            begins = begins[page[begins] == page[begins + RUN - 1]]
            change = np.bincount(begins, minlength=len(page) + 1) - np.bincount(begins + RUN, minlength=len(page) + 1)
            i = np.flatnonzero(np.cumsum(change)[:-1])
            of = page[i]
            columns = (hosts[of], streams[of], (i - ends[of] + INSIDE).astype(np.int32), hashes[i], np.zeros(len(i), np.int32))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["host", "page", "i", "rank", "n"])


def _documents(tokens: DataFrame, units: DataFrame) -> DataFrame:
    """(page, number, needed, open, most, pages): the document of each stream, as 44 bits, how many must share a
    run, whether the stream's pages mark no article, of how many documents a run inside articles must be, and
    the stream's pages."""
    counts = units.dropDuplicates(["host", "page", "rank"]).groupBy("host", "rank").agg(F.count("*").alias("pages"))
    shared = F.when(F.col("pages") > 1, F.struct("pages", "rank"))
    own = F.sum(F.when(F.col("pages") == 1, F.col("n")).otherwise(0))
    looks = (
        units.join(counts, ["host", "rank"])
        .groupBy("page")
        .agg(F.min(shared)["rank"].alias("rarest"), own.alias("own"), F.sum("n").alias("words"))
        .withColumn("differs", (F.col("own") >= RUN) | (10 * F.col("own") >= F.col("words")))
        .select("page", F.when(~F.col("differs"), F.col("rarest")).alias("rarest"))
    )
    marked = F.max(F.when(F.col("n") == MARKED, F.col("rank")))
    copies = F.count_if(F.col("n") == PAGE_KEY).alias("copies")
    streams = tokens.where(F.col("n").isin(PAGE_KEY, MARKED)).groupBy("host", "page").agg(marked.alias("marked"), copies)
    documents = streams.join(looks, "page", "left").select(
        "host", "page", F.coalesce("marked", "rarest", "page").alias("document"), F.isnull("marked").alias("open"), "copies"
    )
    documents = settle(documents, "page-documents")
    needed = F.greatest(F.lit(2), F.least(F.lit(SHARED), F.count_distinct("document")))
    number = F.pmod("document", F.lit(1 << 44)).alias("number")
    half = F.ceil(F.count_distinct("document") / 2)
    hosts = documents.groupBy("host").agg(
        needed.alias("needed"), F.greatest(F.lit(SHARED_INSIDE), half).alias("most"), F.sum("copies").alias("host_pages")
    )
    return documents.join(hosts, "host").select("page", number, "needed", "open", "most", "copies", "host_pages")


def _by_document(rows: DataFrame, name: list[str]) -> DataFrame:
    """The values of `name` that `needed` documents have, from rows with both; SHARED is 3 at most.

    With a the least and b the greatest number d of a document, (d - a)(d - b) sums to less than 0 if there is a
    third. Its sums combine in the map tasks, which a count of distinct documents does not.
    """
    d = F.col("number").cast("decimal(14,0)")
    low, high = F.col("low"), F.col("high")
    third = F.col("squares") - (low + high) * F.col("total") + low * high * F.col("n")
    return (
        rows.groupBy(*name)
        .agg(
            F.min(d).alias("low"), F.max(d).alias("high"), F.sum(d).alias("total"), F.sum(d * d).alias("squares"),
            F.count("*").cast("decimal(12,0)").alias("n"), F.max("needed").alias("needed"),
        )
        .where((low < high) & ((F.col("needed") < SHARED) | (third < 0)))
        .select(*name)
    )


def _inside_tokens(parsed: DataFrame) -> DataFrame:
    common = parsed.where(F.col("n") == COMMON).groupBy("host").agg(F.collect_set("rank").alias("common"))
    rows = parsed.where(F.col("n") == PAGE_KEY).select("host", "page", "zones", "text")
    found = rows.join(settle(common, "page-common"), "host")
    return settle(found.mapInArrow(_emit_inside, TOKEN), "page-inside")


def _inside_runs(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """(page, i): runs inside articles that most pages and documents of the host have."""
    name = ["host", "r1", "r2"]
    inside = pairs.where(F.col("i") >= INSIDE)
    of_name = pairs.join(inside.select(*name).distinct(), name, "left_semi").select(*name, "page").distinct()
    counts = (
        of_name.join(documents, "page")
        .groupBy(*name)
        .agg(
            F.count_distinct("number").alias("n"), F.sum("copies").alias("pages"),
            F.max("most").alias("most"), F.max("host_pages").alias("host_pages"),
        )
        .where((F.col("n") >= F.col("most")) & (2 * F.col("pages") >= F.col("host_pages")))
    )
    return inside.join(counts.select(*name), name, "left_semi").select("page", "i")


def repeated_runs(parsed: DataFrame) -> tuple[DataFrame, bool]:
    """(page, starts): where runs of RUN tokens begin that other documents of the host have too, and whether
    there are runs inside articles among them.

    A neutral block that they have as a whole is named by -1 - its number, a word inside articles by INSIDE +
    its number. Runs are counted over all pages; those outside articles are told to pages that mark none.
    """
    tokens = parsed.select("host", "page", "i", "rank", "n")
    inside = _inside_tokens(parsed)
    units = tokens.where(F.col("n") > 0).dropDuplicates(["page", "i"])
    documents = settle(_documents(tokens, units), "page-needed")
    now = tokens.where(F.col("n") == 0).unionByName(inside).drop("n").dropDuplicates(["page", "i"])
    h, found = 1, None
    facts = ["number", "needed", "open"]
    while h < RUN:
        last = 2 * h >= RUN
        if last:  # both sides lie by page, as the window needs them
            now = now.join(documents, "page")
        order = Window.partitionBy("page").orderBy("i")
        pairs = (
            now.withColumn("there", F.lead("i", h).over(order))
            .withColumn("r2", F.lead("rank", h).over(order))
            .where(F.col("there") == F.col("i") + h)
            .select("host", "page", "i", F.col("rank").alias("r1"), "r2", *(facts if last else []))
        )
        pairs = settle(pairs, "page-pairs")
        name = ["host", "r1", "r2"]
        if last:
            found = settle(_inside_runs(pairs, documents), "page-inside-runs")
            pairs = pairs.where(F.col("i") < INSIDE)
            shared = _by_document(pairs, name)
        else:
            shared = pairs.groupBy(*name).agg(F.min("page").alias("low"), F.max("page").alias("high"))
            shared = shared.where(F.col("low") < F.col("high")).select(*name)
        shared = shared.orderBy(*name)
        ranks = settle(shared.select(*name, F.monotonically_increasing_id().alias("rank")), "page-ranks")
        wanted = pairs.where("open") if last else pairs
        now = settle(wanted.join(ranks, name).select("host", "page", "i", "rank"), "page-runs")
        h *= 2
    units = units.join(documents, "page")
    whole = settle(_by_document(units, ["host", "rank"]), "page-blocks")
    starts = now.select("page", "i").unionByName(found).unionByName(
        units.where("open").join(whole, ["host", "rank"]).select("page", "i")
    )
    starts = starts.groupBy("page").agg(F.collect_list("i").alias("starts"))
    keys = tokens.where(F.col("n") == PAGE_KEY).select("page", F.col("rank").alias("key")).distinct()
    repeats = settle(keys.join(starts, "page").select(F.col("key").alias("page"), "starts"), "page-repeats")
    return repeats, not found.isEmpty()


def _undecided(found: list[tuple[int, str]]) -> bool:
    """Whether the page marks no article and has text that may be one."""
    return best_zone(found) == NEUTRAL and any(zone == NEUTRAL for zone, _ in found)


def _covered(n: int, starts: list[int]) -> np.ndarray:
    """How many of the first 0, 1, ..., n words stand in runs that begin at `starts`."""
    change = np.zeros(n + RUN + 1, dtype=np.int64)
    for start in starts:
        change[start] += 1
        change[start + RUN] -= 1
    return np.concatenate(([0], np.cumsum(np.cumsum(change)[:n] > 0)))


def page_text(found: list[tuple[int, str]], starts: list[int] | None) -> tuple[str, int]:
    """Main text of a page and how many blocks it leaves out; `starts` are its repeated runs and blocks."""
    zone = best_zone(found)
    if not starts:
        kept = [text for own, text in found if own == zone]
        return "\n".join(kept), len(found) - len(kept)
    repeated = {-1 - start for start in starts if start < 0}
    for inside in (False, True):
        ends = _words(found, inside)[1]
        first = INSIDE if inside else 0
        covered = _covered(ends[-1], [s - first for s in starts if s >= 0 and (s >= INSIDE) == inside])
        spans = zip([0, *ends], ends, strict=False)
        repeated |= {b for b, (x, y) in enumerate(spans) if y > x and covered[y] - covered[x] == y - x}
    mine = {b: text.count(" ") + 1 for b, (own, text) in enumerate(found) if own == zone}
    if zone < NEUTRAL and 2 * sum(mine[b] for b in repeated & mine.keys()) >= sum(mine.values()):
        repeated = set()
    kept = [found[b][1] for b in mine if b not in repeated]
    return "\n".join(kept), len(found) - len(kept)


def _result(ids: pa.Array, urls: pa.Array, found: list[tuple[str, int]]) -> pa.RecordBatch:
    texts = [t for t, _ in found]
    sizes = [len(t) for t in texts]
    return pa.RecordBatch.from_arrays(
        [ids, urls, pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array([n for _, n in found], pa.int64())],
        names=["page_id", "url", "text", "n_chars", "n_left_out"],
    )


def _emit_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        zones, texts = batch.column("zones").to_pylist(), batch.column("text").to_pylist()
        starts = batch.column("starts").to_pylist()
        found = [page_text(_blocks_of(z, t), s) for z, t, s in zip(zones, texts, starts, strict=True)]
        yield _result(batch.column("page_id"), batch.column("url"), found)


def main_text(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars, n_left_out (blocks that are not in the text)."""
    parsed = settle(_keyed(pages).mapInArrow(_emit_parsed, PARSED), "page-parsed", compression="zstd")
    repeats, inside = repeated_runs(parsed)
    own = parsed.where(F.col("n").isin(PAGE_KEY, NO_BLOCKS)).withColumn("page", F.col("rank"))
    own = own.select("page_id", "url", "zones", "text", "undecided", "page")
    told = own if inside else own.where("undecided")
    columns = ["page_id", "url", "zones", "text", "starts"]
    texts = told.join(repeats, "page", "left").select(*columns).mapInArrow(_emit_text, RESULT)
    if inside:
        return texts
    others = own.where(~F.col("undecided")).withColumn("starts", F.lit(None).cast("array<int>")).select(*columns)
    return others.mapInArrow(_emit_text, RESULT).unionByName(texts)

"""Every operator on small corpora against a plain form, and on empty tables."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.texts import LOWER, SPACE, WORD, cases, edited, prose, shingle_set
from zonalake.llm import (
    decontam, exact, lines, markup, mixing, neardup, pages, periodic, phrases, pieces, quality, suffixes, tokens, warc,
)
from zonalake.llm.queries import tokenizer_path

ITEM = "item_id long, text string"
PAGE = "page_id long, url string, html string"
LABEL = "doc_id long, quality int, toxic int"


def bag(rows):
    return Counter(tuple(r) for r in rows)


# -- exact copies ---------------------------------------------------------------------------------
def plain_keep(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups["".join(c for c in text or "" if c not in SPACE)].append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is not None, m[0] or 0))[0]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[0], keep, len(members), m[0] == keep, digest) for m in members]
    return bag(out)


@pytest.mark.parametrize("capacity", [exact.CAPACITY, 2_000])
def test_exact_copies(documents, capacity):
    found = exact.keep_flags(documents(cases(), extra=True), capacity).collect()
    assert bag(found) == plain_keep(cases())


def test_directory_splits_full_buckets_only(documents):
    rows = [(i, prose(i, 30)) for i in range(200)]
    entries = exact.entries(documents(rows))
    buckets = exact.directory(entries, 4_000).collect()
    sizes = Counter()
    for r in entries.collect():
        own = [b for b in buckets if not b.bits or (r["hash"] % 2**64) >> (64 - b.bits) == b.prefix]
        assert len(own) == 1
        sizes[own[0]] += len(r["norm"]) + 100
    assert len(sizes) > 4 and max(sizes.values()) <= 4_000


# -- near copies ----------------------------------------------------------------------------------
def plain_components(rows):
    sets = [(r[0], shingle_set(r[1])) for r in rows]
    parent = {key: key for key, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    smaller = lambda x: (x is not None, x or 0)
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            shared = len(x & y)
            if x and y and 100 * shared >= 75 * (len(x) + len(y) - shared):
                low, high = sorted((root(a), root(b)), key=smaller)
                parent[high] = low
    return bag((a, len(x), root(a), root(a) == a) for a, x in sets)


def test_near_copies(documents):
    found = neardup.near_components(documents(cases(), extra=True)).collect()
    assert bag(found) == plain_components(cases())


def test_rows_of_one_id_are_one_document(documents):
    """An id that stands in two groups joins them, whichever of its rows comes first."""
    a, b = prose(41, 40), prose(42, 40)
    rows = [(1, a), (2, b), (3, a), (3, b), (4, prose(43, 40)), (5, prose(43, 40)), (5, prose(44, 9))]
    assert bag(neardup.near_components(documents(rows)).collect()) == plain_components(rows)


def test_the_row_that_stays_does_not_depend_on_order(documents):
    rows = [(1, prose(i, 30)) for i in range(8)] + [(1, None)]
    found = {neardup.first_of_groups(documents(rows[i:] + rows[:i])).first().text for i in range(3)}
    assert len(found) == 1


def test_one_row_of_each_group_stays(documents):
    docs = documents(cases(), extra=True)
    kept = neardup.first_of_groups(docs)
    assert kept.columns == docs.columns
    wanted = {row[2] for row in plain_components(cases())}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(wanted)


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_buckets_are_compared_in_blocks(documents, monkeypatch, block):
    """Texts of a template, most of them below the similarity, whose links the stars leave open."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "STAR_ROUNDS", 1)
    base = prose(61, 120)
    rows = [(i, edited(base, i // 2, 7) + f" only {i}") for i in range(30)]
    rows += [(40 + i, edited(edited(base, i, 4), 900 + i // 4, 3)) for i in range(20)]
    assert bag(neardup.near_components(documents(rows)).collect()) == plain_components(rows)


def test_near_copies_around_the_threshold(documents):
    base = prose(9, 200)
    rows = [(i, " ".join(base.split(" ")[: 130 + i]) + " " + prose(500 + i, i % 7)) for i in range(60)]
    assert bag(neardup.near_components(documents(rows)).collect()) == plain_components(rows)


def test_odd_sketch_tells_similarity():
    draw = np.random.default_rng(1)
    common, own = draw.integers(0, 2**63, 800, dtype=np.uint64), draw.integers(0, 2**63, 200, dtype=np.uint64)
    both = [np.concatenate((common, own[:100])), np.concatenate((common, own[100:]))]
    minima = neardup.minhashes(np.concatenate(both), np.array([0, 900]))
    a, b = neardup.odd_sketches(minima)
    differing = int(np.bitwise_count(a ^ b).sum())
    estimate = 1 + neardup.SKETCH_BITS / (4 * neardup.SAMPLES) * np.log(1 - 2 * differing / neardup.SKETCH_BITS)
    assert abs(estimate - 0.8) < 0.12


# -- repeated substrings --------------------------------------------------------------------------
def plain_cut(rows):
    texts = [(r[1] or "").encode() for r in rows]
    n = suffixes.LENGTH
    seen = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for row, text in zip(rows, texts, strict=True):
        gone = np.zeros(len(text), dtype=bool)
        for i in range(len(text) - n + 1):
            if seen[text[i : i + n]] > 1:
                gone[i : i + n] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out.append((row[0], len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return bag(out)


def test_repeated_substrings(documents):
    found = suffixes.without_repeats(documents(cases(), extra=True)).drop("kept").collect()
    assert bag(found) == plain_cut(cases())


def test_repeats_just_at_the_length(documents):
    passage = prose(11, 200)[:800]
    rows = [(i, prose(300 + i, 40) + passage[40 : 440 + i - 4] + prose(400 + i, 40)) for i in range(9)]
    rows += [(50, passage), (51, "ab" * 700), (52, "x" + "ab" * 300), (53, passage + passage)]
    found = suffixes.without_repeats(documents(rows)).drop("kept").collect()
    assert bag(found) == plain_cut(rows)


def test_suffix_steps_send_documents_in_small_batches(spark, documents, monkeypatch):
    """A document comes with hundreds of runs and windows, so a worker never holds 10,000 of them at once."""

    def sizes(batches):
        for batch in batches:
            n, no = pa.array([batch.num_rows]), pa.nulls(1, pa.string())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([n, n, n, n, no, no.cast(pa.binary())], names=names)

    before = spark.conf.get(corpus_pipeline.BATCH_CONF)
    monkeypatch.setattr(suffixes, "_cut", sizes)
    docs = spark.range(0, 5_000, 1, 1).selectExpr("id doc_id", "'text' text")
    try:
        found = [row.n_bytes for row in suffixes.without_repeats(docs).collect()]
        spark.conf.set(corpus_pipeline.BATCH_CONF, 10)  # a session that has fewer keeps them
        assert max(row.n_bytes for row in suffixes.without_repeats(docs).collect()) <= 10
    finally:
        spark.conf.set(corpus_pipeline.BATCH_CONF, before)
    assert sum(found) == 5_000 and max(found) <= 1_000


def test_ranks_go_back_without_sorting_the_places(spark, documents):
    """The few values that occur again are hashed; sorting the places of a large table took an executor's heap."""
    pairs = spark.createDataFrame([(i, i % 4, i % 6) for i in range(20)] + [(20, 9, 9)], "id long, r1 long, r2 long")
    ranked = pairs.join(suffixes._ranked(pairs, ["r1", "r2"]), ["r1", "r2"])
    assert "ShuffledHashJoin" in ranked._jdf.queryExecution().executedPlan().toString()
    seen = Counter((i % 4, i % 6) for i in range(20))
    found = {(r.r1, r.r2): r.rank for r in ranked.collect()}
    assert found.keys() == {k for k, n in seen.items() if n > 1} and len(set(found.values())) == len(found)
    assert ranked.count() == sum(n for n in seen.values() if n > 1)


# -- lines ----------------------------------------------------------------------------------------
def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def plain_lines(rows):
    first = {}
    order = lambda x: (x is not None, x or 0)
    for doc_id, text in sorted(rows, key=lambda r: order(r[0])):
        for no, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                first.setdefault(line, (order(doc_id), no))
    near = {x for x in first for y in first if first[y] < first[x] and one_edit(x, y)}
    out = []
    for doc_id, text in rows:
        all_lines = (text or "").split("\n")
        kept = [
            line for no, line in enumerate(all_lines)
            if not line.strip(" ") or (first[line] == (order(doc_id), no) and line not in near)
        ]
        out.append((doc_id, len(all_lines), len(kept), "\n".join(kept)))
    return bag(out)


def test_lines(documents):
    rows = [
        (1, None), (2, ""), (3, "alpha beta\n\nalpha betas\nalpha beta"), (4, "alpha bet\nlpha beta\nalphabet"),
        (5, "xalpha beta\nalpha betaé"), (6, "é\nè\nab\na\n \nb"), (7, "completely different line\n" * 3),
        (8, "completely different lime"), (9, "ompletely different limes"), (None, "alpha beta\nzz"),
    ]
    assert bag(lines.kept_lines(documents(rows, extra=True)).collect()) == plain_lines(rows)


def test_lines_of_all_cases(documents):
    rows = [r[:2] for r in cases() if r[0] not in (7, 9, None)]
    assert bag(lines.kept_lines(documents(rows)).collect()) == plain_lines(rows)


def test_long_lines_one_edit_apart(documents):
    """Edits at both ends, inside, at the borders of parts and in repeated characters; two edits."""
    def changed(line, at, how):
        return line[:at] + ("" if how == "cut" else "é" + (line[at:at + 1] if how == "put" else "")) + line[at + 1 :]

    rows = []
    for n in (15, 16, 17, 40, 272):
        line = prose(n, n).replace("\n", " ")[:n] if n != 40 else "a" * 40
        rows.append((len(rows), line))
        for at in {0, 1, n // 16, n // 2, n - 2, n - 1}:
            for how in ("cut", "put", "set"):
                rows.append((1000 + len(rows), f"{at} {how} {n} " + changed(line, at, how)))
                rows.append((1000 + len(rows), changed(line, at, how)))
    far = "".join(chr(97 + i * i % 23) for i in range(300))
    rows += [(1, far), (2, changed(changed(far, 5, "set"), 280, "cut")), (3, changed(far, 150, "cut"))]
    assert bag(lines.kept_lines(documents(rows)).collect()) == plain_lines(rows)
    long = "".join(chr(97 + i * i % 25) for i in range(1 << 13))
    rows = [(1, long), (2, changed(long, 7_001, "cut")), (3, changed(changed(long, 3, "set"), 8_000, "set"))]
    found = {r.doc_id: r.n_kept for r in lines.kept_lines(documents(rows)).collect()}
    assert found == {1: 1, 2: 0, 3: 1}


# -- test items -----------------------------------------------------------------------------------
def test_decontamination(spark, documents):
    items = [(i, prose(900 + i, n)) for i, n in enumerate((3, 5, 12, 40, 70, 200))] + [(8, None), (9, "")]
    items += [(10, items[3][1])]
    long_text = prose(31, 4000)
    rows = cases() + [(200 + i, long_text[: 3000 * i] + " " + t + " " + long_text) for i, t in items[1:6]]
    rows += [(300, items[0][1]), (301, " ".join(items[4][1].split()[:58])), (302, " ".join(items[4][1].split()[:50]))]
    wanted = set()
    for doc_id, text, *_ in rows:
        own = shingle_set(text)
        for item, wording in items:
            need = shingle_set(wording)
            if need and len(need & own) >= 0.75 * len(need):
                wanted.add((doc_id, item))
    docs, tests = documents(rows, extra=True), spark.createDataFrame(items, ITEM)
    found = decontam.contained_items(docs, tests).select("doc_id", "item_id").collect()
    assert {tuple(r) for r in found} == wanted and len(wanted) >= 8
    dirty = {doc_id for doc_id, _ in wanted}
    clean = decontam.clean_rows(docs, tests)
    assert clean.columns == docs.columns
    assert bag([r.doc_id] for r in clean.collect()) == bag([r[0]] for r in rows if r[0] not in dirty)


def test_short_items_in_long_documents(spark, documents):
    items = [(i, prose(20_000 + i, 5 + i % 5)) for i in range(400)]
    pieces = [prose(30_000 + i, 40) for i in range(60)]
    rows = []
    for i, wording in items:  # the whole item; for those of 8 words, with the last of four shingles broken
        words = wording.split()
        planted = " ".join([*words[:-1], "other"] if len(words) == 8 and i % 2 else words)
        rows.append((i, " ".join([*pieces[i % 7 :], planted, *pieces[: i % 60]])))
    wanted = {(i, i) for i, _ in items}
    docs, tests = documents(rows), spark.createDataFrame(items, ITEM)
    found = decontam.contained_items(docs, tests)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == wanted
    assert decontam.clean_rows(docs, tests).count() == 0


# -- quality --------------------------------------------------------------------------------------
def test_quality(spark, documents):
    rows = [(i, prose(i, 60 + i)) for i in range(300)]
    rows += [(1000 + i, " ".join(w + "***" for w in prose(i, 60).split())) for i in range(300)]
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000), 0) for r in rows], LABEL)
    more = [(5000, None), (5001, ""), (5002, prose(1, 40_000)), (None, "x")]
    found = {r.doc_id: r for r in quality.quality_scores(documents(rows + more, extra=True), labels).collect()}
    assert len(found) == len(rows) + len(more)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(found[r[0]].held_out for r in held) and held
    right = sum(found[r[0]].predicted == int(r[0] < 1000) for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found.values())
    kept = {r.doc_id for r in quality.accepted_rows(documents(rows), labels).collect()}
    assert kept == {r[0] for r in rows if found[r[0]].predicted}


def test_quality_without_labels(spark, documents):
    labels = spark.createDataFrame([], LABEL)
    found = quality.quality_scores(documents(cases()), labels).collect()
    assert len(found) == len(cases()) and all(r.score == 1 for r in found)


# -- archives -------------------------------------------------------------------------------------
def test_archives_round_trip(spark, documents):
    rows = [
        (1, "http://a.b/c?d=é f", "<p>x</p>"), (2, None, None), (3, "u", ""), (4, "http://h/", "<p>x</p>"),
        (4, "http://h/", "<p>x</p>"), (None, "http://h/2", "é" * 100_000), (6, "http://h/3", "é" * 100_000),
    ]
    least = {}
    for page_id, _, html in rows:
        key = (page_id is not None, page_id or 0)
        least[html or ""] = min(least.get(html or "", key), key)
    wanted = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        first = least[html or ""] == (page_id is not None, page_id or 0)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        refers = None if first or not least[html or ""][0] else least[html or ""][1]
        wanted.append((page_id, len(payload), digest, "response" if first else "revisit", refers))
    frame = spark.createDataFrame(rows, PAGE).selectExpr("*", "'x' AS sha1", "1 AS first")
    assert bag(warc.warc_report(frame).collect()) == bag(wanted)


# -- pages ----------------------------------------------------------------------------------------
ARTICLE = (
    "<html><head><title>no</title><script>var a='<p>no</p>'</script></head><body class='no-sidebar'>"
    "<header><h1>Site</h1></header><nav><a>no</a></nav><div class='cookie-notice'>no</div>"
    "<article><h1>Head &amp; line</h1><p>One  <b>two</b>\nthree<p>Four&nbsp;&#8211; five"
    "<div class=ad>no</div><aside>no</aside><form><p>no</form><!-- <p>no --></article>"
    "<section id='comments'><article class=comment><p>no</article></section><footer>no</footer>"
)
MENU = "<div>home of all the many things that we ever sold here</div>"


def test_main_text(spark, documents):
    rows = [(1, "http://h/1", ARTICLE), (2, "http://h/2", None), (3, None, ""), (4, "http://h/4", "plain text")]
    rows += [(i, f"http://k/{i}", f"{MENU}<p>{prose(i, 20)}</p>{MENU}") for i in (10, 11, 12)]
    rows += [(20, "http://other/", f"{MENU}<p>{prose(20, 20)}</p>"), (None, "x", "<div><p>a<div>b")]
    frame = spark.createDataFrame(rows, PAGE).selectExpr("*", "'x' AS host", "1 AS page")
    found = {r.page_id: (r.text, r.n_chars) for r in pages.main_text(frame).collect()}
    plain = lambda i: " ".join(prose(i, 20).split())
    menu = MENU.removeprefix("<div>").removesuffix("</div>")
    wanted = {1: "Head & line\nOne two three\nFour – five", 2: "", 3: "", 4: "plain text", None: "a\nb"}
    wanted |= {i: plain(i) for i in (10, 11, 12)} | {20: menu + "\n" + plain(20)}
    assert found == {k: (t, len(t)) for k, t in wanted.items()}


def test_mirrored_pages_and_short_menus(spark, documents):
    short = ["home", "our shop", "all news"]
    menu = "".join(f"<div>{t}</div>" for t in short)
    rows = [(i, f"http://k/{i}", f"{menu}<p>{prose(i, 30)}</p>{menu}") for i in range(6)]
    rows += [(100 + i, f"http://k/again/{i}", html) for i, (_, _, html) in enumerate(rows[:3])]  # under two urls
    rows += [(103, "http://k/0", rows[0][2])]  # and crawled again
    # three versions of a page that differ in a few words, and two pages that quote one paragraph
    rows += [(200 + i, f"http://k/v/{i}", f"{menu}<p>{prose(50, 60)}</p><p>version {i}</p>") for i in range(3)]
    rows += [(300 + i, f"http://k/q/{i}", f"<p>{prose(60, 20)}</p><p>{prose(70 + i, 20)}</p>{menu}") for i in range(2)]
    rows += [(400 + i, f"http://two/{i}", f"<p>{prose(80, 30)}</p>") for i in range(2)]  # nothing else on the host
    frame = spark.createDataFrame(rows, PAGE)
    plain = lambda i, n: " ".join(prose(i, n).split())
    wanted = {i: plain(i, 30) for i in range(6)} | {100 + i: plain(i, 30) for i in range(3)} | {103: plain(0, 30)}
    wanted |= {200 + i: f"{plain(50, 60)}\nversion {i}" for i in range(3)}
    wanted |= {300 + i: f"{plain(60, 20)}\n{plain(70 + i, 20)}" for i in range(2)}
    wanted |= {400 + i: plain(80, 30) for i in range(2)}
    assert {r.page_id: r.text for r in pages.main_text(frame).collect()} == wanted


def test_suffix_spans_merge():
    """Spans that follow one another become one; a gap, another flag or another document begins a new one."""
    lists = [[(5, 6, True), (0, 3, False), (4, 4, False)], [], [(7, 9, False), (11, 12, False)], [(13, 14, False)]]
    spans = [[dict(zip(("first", "last", "chosen"), x, strict=True)) for x in spans] for spans in lists]
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("chosen", pa.bool_())]))
    columns = [pa.array([1, 2, 3, 4]), pa.array([0] * 4), pa.array(spans, kind)]
    batch = pa.RecordBatch.from_arrays(columns, names=["id", "tag", "covered"])
    (found,) = suffixes._merge(iter([batch]))
    merged = [[tuple(s.values()) for s in spans] for spans in found.column("covered").to_pylist()]
    assert merged == [[(0, 4, False), (5, 6, True)], [], [(7, 9, False), (11, 12, False)], [(13, 14, False)]]


def test_suffix_work_tables_go_when_they_are_used(spark, documents):
    import glob

    from zonalake.session import shared_root

    left = lambda: set(glob.glob(f"{shared_root(spark).removeprefix('file:')}/zonalake-suffix-*"))
    before = left()
    rows = [(1, prose(1, 300)), (2, prose(1, 300) + " end"), (3, prose(3, 100))]
    suffixes.without_repeats(documents(rows)).collect()
    labels = {path.rsplit("-", 1)[0].rsplit("/", 1)[1] for path in left() - before}
    assert "zonalake-suffix-facts" in labels
    gone = ("anchors", "phrases", "pairs", "ranks", "level", "outer", "inner", "spans", "edges")
    assert not labels & {f"zonalake-suffix-{name}" for name in gone}


def test_notices_inside_articles(spark, documents):
    """A passage that half of a host's articles have is boilerplate; what few quote, and versions, stay whole."""
    plain = lambda i, n: " ".join(prose(i, n).split())
    notice, quote, heading = plain(900, 12), plain(901, 15), "what to know"
    page = lambda *own: "<article>" + "".join(f"<p>{t}</p>" for t in own) + "</article>"
    own = {i: [heading, plain(i, 40), *([notice] if i != 4 else []), plain(100 + i, 30)] for i in range(14)}
    own |= {i: [*own[i], quote] for i in range(3)}
    rows = [(i, f"http://k/{i}", page(*texts)) for i, texts in own.items()]
    rows += [(20, "http://k/20", page(notice))]
    rows += [(30 + i, f"http://v/{i}", page(plain(50, 60), f"version {i}")) for i in range(5)]
    rows += [(40 + i, f"http://few/{i}", page(plain(60 + i, 40), notice)) for i in range(5)]
    wanted = {i: "\n".join(t for t in texts if t != notice) for i, texts in own.items()} | {20: notice}
    wanted |= {30 + i: f"{plain(50, 60)}\nversion {i}" for i in range(5)}
    wanted |= {40 + i: f"{plain(60 + i, 40)}\n{notice}" for i in range(5)}
    frame = spark.createDataFrame(rows, PAGE).repartition(3)
    assert {r.page_id: r.text for r in pages.main_text(frame).collect()} == wanted


def test_pages_are_parsed_once(spark, documents):
    """Later passes read the blocks that the first one wrote: no plan but the first has the html."""
    page = f"<p>{prose(1, 20)} a &amp; b</p>\u00a0<article><p>{prose(2, 9)}<li>x</article>"
    rows = [(1, "http://h/1", page), (2, "http://h/2", f"<p>{prose(3, 30)}"), (3, "http://h/3", None)]
    found = pages.main_text(spark.createDataFrame(rows, PAGE))
    assert "html" not in found._jdf.queryExecution().toString()
    wanted = [pages.page_text(markup.blocks(html or ""), None)[0] for _, _, html in rows]
    assert [r.text for r in found.orderBy("page_id").collect()] == wanted


def test_page_words_are_hashed_as_they_stand(documents):
    """Words, blocks and pages of joined texts are those of a plain split; a page is read back as it was parsed."""
    htmls = [f"<nav>a b</nav><article><p>{prose(i, 12)}</p><p>b</article>c" for i in range(3)] + ["", "\u00e9 a"]
    parsed = [markup.blocks(html) for html in htmls]
    names, kinds = ["page_id", "url", "html", "host", "page"], [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    columns = [range(5), ["u"] * 5, htmls, [7] * 5, range(5)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
    rows = [r for b in pages._emit_parsed(iter([batch])) for r in b.to_pylist()]
    own = {r["rank"]: r for r in rows if r["n"] in (pages.PAGE_KEY, pages.NO_BLOCKS)}
    assert [pages._blocks_of(own[k]["zones"], own[k]["text"]) for k in range(5)] == parsed
    words = [w for found in parsed for _, text in found for w in text.split(" ")]
    hashes, block = pages._words_of([own[k]["text"].encode() for k in range(5) if parsed[k]])
    hash_of = dict(zip(words, hashes.tolist(), strict=True))
    assert len(hash_of) == len(set(words)) == len(set(hash_of.values()))
    assert [hash_of[w] for w in words] == hashes.tolist()
    assert np.bincount(block).tolist() == [len(text.split(" ")) for found in parsed for _, text in found]
    tokens = {(r["page"], r["i"]): r["rank"] for r in rows if r["n"] == 0}
    assert tokens == {
        (own[k]["page"], i): hash_of[w] for k in range(5) for i, w in enumerate(pages._words(parsed[k])[0])
    }
    common = {r["rank"] for r in rows if r["n"] == pages.COMMON}
    texts = [set(" ".join(text for _, text in found).split(" ")) for found in parsed if found]
    assert common == {hash_of[w] for w in words if 2 * sum(w in t for t in texts) >= len(texts)}


def plain_main_text(rows):
    """Texts of pages `(id, host, marked, blocks)` by a search of all runs of eight words."""
    runs, wholes, documents = {}, {}, {}
    for page, host, marked, own in rows:
        words = " ".join(own).split()
        documents.setdefault(host, set()).add(marked or page)
        for i in range(len(words) - pages.RUN + 1):
            runs.setdefault((host, tuple(words[i : i + pages.RUN])), set()).add(marked or page)
        for text in own:
            wholes.setdefault((host, text), set()).add(marked or page)
    found = {}
    for page, host, marked, own in rows:
        needed = max(2, min(pages.SHARED, len(documents[host])))
        words, covered = " ".join(own).split(), set()
        for i in range(len(words) - pages.RUN + 1):
            if len(runs[host, tuple(words[i : i + pages.RUN])]) >= needed:
                covered.update(range(i, i + pages.RUN))
        kept, begin = [], 0
        for text in own:
            end = begin + len(text.split())
            if not covered.issuperset(range(begin, end)) and len(wholes[host, text]) < needed:
                kept.append(text)
            begin = end
        found[page] = marked or "\n".join(kept)
    return found


def test_repeated_runs_equal_a_plain_search(spark, documents):
    draw = random.Random(5)
    pool = [" ".join(draw.choice("abcd") for _ in range(draw.randint(1, 14))) for _ in range(12)]
    rows = []
    for i in range(90):
        own = [draw.choice(pool) for _ in range(draw.randint(1, 6))]
        own.insert(draw.randint(0, len(own)), " ".join(prose(1000 + i, 40).split()))
        rows.append((i, f"h{i % 7 if i < 60 else 9}", f"article {i // 2}" if i % 5 == 0 else "", own))
    rows += [(100, "two", "", [pool[0], "x1 " * 30 + "x"]), (101, "two", "", ["y1 " * 30 + "y", pool[0]])]
    html = lambda marked, own: f"<article>{marked}</article>" * bool(marked) + "".join(f"<p>{t}</p>" for t in own)
    frame = spark.createDataFrame([(i, f"http://{host}/{i}", html(m, own)) for i, host, m, own in rows], PAGE)
    assert {r.page_id: r.text for r in pages.main_text(frame).collect()} == plain_main_text(rows)


def test_elements_that_are_left_out():
    text = lambda html: " ".join(t for _, t in markup.blocks(html))
    icon = "<svg viewBox='0 0 1 1' class=\"a>b\"/>"
    assert text(f"<p>one {icon} two</p><p>three") == "one two three"
    assert text(f"<p>one {icon} two</p><svg><title>no</title>no</svg><p>three") == "one two three"
    assert text("<p>one <svg class=x> two</p><svg><svg>no</svg>no</svg><p>three") == "one two three"
    assert text("<p>one</p><audio-player src=x>two</audio-player><select-box/><p>three") == "one two three"
    assert text("<p>one</p><iframe src=x><p>two<iframe src=http://y/>no</iframe> <title>three") == "one two three"
    assert text("one<select><option>no</select> two<textarea><script></textarea> three") == "one two three"
    assert text("one<script src=x /><p>two</p><script>no</script><p>three") == "one two three"
    assert text("one<script>if (a <b) '</scripts>'</script> two<style>no") == "one two"
    assert text(f"<p data-x=\"{'y' * 5000}>no\" title='{'>' * 9000}'>one</p><a href=\"x\"\">two</a> three") == "one two three"
    assert text("<p title=\"never closed>one</p>") == "one"


# -- token shards ---------------------------------------------------------------------------------
def test_token_shards(documents):
    from tokenizers import Tokenizer

    rows = cases() + [(99, "tab\tand   odd space  two\n\n line <|endoftext|> x"), (98, " lead"), (97, "end  ")]
    coder = Tokenizer.from_file(tokenizer_path())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    wanted, start = [], 0
    for r in order:
        ids = [*coder.encode(r[1] or "", add_special_tokens=False).ids, 0]
        wanted.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = tokens.token_report(documents(rows, extra=True), tokenizer_path())
    assert bag(found.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == bag(wanted)


def test_perfect_hash():
    keys = np.random.default_rng(3).integers(-(2**62), 2**62, 5_000)
    repeats = np.zeros(5_000, np.uint32)
    index = tokens.PerfectHash.from_bytes(tokens.PerfectHash.build(keys, repeats).to_bytes())
    assert sorted(index.slots(keys, repeats)) == list(range(5_000))
    empty = tokens.PerfectHash.build(keys[:0], repeats[:0])
    assert list(empty.slots(keys[:2], repeats[:2])) == [-1, -1]


def test_encoder_equals_the_tokenizer_on_odd_texts():
    coder = tokens.encoder(tokenizer_path())
    texts = [" a", "a ", "a  b", "\n\na", "a\n b", "a \n b", "don't 've", "a\r\nb", "　a b", "1 2  3", "   ", "é́ ß"]
    plain = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert coder.encode(texts) == [np.array([*e.ids, 0], coder.dtype).tobytes() for e in plain]


def test_encoder_equals_the_tokenizer_on_random_strings():
    """What stands at cuts: apostrophes, white space of all kinds, letters and numbers beyond ASCII."""
    import random

    some = ["a", "B", "zé", "é", "1", "23", "½", "'", "'s", "'ll", "'T", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n"]
    some += [".", "!?", "(", "\u00a0", "\u2003", "\u3000", "\x85", "\u2028", "р", "а", "中", "文", "\u0301", "😀", "<|"]
    some += ["<|endoftext|>", "_", "-", "\x1c", "\x00", "’", "“", " the", "word", "²", "x" * 5_000]
    coder, draw = tokens.Encoder(tokenizer_path()), random.Random(11)
    for _ in range(20):
        texts = ["".join(draw.choice(some) for _ in range(draw.randint(0, 14))) for _ in range(200)]
        plain = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert coder.encode(texts) == [np.array([*e.ids, 0], coder.dtype).tobytes() for e in plain]


# -- the pipeline ---------------------------------------------------------------------------------
def test_pipeline_takes_every_decision(spark, tmp_path):
    """All stages against what the operators' plain forms say about the survivors of each."""
    good = [(i, prose(i, 60 + i % 40), f"s{i % 3}") for i in range(240)]
    junk = [(1000 + i, " ".join(w + "***" for w in prose(i, 60).split()), "s0") for i in range(120)]
    copies = [(2000 + i, edited(good[i][1], i, 1), "s1") for i in range(0, 40, 2)]
    item = prose(77_000, 30)
    leaks = [(3000 + i, prose(4000 + i, 50) + " " + item + " " + prose(5000 + i, 50), "s2") for i in range(5)]
    rows = [(i, t, "en", s, len(t)) for i, t, s in good + junk + copies + leaks]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    labels = [(r[0], int(r[0] < 1000), 0) for r in rows if r[0] < 2000]
    spark.createDataFrame(labels, LABEL).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], ITEM).write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{tmp_path}/stage{len(seen)}")
        docs = spark.read.parquet(f"{tmp_path}/stage{len(seen)}")
        seen.append([tuple(r) for r in docs.collect()])
    ids = [{r[0] for r in stage_rows} for stage_rows in seen]
    assert not ids[0] & {r[0] for r in junk}
    assert len(ids[0] & {r[0] for r in good}) >= 0.97 * len(good)
    assert ids[1] == {c for _, n, c, _ in plain_components(seen[0])}
    assert ids[2] == {r[0] for r in seen[1] if item not in r[1]} and len(ids[2]) < len(ids[1])
    mixed_ids = Counter(r[0] for r in seen[3])
    assert set(mixed_ids) <= ids[2] and max(mixed_ids.values()) <= 3
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in final) == mixed_ids
    order = sorted(final, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted(mixed_ids.elements())


# -- mixing ---------------------------------------------------------------------------------------
def test_stages_send_texts_in_small_batches(spark, documents, monkeypatch):
    """A Python worker never holds Spark's default of 10,000 texts at once."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    before = spark.conf.get(corpus_pipeline.BATCH_CONF)
    monkeypatch.setattr(corpus_pipeline.tokens, "token_report", lambda docs, _: docs.mapInArrow(sizes, "n bigint"))
    docs = spark.range(0, 5_000, 1, 1).selectExpr("id doc_id", "'text' text")
    try:
        found = [row.n for row in corpus_pipeline.token_output(spark, docs, "").collect()]
    finally:
        spark.conf.set(corpus_pipeline.BATCH_CONF, before)
    assert sum(found) == 5_000 and max(found) <= 1_000


def test_mixing(documents):
    rows = cases() + [(1000 + i, prose(i, 20 + i % 9), ["hot", None, "a"][i % 3]) for i in range(300)]
    frame = documents(rows, extra=True)
    found = mixing.mix_report(frame).collect()
    assert bag(found) == bag(mixing.mix_report(documents(rows).repartition(1)).collect())
    sizes, targets, taken = Counter(), {}, Counter()
    by_row = Counter()
    for (doc_id, text, source), n in Counter(rows).items():
        sizes[source] += n * len([w for w in (text or "").translate(str.maketrans(SPACE, " " * 6)).split(" ") if w])
        by_row[doc_id] += n
    source_of = {r[0]: r[2] for r in rows}
    for r in found:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and 0 <= r.taken <= 3 * r.size
        targets[source] = r.target
        taken[source] += r.taken
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for source, target in targets.items():
        largest = max(r.size for r in found if source_of[r.doc_id] == source)
        assert target <= 3 * sizes[source] and abs(taken[source] - target) <= largest
    mix = mixing.mix_rows(frame)
    assert mix.columns == frame.columns
    assert sum(len((r.text or "").split()) for r in mix.collect()) == sum(taken.values())


def test_targets_are_a_water_level(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 90)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    level = (1600 - 30) / (2 + 1 + 5)
    assert found["a"] == 30 and found[None] == pytest.approx(270)
    level = (1600 - 30 - 270) / (2 + 1)
    assert found["b"] == pytest.approx(2 * level) and found["c"] == pytest.approx(level)


# -- empty tables ---------------------------------------------------------------------------------
def test_empty_tables(spark, documents):
    docs, items = documents([]), spark.createDataFrame([], ITEM)
    web, labels = spark.createDataFrame([], PAGE), spark.createDataFrame([], LABEL)
    results = [
        exact.keep_flags(docs), neardup.near_components(docs), neardup.first_of_groups(docs),
        suffixes.without_repeats(docs), lines.kept_lines(docs), decontam.contained_items(docs, items),
        quality.quality_scores(docs, labels), quality.accepted_rows(docs, labels), warc.warc_report(web),
        pages.main_text(web), tokens.token_report(docs, tokenizer_path()), mixing.mix_report(docs),
        mixing.mix_rows(docs),
    ]
    for frame in results:
        assert frame.collect() == [] and frame.columns


# -- periodic runs --------------------------------------------------------------------------------
def plain_runs(words, least):
    """All maximal repetitions by trying every period; a stretch's smallest period is the first found."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j + p - i >= least:
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted(((a, length, p) for (a, length), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_run_report(rows):
    out = []
    for doc_id, text, *_ in rows:
        words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if doc_id is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = plain_runs(words, 12)
        gone = {i for a, length, p in found for i in range(a + p, a + length)}
        best = min(((-length, a, p) for a, length, p in found), default=None)
        lines_of = "".join(f"{a},{length},{p}\n" for a, length, p in found)
        collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
        if not (doc_id is not None and h % 10 == 0) and text is None:
            collapsed = ""
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines_of, collapsed)]
        shown = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        out.append((doc_id, len(found), *shown, *digests))
    return bag(out)


def periodic_rows():
    draw = np.random.default_rng(3)
    rows = [(1000 + i, prose(i, 40 + i)) for i in range(60)]
    for i in range(60):
        cycle = [f"w{x}" for x in draw.integers(0, 4, draw.integers(1, 30))]
        rows.append((2000 + i, " ".join((prose(i, 20).split() + cycle * 4)[: draw.integers(12, 120)]) + "\n" + prose(i, 9)))
    rows += [(3000 + i, " ".join(f"{x}" for x in draw.integers(0, 2, 80))) for i in range(30)]
    return rows


def test_runs_of_numbers():
    draw = np.random.default_rng(7)
    for _ in range(400):
        s = draw.integers(0, draw.integers(1, 4) + 1, draw.integers(1, 45))
        assert [tuple(r) for r in periodic.runs_of(s, 2).tolist()] == plain_runs(s.tolist(), 2)


def test_periodic_runs(documents):
    rows = cases() + periodic_rows()
    found = periodic.run_report(documents(rows, extra=True)).collect()
    assert bag(found) == plain_run_report(rows)
    assert sum(r.n_runs > 0 for r in found) > 60


def test_periodic_text_of_some_megabytes(documents):
    text = " ".join(["a", "b", "c", "a", "b"] * 30_000) + " " + "x" * 2_000_000
    found = periodic.with_runs(documents([(1, text)])).first()
    assert [tuple(r) for r in found.runs] == [(0, 150_000, 5)]
    assert found.collapsed == "a b c a b " + "x" * 2_000_000


# -- phrases --------------------------------------------------------------------------------------
def plain_collocations(rows, top, threshold):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n, kept = sum(c for phrase, c in f.items() if len(phrase) == 1), []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < threshold:
                continue
            over = [c for x, c in f.items() if len(x) == 3 and len(phrase) == 2 and c >= threshold and phrase in (x[:2], x[1:])]
            if any(100 * c >= 50 * a for c in over):
                continue
            cuts = [(1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return bag(out)


def phrase_rows():
    draw = np.random.default_rng(11)
    vocabulary = ["the", "Of", "new", "york", "é", "x-y", "a'b", "city"]
    rows = [(None, None, None), (1, "", "en"), (2, ". , \n", "en"), (3, "one", None)]
    for i in range(150):
        words = draw.choice(vocabulary, draw.integers(1, 30), p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05])
        text = "".join(w + str(draw.choice([" ", " ", "\t", ", ", "\n", "  "])) for w in words)
        rows.append((i % 120, text, [None, "en", "a\nb c"][i % 3]))
    rows += [(500 + i, "the new york city", "en") for i in range(30)] * 2
    return rows


@pytest.mark.parametrize(("shards", "bits"), [(1, 1 << 27), (2, 1 << 27), (5, 1 << 27), (3, 64)])
def test_collocations(spark, documents, shards, bits):
    """With a filter of 64 bits nearly all phrases are active at once; the counts stay right."""
    rows = phrase_rows()
    docs = documents([(1, "x")], extra=True).limit(0)
    new = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    docs = docs.unionByName(new, allowMissingColumns=True)
    found = phrases.collocations(docs, top=12, shards=shards, most_bits=bits).collect()
    assert bag(found) == plain_collocations(rows, 12, 10)


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000
    counts = spark.createDataFrame(
        [("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, 3 * big)],
        "lang string, phrase string, words int, n long",
    )
    assert phrases.scored(counts).first().score == 1_000_000 * big * big // ((big + 1) * 3 * big)


# -- pieces ---------------------------------------------------------------------------------------
def piece_texts():
    draw = np.random.default_rng(5)
    alphabet = list("aābeé ttinger  \n\t▁▁.,()'-0123😀漢字ßñ́­‍\x00")
    odd = ["".join(draw.choice(alphabet, draw.integers(0, 60))) for _ in range(3_000)]
    return odd + ["a" * 5_000, " " * 3_000, "▁" * 70 + "x", "ab" * 4_000, "<0x41></s><s>"] + [r[1] or "" for r in cases()]


def test_pieces_equal_the_library():
    model = pieces.pieces(tokenizer_path("piece_bpe_32k.model"))
    texts = piece_texts()
    expected = model.library.encode(texts, num_threads=1)
    found = [np.frombuffer(ids, np.int32).tolist() for ids in model.encode(texts)]
    assert found == expected


def test_pieces_forget(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    model = pieces.Pieces(tokenizer_path("piece_bpe_32k.model"))
    texts = piece_texts()[:300]
    for at in range(0, 300, 30):
        expected = model.library.encode(texts[at : at + 30], num_threads=1)
        assert [np.frombuffer(i, np.int32).tolist() for i in model.encode(texts[at : at + 30])] == expected
    assert len(model.recent) <= 40


def test_piece_report(documents):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = cases() + [(900, "é x" * 700_000)]
    wanted = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", num_threads=1)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        wanted.append((doc_id, len(ids), *sha))
    docs = documents(rows, extra=True)
    assert bag(pieces.piece_report(docs, path).collect()) == bag(wanted)
    both = pieces.decoded(pieces.encoded(docs, path), path)
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in both.collect())


def test_new_operators_on_empty_tables(documents):
    empty = documents([(1, "x")]).limit(0)
    path = tokenizer_path("piece_bpe_32k.model")
    for found in (periodic.run_report(empty), phrases.collocations(empty), pieces.piece_report(empty, path)):
        assert found.collect() == []


# -- tasks that read what others wrote ------------------------------------------------------------
def test_packages_and_shards_are_read_by_as_many_tasks(spark, documents):
    pages_of = spark.createDataFrame([(i, "http://h/", f"<p>{i}</p>") for i in range(40)], PAGE).repartition(5)
    packages = warc.write_packages(pages_of)
    read = warc.read_packages(packages)
    assert packages.count() == 5 == read.rdd.getNumPartitions() and read.count() == 40
    docs = documents([(i, prose(i, 5)) for i in range(40)])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = tokens.write_shards(docs, tokenizer_path())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert shards.count() > 4
    found = tokens.read_shards(shards)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"{shards.count()}), REPARTITION_BY_NUM" in plan and found.count() == 40


def test_encoder_forgets_and_looks_at_the_pre_tokenizer(monkeypatch, tmp_path):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "REMEMBERED", 30)
    texts = [prose(i, 40) for i in range(40)] + ["don't  stop\n\nnow", "y" * 300]
    spaced = Tokenizer.from_file(tokenizer_path()).to_str().replace('"add_prefix_space":false', '"add_prefix_space":true')
    (tmp_path / "spaced.json").write_text(spaced)
    for path in (tokenizer_path(), str(tmp_path / "spaced.json"), tokenizer_path("word_bpe_49k.json")):
        coder, plain = tokens.Encoder(path), Tokenizer.from_file(path)
        for at in range(0, len(texts), 7):
            wanted = [e.ids + [0] for e in plain.encode_batch(texts[at : at + 7], add_special_tokens=False)]
            found = [np.frombuffer(ids, coder.dtype).tolist() for ids in coder.encode(texts[at : at + 7])]
            assert found == wanted
        assert len(coder.pieces.recent) < 400


def test_powers_of_long_texts_are_not_kept():
    from zonalake.llm import hashing

    hashing.powers(0, hashing.KEPT + 5)
    up, down = hashing.powers(0, 100)
    assert all(len(x) <= hashing.KEPT for tables in hashing._powers.values() for x in tables)
    assert (up * down == 1).all()


# -- attributes and nested articles ---------------------------------------------------------------
@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<p title='hidden gems of Paris'>one</p>", "one"),
        ("<p data-hidden='false'>one</p><p hidden>no</p><p aria-hidden=true>no</p>", "one"),
        ("<div data-id='related'>one</div><div id=related>no</div>", "one"),
        ("<p>see <a alt='aria hidden' href=x>link</a> here</p>", "see link here"),
        ("<p>one</p><aside><article>related card</article></aside>", "one"),
        ("<main>one</main><div class='sidebar'><article>teaser</article></div>", "one"),
        ("<div class='content-share-of-market'><p>one</p></div>", "one"),
        ("<div id='notice-of-meeting'><p>one</p></div><div class='cookie-notice'>no</div>", "one"),
        ("<header><nav>menu<article><p>one</p></article>", "one"),
        ("<div class='widget-box'><article>one</article></div>", "one"),
        ("<article><p>one</p><div class=site-footer>no</div></article>", "one"),
    ],
)
def test_attributes_and_nested_articles(html, expected):
    found = markup.blocks(html)
    best = markup.best_zone(found)
    assert "\n".join(text for zone, text in found if zone == best) == expected

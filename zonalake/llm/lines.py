"""Removal of repeated and nearly repeated lines by deletion neighbourhoods.

Native: only DataFrame functions. Lines are what stands between line ends; blank lines stay. Of equal
lines the earliest stays (by doc_id, then place in the document); a line is also dropped if an
earlier line is within `EDITS` = 1 edit (a code point inserted, deleted or replaced).

1. `distinct_lines`: lines meet by a 128-bit hash, not as text; counts and first places combine in the
   map tasks.
2. `candidates`: of two lines within one edit, the first halves or the second halves are equal. Only
   lines that share a half with another line go on. A line has four such keys: two as the shorter or
   equally long one of a pair and two as the longer one.
3. `windows`: a candidate is cut into parts, and parts into smaller ones; a part stays if another line agrees
   with all outside it, as a line within one edit does for the part that holds the edit.
4. `nearest`: all variants of a candidate with one code point deleted inside such a part, as hashed
   keys. Lines with the same variant deleted at the same place differ by a replacement; a line that is itself a variant
   of another differs by an insertion. Each group is answered by its earliest line, so groups make no
   pairs. What they answer is verified by the edit distance of the texts.
5. `kept_lines`: dropped places by document, and the texts without them.

Candidates and dropped lines grow with the input, so their joins with the documents shuffle at every size.

Cases: a null text is an empty one, with a single blank line; rows with equal id are one document, a
line of theirs at the same place is the same line; a null id sorts before all others; an empty table
gives an empty result; other columns are ignored. A line has few variants unless it has partners; lines
of far above 16,000 characters that have partners may take long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalake.session import settle

EDITS = 1
NO_ID = -(2**63)
LINES_PER_DOCUMENT = 1 << 31
HASH = ["h1", "h2"]
#: A window where an edit can stand is cut into so many parts, until it has so few characters.
PARTS, FEW = 16, 16


def _documents(docs: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(key.alias("id"), F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))


def _half_keys(line: Column) -> list[Column]:
    """Keys of the halves of a line, as of length n and as one longer than n."""
    keys = []
    for n in (F.length(line), F.length(line) - 1):
        half = F.floor(n / 2).cast("int")
        keys.append(F.xxhash64(n, F.lit("first"), F.left(line, half)))
        keys.append(F.xxhash64(n, F.lit("second"), F.right(line, n - half)))
    return keys


def _occurrences(documents: DataFrame) -> DataFrame:
    """Every line that is not blank: id, no, its hash and its place in the order of all lines."""
    rows = documents.select("id", F.posexplode("lines").alias("no", "line")).where(F.trim("line") != "")
    place = F.col("id").cast("decimal(20,0)") * F.lit(LINES_PER_DOCUMENT) + F.col("no")
    return rows.select(
        "id", "no", "line", place.cast("decimal(38,0)").alias("place"),
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(EDITS), "line").alias("h2"),
    )


def distinct_lines(documents: DataFrame) -> DataFrame:
    """(h1, h2, place, n, keys): each line once, with its first place."""
    keys = _half_keys(F.col("line"))
    rows = _occurrences(documents).select(*HASH, "place", *(k.alias(f"k{i}") for i, k in enumerate(keys)))
    found = rows.groupBy(*HASH).agg(
        F.min("place").alias("place"), F.count(F.lit(1)).alias("n"),
        *(F.min(f"k{i}").alias(f"k{i}") for i in range(len(keys))),
    )
    return settle(found, "line-hashes")


def candidates(distinct: DataFrame, documents: DataFrame) -> DataFrame:
    """(place, h1, line) of the lines that share their first or second half with another."""
    keys = F.explode(F.array("k0", "k1", "k2", "k3")).alias("key")
    keyed = distinct.select(*HASH, "place", keys)
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1).select("key")
    chosen = keyed.join(shared, "key").select(*HASH, "place").distinct()
    per = F.lit(LINES_PER_DOCUMENT).cast("decimal(20,0)")
    no = F.pmod("place", per).cast("int")
    document = ((F.col("place") - no) / per).cast("long")
    chosen = settle(chosen.select(*HASH, "place", no.alias("no"), document.alias("id")), "line-candidates")
    line = F.get("lines", F.col("no"))
    texts = documents.join(chosen.hint("merge"), "id").select("place", *HASH, line.alias("line"))
    same = F.xxhash64("line") == F.col("h1")
    return settle(texts.where(same).select("place", "h1", "line").dropDuplicates(["place", "h1"]), "line-texts")


def windows(texts: DataFrame) -> DataFrame:
    """(place, h1, n, low, high, long): where the edit between a line and a partner can stand.

    The edit replaces or deletes one of the characters low + 1 to high of the longer line, which has n; `long`
    says that this line is it (or as long), so that its own variants are needed. A window is cut into PARTS
    until it has FEW characters at most: of two lines within one edit all outside one part is equal,
    so a part stays where another line agrees with all outside it.
    """
    n = F.length("line")
    roles = F.array(*(F.struct((n + i).alias("n"), F.lit(i == 0).alias("long")) for i in (0, 1)))
    start = texts.select("place", "h1", F.explode(roles).alias("role")).select("place", "h1", "role.*")
    size = F.col("high") - F.col("low")
    found = settle(start.withColumns({"low": F.lit(0), "high": F.col("n")}), "line-windows")
    done = found.where(size <= FEW)
    while not (left := found.where(size > FEW)).isEmpty():
        lots = F.least(F.lit(PARTS), F.ceil(size / FEW)).cast("int")
        edge = lambda i: (F.col("low") + F.floor(i * size.cast("long") / F.col("lots"))).cast("int")
        parts = left.withColumn("lots", lots).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
        parts = parts.select(
            "place", "h1", "n", "long", edge(F.col("part")).alias("low"), edge(F.col("part") + 1).alias("high")
        )
        outside = F.xxhash64("n", "low", "high", F.expr("left(line, low)"), F.expr("right(line, n - high)"))
        keyed = parts.join(texts.select("place", "h1", "line"), ["place", "h1"]).withColumn("key", outside)
        keyed = settle(keyed.drop("line"), "line-parts")
        shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.max("long").alias("any"))
        shared = shared.where((F.col("m") > 1) & F.col("any")).select("key")
        found = settle(keyed.join(shared, "key").drop("key"), "line-windows")
        done = done.unionByName(found.where(size <= FEW))
    return done


def nearest(texts: DataFrame) -> DataFrame:
    """(place, h1): lines that have an earlier line within one edit."""
    found = windows(texts)
    places = F.explode(F.sequence(F.col("low") + 1, F.col("high"))).alias("at")
    spread = found.where("long").join(texts, ["place", "h1"]).select("place", "h1", "line", places)
    rest = F.concat(F.expr("substring(line, 1, at - 1)"), F.expr("substring(line, at + 1)"))
    variants = settle(spread.select("place", "h1", "at", F.xxhash64(rest).alias("key")), "line-variants")

    # such a group has at most one line for each code point there is
    group = Window.partitionBy("key", "at")
    replaced = variants.withColumn("low", F.min("place").over(group)).where(F.col("low") < F.col("place"))
    whole = found.where(~F.col("long")).select(F.col("h1").alias("key"), F.col("place").alias("there")).distinct()
    inserted = variants.select("place", "h1", "key").join(whole, "key").distinct()
    answers = (
        replaced.select("place", "h1", "low")
        .unionByName(
            inserted.where(F.col("there") < F.col("place")).select("place", "h1", F.col("there").alias("low"))
        )
        .unionByName(
            inserted.where(F.col("there") > F.col("place")).select(
                F.col("there").alias("place"), F.col("key").alias("h1"), F.col("place").alias("low")
            )
        )
        .groupBy("place", "h1")
        .agg(F.min("low").alias("low"))
    )
    earlier = texts.select(F.col("place").alias("low"), F.col("line").alias("earlier"))
    both = settle(answers, "line-answers").join(texts, ["place", "h1"]).join(earlier, "low")
    close = F.levenshtein("line", "earlier", EDITS)
    return both.where((close >= 0) & (close <= EDITS)).select("place", "h1").distinct()


def kept_lines(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_kept and `kept`, the text of the lines that stay."""
    documents = _documents(docs)
    distinct = distinct_lines(documents)
    near = settle(nearest(candidates(distinct, documents)), "line-near")
    fates = distinct.join(near.withColumn("near", F.lit(True)), ["place", "h1"], "left")
    fates = fates.where((F.col("n") > 1) | F.col("near")).select(
        *HASH, F.col("place").alias("first"), F.coalesce("near", F.lit(False)).alias("near")
    )
    gone = _occurrences(documents).select("id", "no", *HASH, "place").join(fates.hint("merge"), HASH)
    gone = gone.where(F.col("near") | (F.col("place") > F.col("first")))
    gone = gone.groupBy("id").agg(F.collect_set(F.struct("no", "h1")).alias("gone"))
    gone = settle(gone, "line-dropped")
    rows = documents.join(gone.hint("merge"), "id", "left")
    stays = F.filter(
        "lines",
        lambda line, no: ~F.coalesce(
            F.array_contains("gone", F.struct(no.alias("no"), F.xxhash64(line).alias("h1"))), F.lit(False)
        ),
    )
    rows = rows.select("id", F.size("lines").alias("n_lines"), stays.alias("stays"))
    return rows.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("stays").cast("long").alias("n_kept"),
        F.array_join("stays", "\n").alias("kept"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_kept, kept_sha256."""
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return kept_lines(docs).select("doc_id", "n_lines", "n_kept", digest)


REPORT_SQL = """
WITH o AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no FROM documents),
b AS (SELECT * FROM o WHERE trim(line) <> ''),
l AS (SELECT line, min((doc_id, no)) AS place FROM b GROUP BY line),
k AS (
  SELECT line, place, unnest([
    'p' || length(line) || ':' || left(line, length(line) // 2),
    's' || length(line) || ':' || right(line, length(line) - length(line) // 2),
    'p' || (length(line) - 1) || ':' || left(line, (length(line) - 1) // 2),
    's' || (length(line) - 1) || ':' || right(line, length(line) - 1 - (length(line) - 1) // 2)]) AS key
  FROM l),
n AS (
  SELECT DISTINCT x.line FROM k x JOIN k y ON x.key = y.key AND y.place < x.place
  WHERE len(list_filter(range(greatest(length(x.line), length(y.line))), lambda i: left(x.line, i) = left(y.line, i)
    AND substr(x.line, i + 1 + (length(x.line) >= length(y.line))::INT)
      = substr(y.line, i + 1 + (length(y.line) >= length(x.line))::INT))) > 0),
f AS (
  SELECT o.doc_id, o.no, o.line,
    trim(o.line) = '' OR ((o.doc_id, o.no) = l.place AND n.line IS NULL) AS stays
  FROM o LEFT JOIN l ON o.line = l.line LEFT JOIN n ON o.line = n.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE stays) AS n_kept,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE stays), '')) AS kept_sha256
FROM f GROUP BY doc_id"""

"""Mixing sources to target weights by weighted sampling without replacement.

Native: only DataFrame functions. Every document gets the key u^(1/w) of Efraimidis and Spirakis,
with u uniform in (0, 1) from a digest of its id and w its quality weight; this orders documents as
exponential variables scaled by 1/w would. Each source takes as many complete epochs as its target
holds, then the documents with the largest keys until their sizes reach what is left. The sorted
prefix sum is done in two steps, so that a source with a third of all rows is spread over tasks:
sizes add up by (source, range of keys), and only the one range in which the target falls is sorted.
What comes out per source is one cut-off, so no text moves.

Cases: null or empty texts have size 0 and cost nothing; null sources form one source; rows with
equal id and source stand or fall together; a null id sorts before all others; an empty table gives
an empty result. Working columns begin with `__mix_`, so other columns keep their names and values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalake.session import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
KEY_RANGES = 1 << 16
SEED = "mix-1"
#: Characters that are rare in prose; a text's quality weight falls with their share.
NOISE = "!#$%&*|<>{}[]^~=+_@/"
LEAST_WEIGHT = 0.05


def word_count(text: Column) -> Column:
    """Words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for prose, less with the share of noise characters, `LEAST_WEIGHT` at least."""
    bare = F.length(F.translate(text, NOISE, ""))
    share = (F.length(text) - bare) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(LEAST_WEIGHT), F.lit(1.0) - F.coalesce(share, F.lit(0.0)))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """u^(1/weight): larger is earlier."""
    label = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    digits = F.conv(F.substring(F.md5(label.cast("binary")), 1, 13), 16, 10).cast("double")
    return F.pow((digits + 0.5) / F.lit(float(1 << 52)), F.lit(1.0) / weight)


def source_targets(sizes: DataFrame, weights=WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """Targets by source from rows (source, source_size).

    Sources in order of code point, null last, have `weights` in turn. Targets share the total by
    weight; where one would exceed `most_repeats` times its source, it stops there and the excess
    goes to the others by weight. The fixed point is a water level: min(cap, level * weight). One
    row per source goes through one sort here, no documents.
    """
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % n + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight.cast("double")).withColumn(
        "cap", F.col("source_size").cast("double") * most_repeats
    )
    tightest = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.asc_nulls_last("source"))
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    onwards = tightest.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    level = (
        F.sum(F.col("source_size").cast("double")).over(whole)
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onwards)
    levelled = ranked.withColumn("level", level).withColumn(
        "free", F.col("cap") > F.col("level") * F.col("weight")
    )
    common = F.max(F.when(F.col("free"), F.col("level"))).over(whole)
    target = F.when(F.col("free"), common * F.col("weight")).otherwise(F.col("cap"))
    return levelled.select("source", "source_size", target.alias("target"))


def _with_keys(docs: DataFrame, weight: Column, key_ranges: int) -> DataFrame:
    key = F.col("__mix_key")
    return (
        docs.withColumn("__mix_size", word_count(F.col("text")))
        .withColumn("__mix_key", sampling_key(F.col("doc_id"), weight))
        .withColumn("__mix_range", F.floor((F.lit(1.0) - key) * key_ranges))
        .withColumn("__mix_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))))
    )


def mix_plan(docs: DataFrame, weight: Column | None = None, key_ranges: int = KEY_RANGES) -> DataFrame:
    """`docs` with `__mix_size`, `__mix_source_size`, `__mix_target` and `__mix_times`.

    `__mix_times` says how often the mix takes the row: the complete epochs of its source, and once
    more if its key is above the cut-off. A source's sum differs from its target by half of one
    document at most (rows of equal id count as one document).
    """
    weight = quality_weight(F.col("text")) if weight is None else weight
    keyed = _with_keys(docs, weight, key_ranges)
    slim = settle(
        keyed.select(F.col("source"), *(f"__mix_{c}" for c in ("size", "key", "range", "id"))),
        "mix-keys",
    )
    sums = slim.groupBy("source", "__mix_range").agg(F.sum("__mix_size").alias("size"))
    sums = settle(sums, "mix-sums")
    targets = source_targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")))
    epochs = F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double")))
    targets = targets.withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("int")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    )
    targets = settle(targets, "mix-targets")

    by_range = Window.partitionBy("source").orderBy("__mix_range")
    after = F.sum("size").over(by_range)
    same = sums["source"].eqNullSafe(targets["source"])
    cut_range = (
        sums.join(targets, same)
        .select(sums["source"], "__mix_range", "size", "rest")
        .withColumn("after", after)
        .where((F.col("after") - F.col("size") <= F.col("rest")) & (F.col("after") > F.col("rest")))
        .select(
            F.col("source").alias("cut_source"),
            F.col("__mix_range").alias("cut_range"),
            (F.col("after") - F.col("size")).alias("before"),
            "rest",
        )
    )
    cut_range = settle(cut_range, "mix-ranges")

    inside = slim.join(
        cut_range,
        slim["source"].eqNullSafe(cut_range["cut_source"])
        & (slim["__mix_range"] == cut_range["cut_range"]),
    )
    ties = inside.groupBy("source", "__mix_key", "__mix_id", "before", "rest").agg(
        F.sum("__mix_size").alias("size")
    )
    order = Window.partitionBy("source").orderBy(F.desc("__mix_key"), "__mix_id")
    middle = F.col("before") + F.sum("size").over(order) - F.col("size") / 2
    last = (
        ties.withColumn("middle", middle)
        .where(F.col("middle") <= F.col("rest"))
        .groupBy("source")
        .agg(F.max(F.struct((-F.col("__mix_key")).alias("k"), "__mix_id")).alias("last"))
        .select(F.col("source").alias("last_source"), "last")
    )
    cuts = (
        targets.join(cut_range.drop("rest"), targets["source"].eqNullSafe(F.col("cut_source")), "left")
        .join(last, targets["source"].eqNullSafe(F.col("last_source")), "left")
        .select(
            F.col("source").alias("__mix_source"),
            F.col("source_size").alias("__mix_source_size"),
            F.col("target").alias("__mix_target"),
            F.col("epochs").alias("__mix_epochs"),
            F.col("cut_range").alias("__mix_cut_range"),
            F.col("last").alias("__mix_last"),
        )
    )
    cuts = settle(cuts, "mix-cuts")

    chosen = (
        F.col("__mix_cut_range").isNull()
        | (F.col("__mix_range") < F.col("__mix_cut_range"))
        | (
            (F.col("__mix_range") == F.col("__mix_cut_range"))
            & F.coalesce(
                F.struct((-F.col("__mix_key")).alias("k"), "__mix_id") <= F.col("__mix_last"),
                F.lit(False),
            )
        )
    )
    times = F.col("__mix_epochs") + chosen.cast("int")
    times = F.least(times, F.lit(MOST_REPEATS))
    joined = keyed.join(cuts, keyed["source"].eqNullSafe(cuts["__mix_source"]))
    return joined.withColumn("__mix_times", times).drop(
        "__mix_source", "__mix_key", "__mix_range", "__mix_id", "__mix_epochs", "__mix_cut_range",
        "__mix_last",
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, size, source_size, target, taken."""
    return mix_plan(docs.select("doc_id", "text", "source")).select(
        "doc_id",
        F.col("__mix_size").alias("size"),
        F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (F.col("__mix_size") * F.col("__mix_times")).alias("taken"),
    )


def mix_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as the mix takes it."""
    repeated = F.explode(F.expr("sequence(1, `__mix_times`)"))
    plan = mix_plan(docs).where(F.col("__mix_times") > 0)
    return plan.withColumn("__mix_copy", repeated).select(*(F.col(f"`{c}`") for c in docs.columns))


def report_sql() -> str:
    """DuckDB SQL with the rows of `mix_report` over the table `documents`."""
    bare = f"length(translate(text, '{NOISE}', ''))"
    share = f"coalesce((length(text) - {bare}) / greatest(length(text), 1), 0.0)"
    u = f"(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 13))::BIGINT + 0.5)"
    listed = ", ".join(f"{w}.0" for w in WEIGHTS)
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    pow({u} / {float(1 << 52)}, 1.0 / greatest({LEAST_WEIGHT}, 1.0 - {share})) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, [{listed}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight,
    source_size::DOUBLE * {MOST_REPEATS} AS cap FROM s),
l AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER (
      ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (
  SELECT source, source_size, CASE WHEN cap > level * weight
      THEN (max(level) FILTER (WHERE cap > level * weight) OVER ()) * weight ELSE cap END AS target FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
k AS (
  SELECT d.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY key DESC, doc_id NULLS FIRST) AS upto,
    sum(size) OVER (PARTITION BY d.source, key, doc_id) AS own
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  (size * least({MOST_REPEATS}, epochs + CASE WHEN upto - own / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM k"""

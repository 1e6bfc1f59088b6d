"""The row-level silver join on zone and hour."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from zonalake.operators.cells import air_cells, pair_cells, traffic_cells
from zonalake.operators.rolling import rolling_mean
from zonalake.schemas import AIR_METRICS, DATE_KEYS, SILVER_COLUMNS, ZONE_HOUR
from zonalake.session import settle

# Most joined rows of one zone and hour that one task should emit.
PAIRS_PER_BLOCK = 4_000_000
# Pairs below which splitting a key does not pay, unless the caller says otherwise.
SMALLEST_BLOCK = 50_000
# Blocks that a task's share of the pairs is split into. Blocks are placed by hash; more of them
# even out the tasks.
BLOCKS_PER_TASK = 8


def plain_join(air: DataFrame, traffic: DataFrame) -> DataFrame:
    """Inner equi-join on zone and hour, many to many. Of traffic only the count is carried."""
    return air.join(traffic.select(*ZONE_HOUR, "debit_horaire"), ZONE_HOUR, "inner")


def _blocks(own: Column, other: Column, pairs: int) -> Column:
    side = math.sqrt(pairs)
    blocks = F.ceil(own.cast("double") * F.least(other.cast("double"), F.lit(side)) / pairs)
    return F.greatest(F.lit(1), blocks.cast("int"))


def join_keys(air: DataFrame, traffic: DataFrame) -> DataFrame:
    """Zones and hours on both sides, with the rows of each side and the cumulative mean."""
    cells = pair_cells(air_cells(air, by_date=False), traffic_cells(traffic))
    return cells.select(
        *ZONE_HOUR, rolling_mean().alias("rolling_avg_pollution"), "air_rows", "traffic_rows"
    )


def with_blocks(keys: DataFrame, pairs_per_block: int) -> DataFrame:
    """The number of blocks into which each side of a key is to be split so that the pairs of two
    blocks stay near `pairs_per_block`."""
    air_rows, traffic_rows = F.col("air_rows"), F.col("traffic_rows")
    return keys.select(
        *ZONE_HOUR,
        "rolling_avg_pollution",
        _blocks(air_rows, traffic_rows, pairs_per_block).alias("air_blocks"),
        _blocks(traffic_rows, air_rows, pairs_per_block).alias("traffic_blocks"),
    )


def task_count(pairs: float, pairs_per_block: int, shuffle_partitions: int) -> int:
    """Tasks for a join of so many pairs: as many as it has full blocks, and no fewer than the
    session's shuffle partitions, to which Spark raises the number in any case."""
    return max(math.ceil(pairs / pairs_per_block), shuffle_partitions)


def block_size(
    pairs: float, tasks: int, pairs_per_block: int, smallest: int = SMALLEST_BLOCK
) -> int:
    """Pairs per block: several blocks per task, so that a few hot keys still occupy all tasks
    evenly, but none too small or too large."""
    share = math.ceil(pairs / tasks / BLOCKS_PER_TASK)
    return min(pairs_per_block, max(smallest, share))


def _side(df: DataFrame, columns: list[str], keys: DataFrame, names: tuple[str, str], lot: int):
    """Distinct rows of one side, in lots of at most `lot` copies. Each lot has its own block and is
    repeated for every block of the other side."""
    own, other = names
    rows, number = F.col("rows"), F.col("lot")
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(keys, ZONE_HOUR)
        .withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((rows - 1) / lot))))
        .withColumn(f"{own}_copies", F.least(F.lit(lot), rows - number * lot).cast("int"))
        .withColumn(f"{own}_block", F.pmod(F.xxhash64(*columns, "lot"), f"{own}_blocks").cast("int"))
        .withColumn(
            f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        )
        .drop("rows", "lot", "air_blocks", "traffic_blocks")
    )


def silver_join(
    air: DataFrame,
    traffic: DataFrame,
    pairs_per_block: int = PAIRS_PER_BLOCK,
    smallest_block: int = SMALLEST_BLOCK,
) -> DataFrame:
    """All pairs of air and traffic rows of the same zone and hour, with the cumulative mean.

    There are at most 24 keys per zone, and any of them may be hot on both sides. Each hot key is
    laid out as a grid: every row of one side falls in one block and is sent to each block of the
    other side, so every pair meets in exactly one task and the pairs of a key spread over as many
    tasks as they need. Keys that fit one block are sent once. The copies sent are about one per
    `sqrt(pairs_per_block)` result rows. The number of tasks follows from the number of pairs, which
    is known before the join; sized by their input, tasks of a join that multiplies rows would be
    far too large.

    Equal rows travel as one row with a number of copies, in lots small enough to spread over the
    blocks, and are multiplied out after the join. A lot's block follows from its content alone, so
    a task that runs again after a lost executor places it as before.

    The table of keys is written first; the planner broadcasts it when its size allows, and beyond
    that joins it by shuffle.
    """
    spark = air.sparkSession
    size = Observation("pairs")
    pairs_of_key = F.col("air_rows").cast("double") * F.col("traffic_rows").cast("double")
    counted = join_keys(air, traffic).observe(size, F.sum(pairs_of_key).alias("pairs"))
    keys = settle(counted, "keys")
    pairs = size.get.get("pairs") or 0.0
    tasks = task_count(pairs, pairs_per_block, int(spark.conf.get("spark.sql.shuffle.partitions")))
    per_block = block_size(pairs, tasks, pairs_per_block, smallest_block)
    keys = with_blocks(keys, per_block)
    lot = max(1, math.isqrt(per_block) // 8)

    air_columns = [*ZONE_HOUR, *AIR_METRICS, *DATE_KEYS]
    air_side = _side(air, air_columns, keys, ("air", "traffic"), lot)
    traffic_columns = [*ZONE_HOUR, "debit_horaire"]
    traffic_keys = keys.drop("rolling_avg_pollution")
    traffic_side = _side(traffic, traffic_columns, traffic_keys, ("traffic", "air"), lot)

    block = [*ZONE_HOUR, "air_block", "traffic_block"]
    copies = F.array_repeat(F.lit(0), F.col("air_copies") * F.col("traffic_copies"))
    return (
        air_side.repartition(tasks, *block)
        .join(traffic_side.repartition(tasks, *block).hint("merge"), block)
        .select(*SILVER_COLUMNS, F.explode(copies))
        .select(*SILVER_COLUMNS)
    )

"""Raw tables derived from the test tables `events` and `orders`.

The domain's own files are not shipped, so the test tables are put into the raw text forms and go
through the same functions as real data would.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalake.operators.staging import stamp_ingest_date
from zonalake.schemas import RAW_AIR, RAW_TRAFFIC, TRAFFIC_CSV

MAPPING = {
    "urgent": "error",
    "high": "purchase",
    "medium": "click",
    "not_specified": "click",
    "low": "view",
}
ZONES = ["error", "click", "view", "purchase"]
TRAFFIC_INGEST_DATE = date(2024, 1, 31)
AIR_INGEST_DATES = (date(2024, 1, 31), date(2024, 2, 1))

# Dates in the order of their ingestion, with the batches (by air quality index modulo 3) that each brings:
# the third of January comes late, the second comes again without a batch.
AIR_BATCHES = (
    (date(2024, 1, 1), [0]),
    (date(2024, 1, 2), [0, 1]),
    (date(2024, 1, 4), [1, 2]),
    (date(2024, 1, 3), [0, 2]),
    (date(2024, 1, 2), [0]),
)

# The columns used, so that reading needs no job to look up the schema.
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
ORDERS = (
    "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string"
)


def raw_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air rows from `events`; the ingest date is the event's date."""
    k = F.get_json_object("props", "$.k")
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_type").alias("station"),
        F.date_format("ts", "dd/MM/yyyy HH:mm").alias("datetime"),
        F.col("value").alias("pollution_value"),
        k.try_cast("int").alias("air_quality_index"),
        (F.col("user_id") - 60).cast("double").alias("temperature"),
        (k.try_cast("double") * 1.1).alias("humidity"),
        (F.col("event_id") % 200 - 100).cast("double").alias("latitude"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.day("ts").alias("day"),
    ).select(*RAW_AIR.fieldNames())


def traffic_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic rows from `orders` as the CSV has them: text only."""
    shift = (F.col("o_orderkey") % 24).cast("int")
    counted_at = F.timestamp_add("HOUR", shift, F.col("o_orderdate")).cast("string")
    count = F.col("o_totalprice") * (shift + 5) / 5000
    return spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet").select(
        F.concat(F.lit("Bd_"), F.substr("o_orderpriority", F.lit(3))).alias("libelle"),
        F.replace(counted_at, F.lit(" "), F.lit("T")).alias("date_et_heure_de_comptage"),
        count.cast("decimal(18,6)").cast("string").alias("debit_horaire"),
        F.when(F.col("o_orderstatus") == "O", "Ouvert").otherwise("Invalide").alias("etat_arc"),
    ).select(*TRAFFIC_CSV.fieldNames())


def raw_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp_ingest_date(traffic_csv(spark, sf_dir), TRAFFIC_INGEST_DATE).select(
        *RAW_TRAFFIC.fieldNames()
    )

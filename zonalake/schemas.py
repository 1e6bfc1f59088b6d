"""Schemas of the raw, silver and gold tables."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

DATE_KEYS = ["year", "month", "day"]
ZONE_HOUR = ["zone", "hour"]
#: When a raw row was observed, as text.
AIR_TIME, TRAFFIC_TIME = "datetime", "date_et_heure_de_comptage"
AIR_METRICS = ["pollution_value", "air_quality_index", "temperature", "humidity"]


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def with_date(schema: StructType) -> StructType:
    """The schema with the ingest-date partition columns appended."""
    return StructType(schema.fields + [StructField(k, IntegerType()) for k in DATE_KEYS])


# As the CSV delivers it: text only.
TRAFFIC_CSV = _struct(
    libelle=StringType(),
    date_et_heure_de_comptage=StringType(),
    debit_horaire=StringType(),
    etat_arc=StringType(),
)
RAW_TRAFFIC = with_date(TRAFFIC_CSV)

AIR_SOURCE = _struct(
    station=StringType(),
    datetime=StringType(),
    pollution_value=DoubleType(),
    air_quality_index=IntegerType(),
    temperature=DoubleType(),
    humidity=DoubleType(),
    latitude=DoubleType(),
)
RAW_AIR = with_date(AIR_SOURCE)

SILVER_AIR = with_date(
    _struct(
        zone=StringType(),
        hour=IntegerType(),
        pollution_value=DoubleType(),
        air_quality_index=IntegerType(),
        temperature=DoubleType(),
        humidity=DoubleType(),
    )
)
SILVER_TRAFFIC = with_date(
    _struct(zone=StringType(), hour=IntegerType(), debit_horaire=DoubleType())
)
SILVER_COLUMNS = ["zone", "hour", *AIR_METRICS, *DATE_KEYS, "debit_horaire", "rolling_avg_pollution"]
SILVER = with_date(
    _struct(
        zone=StringType(),
        hour=IntegerType(),
        pollution_value=DoubleType(),
        air_quality_index=IntegerType(),
        temperature=DoubleType(),
        humidity=DoubleType(),
        debit_horaire=DoubleType(),
        rolling_avg_pollution=DoubleType(),
    )
)

POLLUTION_MART = ["zone", *DATE_KEYS, "avg_pollution", "max_pollution", "avg_aqi"]
TRAFFIC_MART = ["zone", "hour", *DATE_KEYS, "avg_traffic", "max_traffic"]
TRAFFIC_POLLUTION_MART = [
    "zone",
    "hour",
    *DATE_KEYS,
    "avg_pollution",
    "avg_traffic",
    "avg_temperature",
    "avg_humidity",
    "traffic_level",
]

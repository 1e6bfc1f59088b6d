"""Small hand-made raw tables with boundary values, NULLs and malformed text."""

from __future__ import annotations

from zonalake.schemas import RAW_AIR, RAW_TRAFFIC, SILVER_AIR, SILVER_TRAFFIC

D1, D2 = (2025, 4, 1), (2025, 4, 2)

AIR_ROWS = [
    # station, datetime, pollution, aqi, temperature, humidity, latitude, date
    ("Gare-du-Nord", "01/02/2024 07:05", 10.0, 50, 20.0, 50.0, 48.8, *D1),
    ("Gare-du-Nord", "01/02/2024 07:59", 20.0, 0, -50.0, 0.0, -90.0, *D1),
    ("Gare-du-Nord", "01/02/2024 09:00", 30.0, 40, 60.0, 100.0, 90.0, *D2),
    ("Saint Michel", "02/02/2024 23:30", 40.0, 10, 5.0, 30.0, 48.8, *D2),
    ("Saint Michel", "1/2/2024 7:05", 50.0, 10, 5.0, 30.0, 48.8, *D2),
    ("Nation", None, 60.0, 10, 5.0, 30.0, 48.8, *D1),
    (None, "01/02/2024 07:05", 70.0, 10, 5.0, 30.0, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", None, 10, 5.0, 30.0, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, -1, 5.0, 30.0, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, None, 5.0, 30.0, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, 10, -50.1, 30.0, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, 10, 60.1, 30.0, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, 10, None, 30.0, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, 10, 5.0, -0.1, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, 10, 5.0, 100.1, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, 10, 5.0, None, 48.8, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, 10, 5.0, 30.0, -90.1, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, 10, 5.0, 30.0, 90.1, *D1),
    ("Nation", "01/02/2024 07:05", 1.0, 10, 5.0, 30.0, None, *D1),
]
AIR_VALID = 7

TRAFFIC_ROWS = [
    # libelle, time, count, state, date
    ("Bd_Magenta", "2025-04-01T07:00:00", "999", "Ouvert", *D1),
    ("Bd_Magenta", "2025-04-01T07:10:00", "1000", "Ouvert", *D1),
    ("Bd_Magenta", "2025-04-02T07:20:00", "12.5", "Ouvert", *D2),
    ("Bd_Magenta", "2025-04-02T09:00:00", "0", "Ouvert", *D2),
    ("Rue de Rivoli", "2025-04-01T08:00:00+02:00", "300", "Ouvert", *D1),
    ("St-Michel", "2025-04-01T23:00:00", "5", "Ouvert", *D1),
    ("bd_x", "2025-04-01T07:00:00", "5", "Ouvert", *D1),
    ("Cité", "2025-04-01T07:00:00", "5", "Ouvert", *D1),
    (None, "2025-04-01T07:00:00", "5", "Ouvert", *D1),
    ("Bd_Magenta", "not a time", "5", "Ouvert", *D1),
    ("Bd_Magenta", None, "5", "Ouvert", *D1),
    ("Bd_Magenta", "2025-04-01T07:00:00", "-1", "Ouvert", *D1),
    ("Bd_Magenta", "2025-04-01T07:00:00", "abc", "Ouvert", *D1),
    ("Bd_Magenta", "2025-04-01T07:00:00", "NaN", "Ouvert", *D1),
    ("Bd_Magenta", "2025-04-01T07:00:00", None, "Ouvert", *D1),
    ("Bd_Magenta", "2025-04-01T07:00:00", "5", "ouvert", *D1),
    ("Bd_Magenta", "2025-04-01T07:00:00", "5", "Invalide", *D1),
    ("Bd_Magenta", "2025-04-01T07:00:00", "5", None, *D1),
]
TRAFFIC_VALID = 11


def raw_air(spark):
    return spark.createDataFrame(AIR_ROWS, RAW_AIR)


def raw_traffic(spark):
    return spark.createDataFrame(TRAFFIC_ROWS, RAW_TRAFFIC)


def silver_air(spark, rows):
    """Rows of (zone, hour, pollution, aqi, temperature, humidity, day of month)."""
    return spark.createDataFrame([(*row[:6], 2025, 4, row[6]) for row in rows], SILVER_AIR)


def silver_traffic(spark, rows):
    """Rows of (zone, hour, count)."""
    return spark.createDataFrame([(*row, *D1) for row in rows], SILVER_TRAFFIC)


def bag(df, columns=None):
    """All rows, in an order that does not depend on the plan."""
    columns = columns or sorted(df.columns)
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)

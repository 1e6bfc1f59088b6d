"""Sources, sinks, catalog and the job, over temporary folders."""

from __future__ import annotations

import os
import random
import re
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from fixtures import D1, D2, bag, raw_air, raw_traffic
from pyspark.sql import functions as F

from zonalake import job, session
from zonalake.operators.conform import conform_air, conform_traffic
from zonalake.operators.pairing import plain_join
from zonalake.fixed_values import AIR_RULES, TRAFFIC_RULES
from zonalake.operators.quality import quality_report, rules_of_mask, valid_air, valid_traffic
from zonalake.operators.rolling import rolling_over_rows
from zonalake.operators.staging import cast_known, drop_reingested
from zonalake.plans import gold, layers, reingest
from zonalake.schemas import AIR_SOURCE, AIR_TIME, DATE_KEYS, RAW_AIR, RAW_TRAFFIC, SILVER, TRAFFIC_CSV
from zonalake.sinks import in_one_transaction, jdbc_write_options, register_table, swap_statements, write_lake
from zonalake.sources import (
    bounds_query,
    jdbc_read_options,
    quantiles_query,
    read_lake,
    read_table,
    read_traffic_csv,
    split_predicates,
)

DAY1, DAY2 = date(*D1), date(*D2)


def test_refine_shuffles_nothing(spark, lake):
    """Reading raw and writing silver is one stage; only the mapping is broadcast."""
    traffic = conform_traffic(read_lake(spark, f"{lake}/raw/traffic", RAW_TRAFFIC))
    for df in (conform_air(read_lake(spark, f"{lake}/raw/air", RAW_AIR)), traffic):
        assert "hashpartitioning" not in plan_of(df) and "SinglePartition" not in plan_of(df)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def lake(spark, tmp_path):
    """Raw layer with two ingest dates."""
    for day in (DAY1, DAY2):
        for df, name in ((raw_air(spark), "air"), (raw_traffic(spark), "traffic")):
            batch = df.filter(F.make_date(*DATE_KEYS) == F.lit(day)).drop(*DATE_KEYS)
            layers.ingest(batch, f"{tmp_path}/raw/{name}", day)
    return str(tmp_path)


def test_csv_keeps_unknown_columns(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "libelle,date_et_heure_de_comptage,debit_horaire,etat_arc,extra\n"
        'Bd_Magenta,2025-04-01T07:00:00,12.5,Ouvert,"a,b"\n'
        "Rivoli,,,,\n"
    )
    df = read_traffic_csv(spark, str(path))
    assert df.columns[-1] == "extra" and {t for _, t in df.dtypes} == {"string"}
    assert [tuple(r)[2:] for r in df.collect()] == [("12.5", "Ouvert", "a,b"), (None, None, None)]


def test_csv_with_schema_checks_the_header(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("libelle;date_et_heure_de_comptage;debit_horaire;etat_arc\nx;y;1;Ouvert\n")
    assert read_traffic_csv(spark, str(path), TRAFFIC_CSV, sep=";").first().debit_horaire == "1"
    path.write_text("libelle;etat_arc;debit_horaire;date_et_heure_de_comptage\nx;y;1;Ouvert\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_traffic_csv(spark, str(path), TRAFFIC_CSV, sep=";").collect()


def test_raw_round_trip(spark, lake):
    assert bag(read_lake(spark, f"{lake}/raw/air", RAW_AIR)) == bag(raw_air(spark))
    assert bag(read_lake(spark, f"{lake}/raw/traffic", RAW_TRAFFIC)) == bag(raw_traffic(spark))


def test_second_ingest_replaces_only_its_date(spark, lake):
    path = f"{lake}/raw/air"
    before = bag(read_lake(spark, path, RAW_AIR, DAY1))
    batch = raw_air(spark).limit(1).drop(*DATE_KEYS)
    assert layers.ingest(batch, path, DAY2) == 1
    assert bag(read_lake(spark, path, RAW_AIR, DAY1)) == before
    assert read_lake(spark, path, RAW_AIR, DAY2).count() == 1
    assert layers.ingest(batch.limit(0), path, DAY2) == 0
    assert read_lake(spark, path, RAW_AIR, DAY2).count() == 0


def test_dynamic_and_whole_overwrite(spark, tmp_path):
    path, df = f"{tmp_path}/t", raw_air(spark)
    assert write_lake(df, path, rebalance=True) == 19
    one = df.filter(F.make_date(*DATE_KEYS) == F.lit(DAY2))
    assert write_lake(one.limit(1), path) == 1
    assert read_lake(spark, path, RAW_AIR).count() == 19 - one.count() + 1
    assert write_lake(one, path, whole=True) == one.count()
    assert read_lake(spark, path, RAW_AIR).count() == one.count()


def test_filters_columns_and_dates_reach_the_scan(spark, lake):
    air = read_lake(spark, f"{lake}/raw/air", RAW_AIR, DAY1)
    plan = plan_of(valid_air(air).select("pollution_value"))
    for pushed in (
        "IsNotNull(pollution_value)",
        "GreaterThanOrEqual(air_quality_index,0)",
        "GreaterThanOrEqual(temperature,-50.0)",
        "LessThanOrEqual(temperature,60.0)",
        "LessThanOrEqual(humidity,100.0)",
        "GreaterThanOrEqual(latitude,-90.0)",
    ):
        assert pushed in plan
    assert "station" not in re.search(r"ReadSchema: (.*)", plan)[1]
    assert re.search(r"PartitionFilters: \[[^]]*day#\d+ = 1\)", plan)
    traffic = read_lake(spark, f"{lake}/raw/traffic", RAW_TRAFFIC)
    assert "EqualTo(etat_arc,Ouvert)" in plan_of(valid_traffic(traffic))


def expected_silver(spark):
    joined = plain_join(conform_air(raw_air(spark)), conform_traffic(raw_traffic(spark)))
    return rolling_over_rows(joined)


def rounded_bag(df):
    return bag(df.withColumn("rolling_avg_pollution", F.round("rolling_avg_pollution", 9)))


def test_refine_by_date_equals_refine_at_once(spark, lake):
    at_once, by_date = f"{lake}/once", f"{lake}/by_date"
    raw = (f"{lake}/raw/air", f"{lake}/raw/traffic")
    assert layers.refine(spark, *raw, at_once) == {"air": 7, "traffic": 11}
    for day in (DAY1, DAY2):
        layers.refine(spark, *raw, by_date, day)
        layers.refresh_cells(*layers.silver_sides(spark, by_date, day), f"{lake}/gold", day)
    for whole, parts in zip(
        layers.silver_sides(spark, at_once), layers.silver_sides(spark, by_date), strict=True
    ):
        assert bag(whole) == bag(parts)
    layers.write_marts(layers.marts_of_cells(layers.stored_cells(spark, f"{lake}/gold")), f"{lake}/g")
    marts = layers.read_marts(spark, f"{lake}/g")
    silver = expected_silver(spark)
    assert bag(marts["datamart_pollution"]) == bag(gold.pollution_mart_from_silver(silver))
    assert bag(marts["datamart_traffic"]) == bag(gold.traffic_mart_from_silver(silver))
    assert bag(marts["datamart_traffic_pollution"]) == bag(
        gold.traffic_pollution_mart_from_silver(silver)
    )


def test_stored_join_and_its_table(spark, lake):
    layers.refine(spark, f"{lake}/raw/air", f"{lake}/raw/traffic", f"{lake}/silver")
    assert layers.join_silver(spark, f"{lake}/silver") == 7
    register_table(spark, "stored_silver", f"{lake}/silver/joined", SILVER)
    assert rounded_bag(read_table(spark, "stored_silver")) == rounded_bag(expected_silver(spark))
    assert read_table(spark, "stored_silver", DAY1).count() == 6
    cells = layers.settled_silver_cells(read_table(spark, "stored_silver"))
    marts = layers.marts_of_cells(cells)
    expected = gold.pollution_mart_from_silver(expected_silver(spark))
    assert bag(marts["datamart_pollution"]) == bag(expected)
    spark.sql("DROP TABLE stored_silver")
    assert read_lake(spark, f"{lake}/silver/joined", SILVER).count() == 7


def test_job_end_to_end(spark, lake, tmp_path):
    csv = tmp_path / "t.csv"
    raw_traffic(spark).drop(*DATE_KEYS).coalesce(1).write.option("header", True).csv(f"{csv}")
    out = f"{tmp_path}/job"
    rows = job.run(
        spark,
        ["ingest", "--traffic_input", str(csv), "--output_traffic", f"{out}/raw", "--ingest_date"]
        + [DAY1.isoformat()],
    )
    assert rows == {"traffic": 18}
    base = ["refine", "--air_input", f"{lake}/raw/air", "--traffic_input", f"{out}/raw"]
    base += ["--silver_output", f"{out}/silver", "--silver_table", "job_silver"]
    assert job.run(spark, base) == {"air": 7, "traffic": 11}
    view = rounded_bag(spark.table("job_silver").select(*SILVER.fieldNames()))
    assert view == rounded_bag(expected_silver(spark).select(*SILVER.fieldNames()))
    marts = {"datamart_pollution": 2, "datamart_traffic": 2, "datamart_traffic_pollution": 2}
    gold_args = ["--gold_output", f"{out}/gold"]
    assert job.run(spark, ["marts", "--silver_input", f"{out}/silver", *gold_args]) == marts
    first = {n: bag(df) for n, df in layers.read_marts(spark, f"{out}/gold").items()}
    assert job.run(spark, [*base, "--join_rows"])["joined"] == 7
    assert rounded_bag(spark.table("job_silver").select(*SILVER.fieldNames())) == view
    assert job.run(spark, ["marts", "--silver_table", "job_silver", *gold_args]) == marts
    assert {n: bag(df) for n, df in layers.read_marts(spark, f"{out}/gold").items()} == first
    assert job.run(spark, [*base, "--ingest_date", DAY2.isoformat()])["air"] == 3
    assert rounded_bag(spark.table("job_silver").select(*SILVER.fieldNames())) == view
    for name in ("job_silver", "job_silver_air", "job_silver_traffic"):
        kind = "VIEW" if name == "job_silver" else "TABLE"
        spark.sql(f"DROP {kind} {name}")


def test_table_has_every_date_and_follows_its_folder(spark, lake, tmp_path):
    base = ["refine", "--air_input", f"{lake}/raw/air", "--traffic_input", f"{lake}/raw/traffic"]
    named = ["--silver_table", "dated_silver"]
    try:
        for folder in (f"{tmp_path}/one", os.path.relpath(f"{tmp_path}/two")):
            by_day = [*base, "--silver_output", folder]
            job.run(spark, [*by_day, "--ingest_date", DAY1.isoformat()])
            job.run(spark, [*by_day, *named, "--ingest_date", DAY2.isoformat()])
            for side, rows in (("air", 7), ("traffic", 11)):
                assert spark.table(f"dated_silver_{side}").count() == rows
        by_name = ["marts", *named, "--gold_output", f"{tmp_path}/g1"]
        by_folder = ["marts", "--silver_input", f"{tmp_path}/one", "--gold_output", f"{tmp_path}/g2"]
        assert job.run(spark, by_name) == job.run(spark, by_folder)
        one, two = (layers.read_marts(spark, f"{tmp_path}/{g}") for g in ("g1", "g2"))
        assert {n: bag(m) for n, m in one.items()} == {n: bag(m) for n, m in two.items()}
        day = ["--ingest_date", DAY2.isoformat()]
        assert job.run(spark, [*by_name, *day]) == job.run(spark, by_folder)
    finally:
        spark.sql("DROP VIEW dated_silver")
        for side in ("air", "traffic"):
            spark.sql(f"DROP TABLE dated_silver_{side}")


def test_marts_by_view_form_no_pairs(spark, lake, tmp_path, monkeypatch):
    base = ["refine", "--air_input", f"{lake}/raw/air", "--traffic_input", f"{lake}/raw/traffic"]
    job.run(spark, [*base, "--silver_output", f"{lake}/s", "--silver_table", "pair_silver"])
    seen = []
    monkeypatch.setattr(layers, "_write", lambda df, *a, **k: seen.append(plan_of(df)) or 0)

    def stop(*args):
        raise LookupError("far enough")

    monkeypatch.setattr(layers, "stored_cells", stop)
    try:
        with pytest.raises(LookupError):
            job.run(spark, ["marts", "--silver_table", "pair_silver", "--gold_output", f"{tmp_path}/g"])
        assert len(seen) == 2 and not any("Join" in plan for plan in seen)
    finally:
        spark.sql("DROP VIEW pair_silver")
        for side in ("air", "traffic"):
            spark.sql(f"DROP TABLE pair_silver_{side}")


def test_joined_table_takes_no_date(spark, lake):
    layers.refine(spark, f"{lake}/raw/air", f"{lake}/raw/traffic", f"{lake}/silver")
    layers.join_silver(spark, f"{lake}/silver")
    register_table(spark, "whole_silver", f"{lake}/silver/joined", SILVER)
    args = ["marts", "--silver_table", "whole_silver", "--gold_output", f"{lake}/g"]
    with pytest.raises(ValueError, match="ingest_date"):
        job.run(spark, [*args, "--ingest_date", DAY1.isoformat()])
    spark.sql("DROP TABLE whole_silver")


def test_managed_table_is_not_replaced(spark, lake):
    spark.sql("CREATE TABLE owns_files (x int) USING parquet")
    with pytest.raises(ValueError, match="owns its files"):
        register_table(spark, "owns_files", f"{lake}/raw/air", RAW_AIR)
    spark.sql("DROP TABLE owns_files")


def test_refine_reports_and_drops_what_came_again(spark, lake):
    batch = raw_air(spark).drop(*DATE_KEYS)
    for day in (DAY1, DAY2):
        layers.ingest(batch, f"{lake}/again/air", day)
        layers.ingest(raw_traffic(spark).drop(*DATE_KEYS), f"{lake}/again/traffic", day)
    paths = (f"{lake}/again/air", f"{lake}/again/traffic")
    plain = layers.refine(spark, *paths, f"{lake}/s1")
    once = layers.refine(spark, *paths, f"{lake}/s2", drop_duplicates=True, report=True)
    assert plain["air"] == 2 * valid_air(raw_air(spark)).count()
    assert once["air"] == valid_air(batch.distinct()).count()
    assert read_lake(spark, f"{lake}/s2/air").select(*DATE_KEYS).distinct().count() == 1
    counts = layers.refine(spark, *paths, f"{lake}/s3", report=True)
    raw = [read_lake(spark, p, s) for p, s in zip(paths, (RAW_AIR, RAW_TRAFFIC), strict=True)]
    for source, _, rule, failed in quality_report(*raw).collect():
        if rule not in ("any_rule", "time_readable"):
            assert counts[f"{source}: {rule} failed"] == failed


def test_refine_day_by_day_drops_what_came_on_an_earlier_date(spark, lake):
    batch = raw_air(spark).drop(*DATE_KEYS).distinct()
    for day in (DAY1, DAY2):
        layers.ingest(batch, f"{lake}/daily/air", day)
        layers.ingest(raw_traffic(spark).drop(*DATE_KEYS), f"{lake}/daily/traffic", day)
    paths = (f"{lake}/daily/air", f"{lake}/daily/traffic")
    first, second = (
        layers.refine(spark, *paths, f"{lake}/s4", day=day, drop_duplicates=True) for day in (DAY1, DAY2)
    )
    assert first["air"] == valid_air(batch).count() and first["traffic"] > 0
    assert second["air"] == second["traffic"] == 0


def test_preview_and_files_follow_the_order(spark, tmp_path):
    mart = spark.range(5000).selectExpr(
        "concat('z', id) AS zone", "1 AS year", "1 AS month", "1 AS day",
        "cast(id * 7 % 5000 AS double) AS avg_pollution",
    )
    mart.repartition(7).write.parquet(f"{tmp_path}/m")
    stored = gold.in_order("datamart_pollution", spark.read.parquet(f"{tmp_path}/m"))
    assert [r.avg_pollution for r in stored.limit(3).collect()] == [4999.0, 4998.0, 4997.0]


def test_work_scope_deletes_its_folders(spark):
    with session.work_scope(spark):
        path = session.work_path(spark, "scoped")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_job_arguments():
    with pytest.raises(ValueError, match="output_traffic"):
        job.run(None, ["ingest", "--traffic_input", "x"])
    with pytest.raises(SystemExit):
        job.parser().parse_args(["marts", "--gold_output", "x"])


def test_cast_known(spark):
    df = spark.sql("SELECT 1.50BD AS humidity, 3L AS air_quality_index, 'x' AS other")
    assert cast_known(df, AIR_SOURCE).dtypes == [
        ("humidity", "double"),
        ("air_quality_index", "int"),
        ("other", "string"),
    ]


def test_jdbc_options(monkeypatch):
    url = "jdbc:mysql://db:3306/air"
    assert bounds_query("t", "id") == "SELECT MIN(id) AS low, MAX(id) AS high FROM t"
    monkeypatch.setenv("ZONALAKE_JDBC_USER", "reader")
    monkeypatch.setenv("ZONALAKE_JDBC_PASSWORD", "secret")
    read = jdbc_read_options(
        url, "t", partition_column="id", lower_bound=0, upper_bound=100, partitions=8
    )
    assert read["user"] == "reader" and read["password"] == "secret"
    assert (read["partitionColumn"], read["lowerBound"], read["numPartitions"]) == ("id", "0", "8")
    assert "partitionColumn" not in jdbc_read_options(url, "t")
    with pytest.raises(ValueError):
        jdbc_read_options(url, "t", partition_column="id")
    write = jdbc_write_options(url, "mart", user="writer")
    assert write["user"] == "writer" and write["truncate"] == "true"
    assert write["numPartitions"] == "1" and write["dbtable"] == "mart"


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("INTEGER", [*range(50), *[7] * 400, 10**9, -5, None, None]),
        ("DECIMAL(12, 3)", [Decimal(i) / 8 for i in range(200)] + [None]),
        ("DOUBLE", [0.1 * i for i in range(90)] + [1e300, -1e-300]),
        ("VARCHAR", [*"abcabcxyzABC", "o'clock", "back\\slash", "", "é", None]),
        ("DATE", [date(2024, 1, 1 + i % 28) for i in range(99)]),
        ("TIMESTAMP", [datetime(2024, 1, 1, i % 24, 5, 6, 789) for i in range(99)]),
        ("INTEGER", []),
        ("INTEGER", [None, None]),
        ("INTEGER", [3, 3, 3]),
    ],
)
@pytest.mark.parametrize("partitions", [1, 4, 300])
def test_lots_of_a_split_read_hold_each_row_once(kind, values, partitions):
    """The statements on another database: conditions cover every value and NULL once, in even lots."""
    db = duckdb.connect()
    db.execute(f"CREATE TABLE t (n INTEGER, v {kind})")
    if values:
        db.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    lots = db.execute(quantiles_query("t", "v", partitions)).fetchall()
    conditions = split_predicates("v", [upto for _, upto in sorted(lots)])
    assert 1 <= len(conditions) <= partitions
    found = [db.execute(f"SELECT n FROM t WHERE {c}").fetchall() for c in conditions]
    assert sorted(n for rows in found for (n,) in rows) == list(range(len(values)))
    if kind == "DOUBLE" and partitions == 4:
        assert max(map(len, found)) <= len(values) // 4 + 2
    later = db.execute(f"SELECT count(*) FROM t WHERE {conditions[-1]}").fetchone()[0]
    assert later == len(found[-1])


class _Connection:
    """What `in_one_transaction` uses of a connection, over another database."""

    def __init__(self, db):
        self.db = db

    def setAutoCommit(self, on):
        assert not on
        self.db.begin()

    def createStatement(self):
        return self

    def executeUpdate(self, statement):
        self.db.execute(statement)

    def commit(self):
        self.db.commit()

    def rollback(self):
        self.db.rollback()


def test_staged_rows_replace_a_table_once():
    """A task's rows that were staged twice count once, equal rows as often as they are; an error changes nothing."""
    db = duckdb.connect()
    db.execute('CREATE TABLE mart ("zone" VARCHAR, "mean of" DOUBLE)')
    db.execute("INSERT INTO mart VALUES ('old', 1)")
    db.execute('CREATE TABLE stage ("zone" VARCHAR, "mean of" DOUBLE, zonalake_row BIGINT)')
    rows = [("a", 1.5, 0), ("a", 1.5, 1), (None, None, 2), ("b", 2.0, 1 << 33)]
    db.executemany("INSERT INTO stage VALUES (?, ?, ?)", rows + rows[:3])
    statements = swap_statements("mart", "stage", ["zone", "mean of"])
    with pytest.raises(duckdb.Error):
        in_one_transaction(_Connection(db), [statements[0], statements[1].replace("stage", "nothing")])
    assert db.execute("SELECT * FROM mart").fetchall() == [("old", 1.0)]
    in_one_transaction(_Connection(db), statements)
    found = db.execute("SELECT * FROM mart").fetchall()
    assert sorted(found, key=str) == sorted((r[:2] for r in rows), key=str)


def test_work_paths_are_in_the_shared_folder(spark):
    one, two = session.work_path(spark, "x"), session.work_path(spark, "x")
    assert one != two
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or one.startswith(named)


def test_settled_table_is_known_to_be_small(spark):
    small = session.settle(spark.range(10).groupBy("id").count(), "small")
    plan = plan_of(spark.range(1000).join(small, "id"))
    assert "BroadcastHashJoin" in plan


# -- rows that came again, by an index ------------------------------------------------------------
ODD_ROWS = [
    ("a", "01/01/2024 07:05", 1.0, 1, 2.0, 3.0, 4.0), ("a", "01/01/2024 07:05", -0.0, 1, 2.0, 3.0, 4.0),
    ("a", "01/01/2024 07:05", 0.0, 1, 2.0, 3.0, 4.0), (None, "a", None, 1, None, 3.0, 4.0),
    ("a", None, None, 1, None, 3.0, 4.0), (None,) * 7, ("b", "02/01/2024 07:05", float("nan"), 1, 2.0, 3.0, 4.0),
    ("b", "02/01/2024 07:06", 1.0, None, 2.0, 3.0, 4.0), ("b", "02/01/2024 07:06", 1.0, 2, None, 3.0, 4.0),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_by_index_are_those_over_all_dates(spark, tmp_path, seed):
    """Dates in any order, late, again with other rows and without any."""
    draw = random.Random(seed)
    raw, index, kept = (f"{tmp_path}/{name}" for name in ("raw", "index", "kept"))
    days = [date(2024, month, day) for month in (1, 2) for day in (1, 28)]
    for step in range(9):
        day = draw.choice(days)
        rows = draw.choices(ODD_ROWS, k=draw.choice([0, 3, 9]))
        layers.ingest(spark.createDataFrame(rows, AIR_SOURCE), raw, day)
        reingest.refresh_first_rows(spark, raw, index, kept, RAW_AIR, AIR_TIME, day)
        if step % 2:
            found, expected = read_lake(spark, kept, RAW_AIR), drop_reingested(read_lake(spark, raw, RAW_AIR))
            # NaN equals itself as text; 0.0 and -0.0 are equal rows, and either may stay
            plain = [sorted(repr(row).replace("-0.0", "0.0") for row in bag(df)) for df in (found, expected)]
            assert plain[0] == plain[1]


def test_a_day_reads_its_rows_and_the_parts_it_touches(spark, tmp_path):
    raw, index = f"{tmp_path}/raw", f"{tmp_path}/index"
    for day in range(1, 8):
        rows = [("a", f"{x:02d}/01/2024 07:05", float(x), 1, 2.0, 3.0, 4.0) for x in (day, day - 1)]
        layers.ingest(spark.createDataFrame(rows, AIR_SOURCE), raw, date(2024, 1, day))
    last = date(2024, 1, 7)
    layers.build_index(read_lake(spark, raw, RAW_AIR), index, AIR_TIME)
    found = reingest.rows_of_day(spark, raw, index, RAW_AIR, AIR_TIME, last)
    assert list(found.kept) == [last]
    plan = found.kept[last]._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PartitionFilters: \[([^\]]*)\]", plan)
    raw_scan, index_scan = (next(f for c, f in scans if name in c) for name in ("pollution_value", "row_low"))
    assert re.search(r"year#\d+ = 2024.*month#\d+ = 1.*day#\d+ = 7", raw_scan)
    # of the index two parts, as the day holds two observation dates, and earlier dates only
    assert re.search(r"part#\d+ IN \(\d+,\d+\)", index_scan) and "< 20240107" in index_scan
    assert [r.pollution_value for r in found.kept[last].collect()] == [7.0]


def test_a_date_refined_late_renews_later_dates(spark, lake):
    batch = raw_air(spark).drop(*DATE_KEYS).distinct()
    traffic = raw_traffic(spark).drop(*DATE_KEYS)
    paths, silver = (f"{lake}/late/air", f"{lake}/late/traffic"), f"{lake}/s5"
    for day in (DAY2, DAY1):
        layers.ingest(batch, paths[0], day)
        layers.ingest(traffic, paths[1], day)
        layers.refine(spark, *paths, silver, day=day, drop_duplicates=True)
    layers.refine(spark, *paths, f"{lake}/s6", drop_duplicates=True)
    for side in ("air", "traffic"):
        expected = read_lake(spark, f"{lake}/s6/{side}")
        assert bag(read_lake(spark, f"{silver}/{side}", expected.schema)) == bag(expected)


def test_quarantine_keeps_every_row(spark, lake):
    paths, silver = (f"{lake}/q/air", f"{lake}/q/traffic"), f"{lake}/s7"
    for day, part in ((DAY1, "day = 1"), (DAY2, "day = 2")):
        layers.ingest(raw_air(spark).filter(part).drop(*DATE_KEYS), paths[0], day)
        layers.ingest(raw_traffic(spark).filter(part).drop(*DATE_KEYS), paths[1], day)
    layers.refine(spark, *paths, f"{lake}/s8")
    plain = [bag(df) for df in layers.silver_sides(spark, f"{lake}/s8")]
    layers.refine_with_quarantine(spark, *paths, silver)
    for day in (DAY2, DAY1, DAY1):  # again by date, over what is there
        layers.refine_with_quarantine(spark, *paths, silver, day)
    assert [bag(df) for df in layers.silver_sides(spark, silver, quarantine=True)] == plain
    sides = zip(("air", "traffic"), (RAW_AIR, RAW_TRAFFIC), (AIR_RULES, TRAFFIC_RULES), paths, strict=True)
    for side, schema, rules, path in sides:
        rejected = layers.rejected_rows(spark, silver, side).collect()
        accepted = layers.accepted_rows(spark, silver, side).count()
        raw = read_lake(spark, path, schema)
        assert accepted + len(rejected) == raw.count()
        for number, (name, rule) in enumerate(rules.items()):
            failing = raw.filter(f"NOT coalesce({rule}, false)")
            named = [r for r in rejected if name in rules_of_mask(r.failed_rules, rules)]
            assert sorted(repr(tuple(r)[:-1]) for r in named) == sorted(repr(tuple(r)) for r in failing.collect())
            assert all(r.failed_rules >> number & 1 for r in named)


def test_quarantine_reads_raw_once_and_its_rows_apart(spark, lake):
    raws = [read_lake(spark, f"{lake}/raw/{s}", x) for s, x in (("air", RAW_AIR), ("traffic", RAW_TRAFFIC))]
    for df in layers.checked_sides(*raws).values():
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    layers.refine_with_quarantine(spark, f"{lake}/raw/air", f"{lake}/raw/traffic", f"{lake}/s9")
    plan = layers.accepted_rows(spark, f"{lake}/s9", "air")._jdf.queryExecution().executedPlan().toString()
    assert "raw_row" not in plan and re.search(r"PartitionFilters: \[.*NOT rejected", plan)

"""Databases, registered layers, SQL builds and saved reports."""

import pytest

from clickstrata.operators.gold import TABLES
from clickstrata.operators.reports import REPORTS
from clickstrata.operators.silver import to_silver
from clickstrata.plans import gold_sql, report_sql
from clickstrata.plans.build_gold import build_gold
from clickstrata.schemas import GOLD, SILVER
from clickstrata.sources import bronze, catalog, gold_store, lake
from clickstrata.streaming.ingest import run_ingest
from tests import golden


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    feed = golden.write_feed(root / "feed")
    run_ingest(spark, feed, str(root / "lake"), str(root / "marks"))
    build_gold(lake.read_silver(spark, str(root / "lake")), str(root / "gold"))
    catalog.create_databases(spark)
    catalog.create_databases(spark)
    catalog.register_bronze(spark, feed)
    for _ in range(2):
        catalog.register_silver(spark, str(root / "lake"))
        catalog.register_gold(spark, str(root / "gold"))
    return root


def test_databases(spark, layers):
    names = {row.namespace for row in spark.sql("SHOW DATABASES").collect()}
    assert names >= {"bronze", "silver", "gold"}


def test_bronze_table_can_be_cleaned_like_the_folder(spark, layers):
    lines = bronze.parsed(bronze.table_lines(spark, "bronze.events_lines")).where("day < '06'")
    assert bronze.malformed(lines).select("raw_line").collect() == [("{bad json",)]
    silver = to_silver(bronze.well_formed(lines))
    assert golden.rows(silver) == golden.rows(spark.table("silver.events"))
    for name, build in TABLES.items():
        assert golden.rows(build(silver)) == golden.GOLD[name]


def test_bronze_table_finds_new_folders_on_repair(spark, layers):
    def hours():
        return {row[0] for row in spark.sql("SHOW PARTITIONS bronze.events").collect()}

    assert golden.DEC4 in hours() and len(hours()) == 4
    new = "year=2025/month=12/day=06/hour=00/minute=00"
    golden.write_file(layers / "feed", new, [golden.LINES[golden.DEC4][0]])
    assert new not in hours()
    catalog.register_bronze(spark, str(layers / "feed"))
    assert new in hours()
    assert spark.sql("SELECT user_id FROM bronze.events WHERE day = '06'").collect() == [("u1",)]


def test_silver_view_sees_committed_rows(spark, layers):
    assert spark.table("silver.events").count() == 9
    assert spark.sql("SELECT count(*) FROM silver.events WHERE day = 5").first()[0] == 2
    # Types as found in the files and folder names, not as declared.
    found = spark.table("silver.events").schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in SILVER]


def test_other_questions_of_silver_and_gold(spark, layers):
    spent = spark.sql(
        "SELECT user_id, round(sum(revenue), 2) AS spent FROM silver.events "
        "WHERE event_date = DATE'2025-12-04' GROUP BY user_id HAVING spent > 0 ORDER BY spent DESC"
    )
    assert [tuple(row) for row in spent.collect()] == [("u1", 59.98), ("u2", 10.0)]
    best = spark.sql(
        "SELECT product_id, purchases FROM gold.conversion_funnel ORDER BY purchases DESC LIMIT 1"
    )
    assert tuple(best.first()) == ("p_1001", 2)


def test_compacted_table_knows_its_days(spark, layers):
    root = str(layers / "compact")
    silver = lake.read_silver(spark, str(layers / "lake"))
    lake.compact(lake.on_days(silver, [20251204, None]), root)
    catalog.register_compacted(spark, root)
    assert spark.table("silver.compacted_events").count() == 7
    lake.compact(lake.on_days(silver, [20251205]), root)
    catalog.register_compacted(spark, root)
    table = spark.table("silver.compacted_events")
    assert golden.rows(table) == golden.rows(silver) and table.columns == silver.columns
    assert spark.sql("SHOW PARTITIONS silver.compacted_events").count() == 3


@pytest.mark.parametrize("name", GOLD)
def test_gold_tables(spark, layers, name):
    assert golden.rows(spark.table(f"gold.{name}")) == golden.GOLD[name]


@pytest.mark.parametrize("name", GOLD)
def test_tables_built_by_sql(spark, layers, name):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_by_sql")
    root = str(layers / "gold_by_sql")
    gold_sql.create_table(spark, name, "silver.events", "gold_by_sql", root)
    assert golden.rows(spark.table(f"gold_by_sql.{name}")) == golden.GOLD[name]
    spark.table("silver.events").where("day = 5").createOrReplaceTempView("day_five")
    gold_sql.create_table(spark, name, "day_five", "gold_by_sql", root)
    assert golden.rows(spark.table(f"gold_by_sql.{name}")) == golden.GOLD[name]
    gold_sql.refill_table(spark, name, "day_five", "gold_by_sql")
    refilled = golden.rows(spark.table(f"gold_by_sql.{name}"))
    assert refilled and refilled != golden.GOLD[name]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_from_the_catalog(spark, layers, name):
    source, build = REPORTS[name]
    assert report_sql.over_catalog(spark, name).collect() == build(
        gold_store.read_table(spark, source, str(layers / "gold"))
    ).collect()


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_saved_report(spark, layers, file_format):
    report = report_sql.over_catalog(spark, "user_activity")
    path = str(layers / f"report_{file_format}")
    gold_store.write_report(report, path, file_format)
    saved = spark.read.schema(report.schema).option("header", True).format(file_format).load(path)
    assert saved.collect() == report.collect()

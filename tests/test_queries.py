"""Every registered query against its SQL, and invariants between the layers."""

import pytest

import __spark_entry__ as entry
from clickstrata.schemas import FUNNEL_STEPS
from clickstrata.sources import sample_events
from tests.check import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Times and names of files are not for SQL.
ROWS_ONLY = {"bronze_newest_files"}
WITH_SQL = [key for key in entry.event_queries() if key not in ROWS_ONLY]


def test_every_query_has_sql():
    assert set(WITH_SQL) <= entry.oracle_sql().keys()


def test_newest_files(spark):
    files = entry.queries()["bronze_newest_files"](spark, SF_DIR).collect()
    assert len(files) == 10 and all(file.length > 0 for file in files)
    times = [file.modified for file in files]
    assert times == sorted(times, reverse=True)


@pytest.mark.parametrize("key", WITH_SQL)
def test_query_equals_sql(spark, con, key):
    assert compare(entry.queries()[key](spark, SF_DIR), con, entry.oracle_sql()[key]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def table(spark, key):
    return entry.queries()[key](spark, SF_DIR)


def test_funnel_counts_are_category_counts(spark):
    funnel = table(spark, "refresh_conversion_funnel").groupBy("category").sum(*FUNNEL_STEPS)
    category = table(spark, "refresh_category_performance")
    for step, kind in FUNNEL_STEPS.items():
        counts = category.where(f"event_type = '{kind}'").groupBy("category").sum("event_count")
        assert {tuple(r) for r in counts.collect()} == {
            (r["category"], r[f"sum({step})"]) for r in funnel.collect()
        }


def test_hourly_revenue_adds_up_to_silver(spark):
    silver = table(spark, "ingest_incremental").groupBy().sum("revenue").first()[0]
    hourly = table(spark, "refresh_hourly_revenue").groupBy().sum("total_revenue").first()[0]
    assert hourly == pytest.approx(silver)


def test_activity_counts_silver_rows_per_day(spark):
    silver = table(spark, "ingest_incremental").groupBy("event_date").count()
    activity = table(spark, "refresh_user_activity").select("event_date", "total_events")
    assert {tuple(r) for r in silver.collect()} == {tuple(r) for r in activity.collect()}


@pytest.mark.parametrize(
    "rule", ["LATE", "LONG_BEFORE", "WITHOUT_TIME", "WITHOUT_PRICE", "NEVER_VIEWED",
             "JOINED", "IN_ARRAY", "WITH_TEXT", "WITH_NESTED"]
)
def test_the_feed_has_rows_of_each_rule(spark, rule):
    feed = sample_events.bronze_frame(sample_events.read_events(spark, SF_DIR))
    purchases = feed.where("event_type = 'purchase'")
    assert not purchases.where(getattr(sample_events, rule)).isEmpty()


def test_uneven_rows_reach_the_layers(spark):
    lines, silver = table(spark, "bronze_scan"), table(spark, "ingest_incremental")
    read = sample_events.read_events(spark, SF_DIR)
    assert lines.count() == silver.count() < read.count()
    assert not silver.where("event_date IS NULL").isEmpty()
    assert not silver.where("event_type = 'purchase' AND revenue IS NULL").isEmpty()
    arrivals = lines.selectExpr("make_date(year, month, day) AS arrived", "timestamp")
    assert not arrivals.where("arrived > try_to_date(left(timestamp, 10))").isEmpty()
    unseen = table(spark, "gold_conversion_funnel").where("views = 0")
    assert not unseen.isEmpty()
    report = table(spark, "report_conversion_funnel")
    assert report.join(unseen, ["product_id", "category"]).isEmpty()


def first(value):
    """NULL before all others."""
    return (value is not None, value or "")


def latest(day):
    """Later days first, NULL after all others."""
    return (day is None, -day.toordinal() if day else 0)


@pytest.mark.parametrize(
    ("key", "order"),
    [
        ("gold_hourly_revenue", lambda r: first(r.event_datetime)),
        ("gold_product_views", lambda r: (-r.view_count, r.product_id)),
        (
            "gold_category_performance",
            lambda r: (first(r.event_date), r.category or "", r.event_type),
        ),
        ("gold_user_activity", lambda r: first(r.event_date)),
        ("report_conversion_funnel", lambda r: (-r.purchases, -r.views, r.product_id)),
        ("report_hourly_revenue", lambda r: first(r.hour)),
        ("report_top_products", lambda r: (-r.view_count, r.product_id)),
        (
            "report_category_performance",
            lambda r: (latest(r.event_date), r.category or "~", -r.event_count, r.event_type),
        ),
        ("report_user_activity", lambda r: latest(r.event_date)),
    ],
)
def test_order(spark, key, order):
    rows = table(spark, key).collect()
    assert rows == sorted(rows, key=order)


def test_thin_arrival_slots_are_one_file_however_wide_their_ids(spark, tmp_path):
    lines = spark.range(0, 90, 1, 6).selectExpr(
        "'l' || id AS value", "'2024' AS year", "'01' AS month", "'02' AS day",
        "lpad(CAST(id % 3 AS STRING), 2, '0') AS hour", "'00' AS minute", "id % 30 AS chunk",
    )
    sample_events.write_arrivals(lines, str(tmp_path / "few"))
    sample_events.write_bronze(lines, str(tmp_path / "many"))
    few, many = (spark.read.text(str(tmp_path / n)) for n in ("few", "many"))
    assert len(few.inputFiles()) == 3 and sorted(few.collect()) == sorted(many.collect())

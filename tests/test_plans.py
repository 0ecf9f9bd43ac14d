"""The physical plans: what is read, what is shuffled, what is not there."""

import re

import pytest

from clickstrata.operators import gold
from clickstrata.operators.reports import REPORTS
from clickstrata.plans import gold_sql
from clickstrata.operators.silver import to_lake, to_silver
from clickstrata.schemas import GOLD, SHARES
from clickstrata.sources import bronze, lake
from clickstrata.streaming.ingest import run_ingest
from tests import golden


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    feed = golden.write_feed(root / "feed")
    run_ingest(spark, feed, str(root / "lake"), str(root / "marks"))
    return feed, lake.read_silver(spark, str(root / "lake"))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def columns_read(frame):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan(frame))
    return [{column.split(":")[0] for column in schema.split(",")} for schema in schemas]


def test_cleaning_is_one_pass_without_shuffle(spark, stored):
    lines = bronze.scan(spark, stored[0])
    for frame in (to_lake(lines), to_silver(bronze.well_formed(lines))):
        assert "Exchange" not in plan(frame) and plan(frame).count("FileScan") == 1


@pytest.mark.parametrize(
    ("name", "columns", "exchanges", "pushed"),
    [
        ("conversion_funnel", {"event_type", "product_id", "category"}, 1, "In(event_type"),
        ("hourly_revenue", {"event_type", "event_date", "event_hour", "revenue"}, 1,
         "EqualTo(event_type,purchase)"),
        ("product_views", {"event_type", "product_id", "category"}, 1,
         "EqualTo(event_type,page_view)"),
        ("category_performance", {"event_date", "category", "event_type"}, 1, ""),
    ],
)
def test_gold_reads_little_and_combines_early(stored, name, columns, exchanges, pushed):
    table = gold.TABLES[name](stored[1])
    text = plan(table)
    assert columns_read(table) == [columns]
    assert text.count("Exchange") == exchanges
    assert "partial_" in text and "Batched: true" in text
    assert pushed in text
    below_first_shuffle = text[text.rindex("Exchange"):]
    assert "HashAggregate" in below_first_shuffle


def test_distinct_ids_are_combined_and_spread_by_id(stored):
    table = gold.user_activity(stored[1])
    text = plan(table)
    assert columns_read(table) == [{"event_date", "user_id"}, {"event_date", "session_id"}]
    assert "Expand" not in text
    for key in ("event_date#\\d+, user_id#\\d+", "day#\\d+, session_id#\\d+"):
        by_id = re.search(rf"Exchange hashpartitioning\({key}, ", text)
        assert "HashAggregate" in text[by_id.start():].split("FileScan")[0]
    # What is joined is a row per day.
    table.collect()
    sides = plan(table).split("BroadcastHashJoin")[1].split("Initial Plan")[0]
    assert re.search(r"HashAggregate\(keys=\[event_date#\d+\], functions=\[count\(user_id", sides)
    assert re.search(r"HashAggregate\(keys=\[day#\d+\], functions=\[count\(session_id", sides)


def test_only_the_silver_zone_is_read(stored):
    assert re.search(r"PartitionFilters: \[[^]]*\(zone#\d+ = silver\)[^]]*\]",
                     plan(gold.user_activity(stored[1])))
    assert "MetadataLogFileIndex" not in plan(stored[1])


@pytest.mark.parametrize("name", [*GOLD, *SHARES])
def test_no_window_cross_join_or_python(stored, name):
    frames = {table: build(stored[1]) for table, build in gold.TABLES.items()}
    text = plan((frames | golden.shares(stored[1]))[name])
    for word in ("Window", "Python", "Cartesian", "NestedLoop", "SinglePartition"):
        assert word not in text
    assert ("Join" in text) == (name == "user_activity")


def test_rankings_are_top_k_without_a_full_sort(spark):
    for name in ("conversion_funnel", "top_products"):
        source, build = REPORTS[name]
        text = plan(build(spark.createDataFrame([], GOLD[source]).repartition(2)))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_sql_user_activity_counts_each_id_once(spark, stored):
    assert "Expand" not in plan(gold_sql.select(spark, "user_activity", stored[1]))

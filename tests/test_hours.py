"""Hourly revenue as a stream: closed hours, late purchases, crashes; sketches of activity."""

from pathlib import Path

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from clickstrata.operators import gold, sketches
from clickstrata.operators.silver import to_silver
from clickstrata.sources import bronze
from clickstrata.sources import sample_events
from clickstrata.streaming.hours import HoursResult, read_hours, run_hours, write_hours
from clickstrata.streaming.ingest import run_ingest
from clickstrata.streaming.refresh import approximate_activity, run_refresh
from tests import golden


def purchase(time, price=1.0, quantity=2):
    return golden.event(time, "u1", "s1", "purchase", *golden.E1, quantity, price)


class Stream:
    def __init__(self, spark, root):
        self.spark = spark
        self.feed, self.into, self.marks = (str(root / n) for n in ("feed", "hours", "marks"))
        self.files = 1

    def arrive(self, *lines):
        slot = f"year=2025/month=12/day=04/hour=09/minute={self.files:02d}"
        golden.write_file(self.feed, slot, lines)
        self.files += 1

    def run(self, **options):
        return run_hours(self.spark, self.feed, self.into, self.marks, "2 hours", **options)

    def rows(self):
        return sorted(tuple(row) for row in read_hours(self.spark, self.into).collect())


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


def test_an_hour_is_written_once_it_is_closed(stream):
    stream.arrive(purchase("2025-12-04T09:10:00Z"), purchase("2025-12-04T09:50:00Z", None),
                  golden.event("2025-12-04T23:00:00Z", "u1", "s1", "page_view", *golden.E1),
                  "{bad json", purchase("no time"))
    assert stream.run() == HoursResult(0, 0) and stream.rows() == []
    # Late, but its hour is open.
    stream.arrive(purchase("2025-12-04T11:30:00Z"), purchase("2025-12-04T09:59:59Z", 5.0))
    assert stream.run() == HoursResult(0, 0)
    stream.arrive(purchase("2025-12-04T12:00:00Z"))
    assert stream.run() == HoursResult(1, 0)
    nine = ("2025-12-04 09:00:00", 12.0, 3)
    assert stream.rows() == [nine]
    # Its hour is closed; another one is not.
    stream.arrive(purchase("2025-12-04T09:30:00Z"), purchase("2025-12-04T10:30:00Z"))
    assert stream.run() == HoursResult(0, 1)
    stream.arrive(purchase("2025-12-05T00:00:00Z"))
    assert stream.run().closed == 3
    assert stream.rows() == [
        nine,
        ("2025-12-04 10:00:00", 2.0, 1),
        ("2025-12-04 11:00:00", 2.0, 1),
        ("2025-12-04 12:00:00", 2.0, 1),
    ]
    assert stream.run() == HoursResult(0, 0)


def test_an_hour_without_revenue_is_null(stream):
    stream.arrive(purchase("2025-12-04T09:10:00Z", None), purchase("2025-12-04T23:00:00Z"))
    assert stream.run().closed == 1
    assert stream.rows() == [("2025-12-04 09:00:00", None, 1)]


@pytest.mark.parametrize("noted", [True, False])
def test_batch_repeated_after_a_crash(stream, noted):
    stream.arrive(purchase("2025-12-04T09:10:00Z"), purchase("2025-12-04T23:00:00Z"))
    stream.run()
    before = stream.rows()
    commits = Path(stream.marks) / "commits"
    last = max(commits.glob("[0-9]*"), key=lambda path: int(path.name))
    for path in (last, last.with_name(f".{last.name}.crc")):
        path.unlink(missing_ok=True)
    if not noted:
        for path in (Path(stream.into) / "_committed").iterdir():
            path.unlink()
    stream.run()
    assert stream.rows() == before and len(before) == 1


def test_closed_hours_are_written_without_gathering_the_state_in_a_task(spark, tmp_path):
    task = F.udf(lambda at: str(TaskContext.get().partitionId()))
    hours = spark.range(0, 40, 1, 8).select(
        task("id").alias("event_datetime"), F.lit(1.0).alias("total_revenue"), "id"
    )
    write_hours(hours, str(tmp_path / "hours"))
    written = spark.read.parquet(str(tmp_path / "hours"))
    assert written.count() == 40 and len(list((tmp_path / "hours").glob("*.parquet"))) == 1
    assert written.select("event_datetime").distinct().count() == 8


def test_closed_hours_equal_the_table(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    golden.write_feed(stream.feed)
    # Nothing is so late that its hour would be closed.
    stream.arrive(purchase("2026-01-01T00:00:00Z"))
    run_hours(spark, stream.feed, stream.into, stream.marks, "30 days")
    assert {row for row in stream.rows()} == set()
    stream.arrive(purchase("2026-03-01T00:00:00Z"))
    run_hours(spark, stream.feed, stream.into, stream.marks, "30 days")
    silver = to_silver(bronze.well_formed(bronze.scan(spark, stream.feed)))


    table = gold.hourly_revenue(silver).where("event_datetime < '2026-01-30'")
    assert set(stream.rows()) == golden.rows(table) and len(stream.rows()) == 4


def test_sketches_of_periods(spark):
    feed = sample_events.bronze_frame(sample_events.read_events(spark, "/root/testdata/sf0.1"))
    silver = to_silver(feed)
    events = silver.withColumn("batch", F.pmod(F.xxhash64("timestamp"), F.lit(7)))
    days = sketches.day_sketches(events)
    assert days.count() > 100
    for period in ("week", "month", "year"):
        start = F.to_date(F.date_trunc(period, "event_date"))
        exact = silver.groupBy(start.alias("period")).agg(
            F.count_distinct("user_id"), F.count_distinct("session_id"), F.count("*")
        )
        want = {row[0]: tuple(row[1:]) for row in exact.collect()}
        found = sketches.activity_by(days, period).collect()
        assert {row.period for row in found} == set(want)
        for row in found:
            users, sessions, rows = want[row.period]
            assert abs(row.unique_users - users) <= 3 * sketches.STANDARD_ERROR * users
            assert abs(row.unique_sessions - sessions) <= 3 * sketches.STANDARD_ERROR * sessions
            assert row.total_events == rows


def test_sketches_follow_refresh(spark, tmp_path):
    feed, lake, gold_root, marks = (str(tmp_path / n) for n in ("feed", "lake", "gold", "marks"))
    for slots in ((golden.DEC4,), (golden.DEC4_LATE, golden.DEC5)):
        golden.write_feed(feed, slots)
        run_ingest(spark, feed, lake, str(tmp_path / "in"))
        for _ in range(2):
            run_refresh(spark, lake, gold_root, marks, with_sketches=True)
    found = approximate_activity(spark, gold_root, marks, "month").collect()
    assert {(str(row.period), *row[1:]) for row in found} == {
        ("2025-12-01", 4, 5, 8),
        ("None", 1, 1, 1),
    }

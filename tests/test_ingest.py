"""Incremental ingest and gold refresh: reruns, late files, crashes, resets."""

import os
import re
import shutil
import threading
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickstrata.operators import gold
from clickstrata.operators.silver import to_silver
from clickstrata.plans import build_gold as builds
from clickstrata.plans.build_gold import build_gold
from clickstrata.schemas import GOLD, QUARANTINE_ZONE, SILVER, SILVER_ZONE
from clickstrata.session import partitions_for
from clickstrata.sources import bronze, catalog, gold_store, lake, sample_events
from clickstrata.streaming.archive import Archive
from clickstrata.streaming.ingest import IngestResult, run_ingest
from clickstrata.streaming.refresh import run_compaction, run_refresh, touched_days
from tests import golden

FIRST = (golden.DEC4, golden.OLD)


class Pipeline:
    def __init__(self, spark, root):
        self.spark = spark
        self.feed, self.lake, self.gold = (str(root / n) for n in ("feed", "lake", "gold"))
        self.marks, self.gold_marks = str(root / "marks"), str(root / "gold_marks")

    def ingest(self, **options):
        return run_ingest(self.spark, self.feed, self.lake, self.marks, **options)

    def refresh(self):
        return run_refresh(self.spark, self.lake, self.gold, self.gold_marks)

    def silver(self):
        return lake.read_silver(self.spark, self.lake)

    def tables(self):
        return {n: golden.rows(gold_store.read_table(self.spark, n, self.gold)) for n in GOLD}


@pytest.fixture
def pipe(spark, tmp_path):
    return Pipeline(spark, tmp_path)


def forget_last_commit(marks):
    """What a job leaves that died after writing its batch and before noting so."""
    last = max((Path(marks) / "commits").glob("[0-9]*"), key=lambda path: int(path.name))
    for path in (last, last.with_name(f".{last.name}.crc")):
        path.unlink(missing_ok=True)


def forget_mark(folder):
    """The same of a job that keeps a mark."""
    for path in Path(folder).iterdir():
        path.unlink()


def test_each_file_is_taken_in_once(pipe):
    golden.write_feed(pipe.feed)
    assert pipe.ingest() == IngestResult(lines=10, refused=1)
    assert pipe.silver().count() == 9
    assert pipe.ingest() == IngestResult(lines=0, refused=0)
    assert pipe.silver().count() == 9
    schema = pipe.silver().schema
    assert [(f.name, f.dataType) for f in schema] == [(f.name, f.dataType) for f in SILVER]


def test_late_file_in_an_older_folder_is_found(pipe):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    late = [golden.event("2025-12-04T09:30:00Z", "u7", "s7", "page_view", *golden.E1)]
    golden.write_file(pipe.feed, "year=2025/month=11/day=30/hour=00/minute=05", late)
    assert pipe.ingest().lines == 1
    assert pipe.silver().where("user_id = 'u7' AND day = 4 AND month = 12").count() == 1


def test_events_are_stored_by_their_own_day(pipe):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    zone = Path(pipe.lake) / f"batch=0/zone={SILVER_ZONE}"
    assert {str(p.parent.relative_to(zone)) for p in zone.rglob("*.parquet")} == {
        "year=2025/month=12/day=4",
        "year=2025/month=12/day=5",
        "/".join(f"{k}=__HIVE_DEFAULT_PARTITION__" for k in ("year", "month", "day")),
    }


def test_refused_lines_are_kept_with_their_origin(pipe):
    golden.write_feed(pipe.feed)
    wrong = golden.event("2025-12-04T09:00:00Z", "u1", "s1", "purchase", *golden.E1, "x", 1.0)
    golden.write_file(pipe.feed, golden.DEC5, [wrong, "[]", ""], "more.jsonl.gz")
    result = pipe.ingest()
    kept = lake.read_quarantine(pipe.spark, pipe.lake).collect()
    assert {(row.raw_line, row.day) for row in kept} >= {("{bad json", 4), (wrong, 5)}
    assert len(kept) == result.refused
    assert all(row.source_file.endswith(".jsonl.gz") for row in kept)
    assert pipe.silver().count() == 9
    assert (Path(pipe.lake) / f"batch=0/zone={QUARANTINE_ZONE}/year=2025/month=12/day=5").is_dir()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("noted", [True, False])
def test_batch_repeated_after_a_crash_adds_nothing(pipe, noted):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    before = golden.rows(pipe.silver())
    forget_last_commit(pipe.marks)
    if not noted:
        # It died while writing: some files are there, others not, and one is a stray.
        forget_mark(f"{pipe.lake}/_committed")
        day = Path(pipe.lake) / f"batch=0/zone={SILVER_ZONE}/year=2025/month=12/day=4"
        stray = next(day.glob("*.parquet"))
        (day / "part-99999-stray.zstd.parquet").write_bytes(stray.read_bytes())
        next((day.parent / "day=5").glob("*.parquet")).unlink()
        assert pipe.silver().count() == 0
    assert pipe.ingest() == (IngestResult(0, 0) if noted else IngestResult(10, 1))
    assert pipe.silver().count() == 9 and golden.rows(pipe.silver()) == before
    assert lake.read_quarantine(pipe.spark, pipe.lake).count() == 1
    assert "MetadataLogFileIndex" not in plan(pipe.silver())


def test_files_of_an_unfinished_batch_are_not_seen(pipe):
    golden.write_feed(pipe.feed, FIRST)
    pipe.ingest()
    shutil.copytree(f"{pipe.lake}/batch=0", f"{pipe.lake}/batch=1")
    assert pipe.silver().count() == 7
    pipe.refresh()
    golden.write_feed(pipe.feed, (golden.DEC4_LATE, golden.DEC5))
    assert pipe.ingest().lines == 2
    assert pipe.silver().count() == 9
    pipe.refresh()
    assert pipe.tables() == golden.GOLD


def test_several_batches_are_counted_together(pipe):
    golden.write_feed(pipe.feed)
    assert pipe.ingest(max_files_per_trigger=1) == IngestResult(lines=10, refused=1)
    assert pipe.silver().count() == 9


def test_many_batches_outlive_the_compaction_of_the_file_logs(pipe):
    event = golden.LINES[golden.DEC4][0]
    for minute in range(0, 60, 5):
        slot = f"year=2025/month=12/day=04/hour=09/minute={minute:02d}"
        golden.write_file(pipe.feed, slot, [event.replace("09:05:00Z", f"09:{minute:02d}:00Z")])
    assert pipe.ingest(max_files_per_trigger=1).lines == 12
    assert sorted(path.name for path in Path(pipe.lake).iterdir()) == sorted(
        ["_committed", *(f"batch={n}" for n in range(12))]
    )
    pipe.refresh()
    assert pipe.tables()["user_activity"] == {(golden.D4, 1, 1, 12)}
    golden.write_file(pipe.feed, golden.DEC5, [event])
    assert pipe.ingest().lines == 1
    pipe.refresh()
    assert pipe.tables()["user_activity"] == {(golden.D4, 1, 1, 13)}


def test_finished_files_can_be_archived(pipe, tmp_path):
    archive = tmp_path / "archive"
    options = {"cleanSource": "archive", "sourceArchiveDir": str(archive)}
    golden.write_feed(pipe.feed, FIRST)
    pipe.ingest(**options)
    golden.write_feed(pipe.feed, (golden.DEC4_LATE, golden.DEC5))
    pipe.ingest(**options)
    assert pipe.ingest(**options).lines == 0
    assert list(archive.rglob("*.gz")) and pipe.silver().count() == 9


def source_state(marks):
    """Files of all logs of the stream."""
    return [p for p in Path(marks).rglob("*") if p.is_file() and "offsets" in str(p) or "sources" in str(p)]


def test_listing_and_state_do_not_grow_with_an_archive(pipe, tmp_path):
    archive = str(tmp_path / "archive")
    event, sizes = golden.LINES[golden.DEC4][0], []
    golden.write_file(pipe.feed, golden.OLD, golden.LINES[golden.OLD])
    for minute in range(12):
        slot = f"year=2025/month=12/day=04/hour={minute:02d}/minute=00"
        golden.write_file(pipe.feed, slot, [event, "{bad json"])
        assert pipe.ingest(archive=archive) == IngestResult(2, 1)
        sizes.append((len(list(Path(pipe.feed).rglob("*"))), len(source_state(pipe.marks))))
    assert len(set(sizes)) == 1
    # An old folder and an old time: it is new all the same.
    golden.write_file(pipe.feed, "year=2025/month=01/day=01/hour=00/minute=05", [event])
    late = Path(pipe.feed) / "year=2025/month=01/day=01/hour=00/minute=05/events.jsonl.gz"
    os.utime(late, (10**9, 10**9))
    assert pipe.ingest(archive=archive).lines == 1
    assert pipe.ingest(archive=archive).lines == 0
    assert pipe.silver().count() == 13
    assert len(list(Path(archive).rglob("*.gz"))) == 13
    assert [str(p.relative_to(pipe.feed)) for p in Path(pipe.feed).rglob("*.gz")] == [
        f"{golden.OLD}/events.jsonl.gz"
    ]
    pipe.refresh()
    assert pipe.tables()["product_views"] == {(*golden.E1, 13)}


@pytest.mark.parametrize("step", ["note", "set_mark", "commit", "_move"])
def test_archive_after_a_crash(pipe, tmp_path, monkeypatch, step):
    archive = str(tmp_path / "archive")
    golden.write_feed(pipe.feed, FIRST)
    pipe.ingest(archive=archive)
    golden.write_feed(pipe.feed, (golden.DEC4_LATE, golden.DEC5))

    def dies(*arguments):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if step == "set_mark":
            patch.setattr(lake, "set_mark", dies)
        elif step == "commit":
            # It died after the batch was finished, before the stream had noted that.
            patch.setattr(Archive, "move", lambda *arguments: None)
        else:
            patch.setattr(Archive, step, dies)
        if step == "commit":
            pipe.ingest(archive=archive)
            forget_last_commit(f"{pipe.marks}/epoch=1")
        else:
            with pytest.raises(Exception, match="lost"):
                pipe.ingest(archive=archive)
    for _ in range(2):
        pipe.ingest(archive=archive)
    assert golden.rows(pipe.silver()) == golden.rows(
        to_silver(bronze.well_formed(bronze.scan(pipe.spark, archive)))
    )
    assert pipe.silver().count() == 9
    pipe.refresh()
    assert pipe.tables() == golden.GOLD


def test_archive_inside_the_feed_is_refused(pipe):
    golden.write_feed(pipe.feed)
    with pytest.raises(ValueError, match="outside"):
        pipe.ingest(archive=f"{pipe.feed}/archive")


def test_reset_needs_new_marks_and_a_new_lake(spark, tmp_path, pipe):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    new_lake = str(tmp_path / "lake2")
    again = run_ingest(spark, pipe.feed, new_lake, str(tmp_path / "marks2"))
    assert again == IngestResult(lines=10, refused=1)
    assert golden.rows(lake.read_silver(spark, new_lake)) == golden.rows(pipe.silver())


def test_new_marks_on_a_filled_lake_are_refused(spark, tmp_path, pipe):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    with pytest.raises(ValueError, match="another checkpoint"):
        run_ingest(spark, pipe.feed, pipe.lake, str(tmp_path / "marks2"))
    assert pipe.silver().count() == 9


def test_nothing_arrived_yet(pipe):
    Path(pipe.feed).mkdir()
    assert pipe.refresh() == {}
    assert pipe.ingest() == IngestResult(lines=0, refused=0)
    assert pipe.refresh() == {}
    golden.write_feed(pipe.feed)
    assert pipe.ingest().accepted == 9
    pipe.refresh()
    assert pipe.tables() == golden.GOLD


def test_settings_are_put_back(pipe):
    keys = (
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    before = [pipe.spark.conf.get(key, None) for key in keys]
    golden.write_feed(pipe.feed)
    pipe.ingest()
    pipe.refresh()
    lake.compact(pipe.silver(), f"{pipe.gold}/compact")
    assert [pipe.spark.conf.get(key, None) for key in keys] == before


def test_shuffle_partitions_grow_with_the_files(pipe, monkeypatch):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    assert partitions_for(pipe.silver()) == 8
    monkeypatch.setattr("clickstrata.session.PARTITION_BYTES", 100)
    whole = partitions_for(pipe.silver())
    assert 8 < partitions_for(pipe.silver().select("event_date")) < whole
    assert partitions_for(pipe.silver(), days=1) == 8
    assert partitions_for(pipe.silver(), days=3) == 24
    monkeypatch.setattr("clickstrata.session.PARTITION_BYTES", 0.001)
    assert partitions_for(pipe.silver()) > 20_000


def test_files_before_the_cutoff_are_not_opened(pipe):
    golden.write_feed(pipe.feed)
    unreadable = Path(pipe.feed) / golden.OLD / "events.jsonl.gz"
    unreadable.write_bytes(b"this is not gzip")
    assert pipe.ingest().lines == 10
    assert bronze.scan(pipe.spark, pipe.feed).select("user_id").count() == 10
    assert bronze.well_formed(bronze.scan(pipe.spark, pipe.feed)).count() == 9


def test_unreadable_file_stops_ingest_and_is_taken_in_once_repaired(pipe):
    golden.write_feed(pipe.feed)
    broken = Path(pipe.feed) / golden.DEC5 / "events.jsonl.gz"
    whole = broken.read_bytes()
    broken.write_bytes(whole[: len(whole) // 2])
    with pytest.raises(StreamingQueryException):
        pipe.ingest()
    broken.write_bytes(whole)
    assert pipe.ingest().accepted == 9
    assert pipe.silver().count() == 9


def test_cutoff_is_a_parameter(pipe):
    golden.write_feed(pipe.feed)
    assert pipe.ingest(cutoff="2024").accepted == 10


def test_files_outside_arrival_folders(pipe):
    golden.write_file(pipe.feed, ".", golden.LINES[golden.DEC4])
    assert bronze.well_formed(bronze.scan(pipe.spark, pipe.feed)).count() == 0
    lines = bronze.scan(pipe.spark, pipe.feed, cutoff=None)
    assert bronze.well_formed(lines).where("year IS NULL").count() == 7
    assert pipe.ingest(cutoff=None) == IngestResult(lines=8, refused=1)
    assert pipe.silver().where("day = 4").count() == 6
    assert lake.read_quarantine(pipe.spark, pipe.lake).where("day IS NULL").count() == 1


def test_files_beside_arrival_folders(pipe, spark):
    golden.write_file(pipe.feed, "year=2025/month=12/day=04/hour=10/minute=00", golden.LINES[golden.DEC4])
    golden.write_file(pipe.feed, ".", golden.LINES[golden.DEC4])
    lines = bronze.scan(spark, pipe.feed, cutoff=None)
    assert bronze.well_formed(lines).count() == 14
    assert bronze.well_formed(lines).where("year IS NULL").count() == 7
    assert bronze.listing(spark, pipe.feed).count() == 2
    with pytest.raises(ValueError, match="beside"):
        pipe.ingest(cutoff=None)


def test_timestamps_far_off(pipe, tmp_path):
    texts = ["0001-01-01T00:00:00Z", "1500-02-28T23:00:00Z", "1969-12-31T23:59:59Z",
             "9999-12-31T23:59:59Z", "+12345-01-01T05:00:00Z", "2025-02-30T00:00:00Z"]
    lines = [golden.event(t, "u1", "s1", "purchase", *golden.E1, 1, 2.0) for t in texts]
    golden.write_file(pipe.feed, golden.DEC4, lines)
    assert pipe.ingest() == IngestResult(lines=6, refused=0)
    pipe.refresh()
    assert run_compaction(pipe.spark, pipe.lake, str(tmp_path / "compact"), str(tmp_path / "cm"))
    tables = {
        name: gold_store.read_table(pipe.spark, name, pipe.gold) for name in GOLD
    }
    assert golden.rows(tables["hourly_revenue"]) == {
        ("0001-01-01 00:00:00", 2.0, 1),
        ("1500-02-28 23:00:00", 2.0, 1),
        ("1969-12-31 23:00:00", 2.0, 1),
        ("9999-12-31 23:00:00", 2.0, 1),
        ("+12345-01-01 05:00:00", 2.0, 1),
        (None, 2.0, 1),
    }
    days = tables["user_activity"].selectExpr("CAST(event_date AS STRING)", "total_events")
    assert {row[0] for row in days.collect()} == {
        "0001-01-01", "1500-02-28", "1969-12-31", "9999-12-31", "+12345-01-01", None
    }
    assert lake.read_silver_files(pipe.spark, str(tmp_path / "compact")).count() == 6


def test_refresh_follows_ingest_batch_by_batch(pipe):
    golden.write_feed(pipe.feed, FIRST)
    pipe.ingest()
    assert pipe.refresh()["hourly_revenue"] == 2
    first = Path(pipe.gold) / "shares/product_counts/batch=0"
    files = {path.name for path in first.iterdir()}
    golden.write_feed(pipe.feed, (golden.DEC4_LATE, golden.DEC5))
    pipe.ingest()
    pipe.refresh()
    assert pipe.tables() == golden.GOLD
    assert {path.name for path in first.iterdir()} == files
    assert pipe.refresh() == {}


def test_refresh_reads_new_rows_only(pipe, monkeypatch):
    golden.write_feed(pipe.feed, FIRST)
    pipe.ingest()
    pipe.refresh()
    golden.write_feed(pipe.feed, (golden.DEC4_LATE, golden.DEC5))
    pipe.ingest()
    seen = []

    def add_batches(events, *rest):
        seen.append((events.count(), {row.batch for row in events.collect()}, events.inputFiles()))
        builds.add_batches(events, *rest)

    monkeypatch.setattr("clickstrata.streaming.refresh.add_batches", add_batches)
    # Earlier batches may be gone.
    shutil.rmtree(f"{pipe.lake}/batch=0")
    pipe.refresh()
    ((rows, batches, files),) = seen
    assert (rows, batches) == (2, {1})
    assert all("/batch=1/" in file for file in files)
    assert pipe.tables() == golden.GOLD


@pytest.mark.parametrize("kept", [100, 1, 0])
def test_refresh_repeated_after_a_crash_gives_the_same(pipe, monkeypatch, kept):
    monkeypatch.setattr("clickstrata.streaming.refresh.BATCHES_KEPT", kept)
    golden.write_feed(pipe.feed, FIRST)
    pipe.ingest()
    pipe.refresh()
    forget_mark(pipe.gold_marks)
    pipe.refresh()
    # The repeated run also meets batches that came after the crash.
    forget_mark(pipe.gold_marks)
    golden.write_feed(pipe.feed, (golden.DEC4_LATE,))
    pipe.ingest()
    pipe.refresh()
    golden.write_feed(pipe.feed, (golden.DEC5,))
    pipe.ingest()
    pipe.refresh()
    assert pipe.tables() == golden.GOLD
    assert (gold_store.base(pipe.spark, pipe.gold) >= 0) == (kept < 100)
    forget_mark(pipe.gold_marks)
    pipe.refresh()
    assert pipe.tables() == golden.GOLD


@pytest.mark.parametrize("step", ["write_day_ids", "write_shares", "write_base", "write_table"])
def test_refresh_that_dies_on_the_way_is_made_good(pipe, monkeypatch, step):
    monkeypatch.setattr("clickstrata.streaming.refresh.BATCHES_KEPT", 1)
    golden.write_feed(pipe.feed, FIRST)
    pipe.ingest()
    pipe.refresh()
    before = pipe.tables()
    golden.write_feed(pipe.feed, (golden.DEC4_LATE, golden.DEC5))
    pipe.ingest(max_files_per_trigger=1)
    whole = getattr(gold_store, step)

    def dies(*arguments):
        whole(*arguments)
        raise RuntimeError("lost")

    monkeypatch.setattr(gold_store, step, dies)
    with pytest.raises(RuntimeError, match="lost"):
        pipe.refresh()
    assert pipe.tables() == before
    monkeypatch.setattr(gold_store, step, whole)
    pipe.refresh()
    assert pipe.tables() == golden.GOLD


def test_distinct_ids_add_up_over_batches(pipe):
    def event(user, minute, day=4):
        time = f"2025-12-{day:02d}T09:{minute:02d}:00Z"
        return golden.event(time, user, f"s_{user}", "page_view", *golden.E1)

    arrivals = [["a", "b", None], ["b", "c"], ["a"], ["d", "a"]]
    for minute, users in enumerate(arrivals):
        slot = f"year=2025/month=12/day=04/hour=09/minute={minute:02d}"
        days = [4, 5] if minute == 3 else [4]
        golden.write_file(pipe.feed, slot, [event(u, minute, day) for u in users for day in days])
        pipe.ingest()
        if minute != 1:
            pipe.refresh()
    assert pipe.tables()["user_activity"] == {(golden.D4, 4, 5, 8), (golden.D5, 2, 2, 2)}
    ids = Path(pipe.gold) / "shares/day_ids/event_date=2025-12-04"
    assert sorted(path.name for path in ids.glob("batch=*")) == ["batch=0", "batch=1", "batch=3"]


def test_readers_never_meet_an_empty_table(pipe):
    golden.write_feed(pipe.feed, FIRST)
    pipe.ingest()
    pipe.refresh()
    before, met, done = pipe.tables(), [], threading.Event()

    def read():
        while not done.is_set():
            met.append(pipe.tables()["user_activity"])

    reader = threading.Thread(target=read)
    reader.start()
    golden.write_feed(pipe.feed, (golden.DEC4_LATE, golden.DEC5))
    pipe.ingest()
    pipe.refresh()
    for _ in range(3):
        build_gold(pipe.silver(), pipe.gold)
    met.append(pipe.tables()["user_activity"])
    done.set()
    reader.join()
    assert met[0] == before["user_activity"] and met[-1] == golden.GOLD["user_activity"]
    assert all(table in (met[0], met[-1]) for table in met)
    versions = [path.name for path in (Path(pipe.gold) / "user_activity").iterdir()]
    assert sorted(versions) == ["version=3", "version=4"]


def test_registered_tables_follow(pipe, spark):
    golden.write_feed(pipe.feed, FIRST)
    catalog.create_databases(spark, ("follow_silver", "follow_gold"))
    pipe.ingest()
    catalog.register_silver(spark, pipe.lake, "follow_silver")
    run_refresh(spark, pipe.lake, pipe.gold, pipe.gold_marks, "follow_gold")
    golden.write_feed(pipe.feed, (golden.DEC4_LATE, golden.DEC5))
    assert spark.table("follow_silver.events").count() == 7
    pipe.ingest(database="follow_silver")
    assert golden.rows(spark.table("follow_silver.events")) == golden.rows(pipe.silver())
    day = spark.table("follow_silver.events").where("day = 5 AND month = 12")
    assert day.count() == 2 and "MetadataLogFileIndex" not in plan(day)
    assert re.search(r"PartitionFilters: \[[^]]*day#\d+ = 5", plan(day))
    run_refresh(spark, pipe.lake, pipe.gold, pipe.gold_marks, "follow_gold")
    for name, rows in golden.GOLD.items():
        assert golden.rows(spark.table(f"follow_gold.{name}")) == rows


def test_touched_days(pipe):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    assert set(touched_days(pipe.silver())) == {20251204, 20251205, None}


def test_full_rebuild(pipe):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    for _ in range(2):
        counts = build_gold(pipe.silver(), pipe.gold)
        assert counts == {name: len(rows) for name, rows in golden.GOLD.items()}
        assert pipe.tables() == golden.GOLD
    # What is kept for refreshing is not touched by that.
    pipe.refresh()
    assert pipe.tables() == golden.GOLD


def test_empty_silver_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], SILVER)
    assert build_gold(empty, str(tmp_path / "gold")) == {}
    assert not (tmp_path / "gold").exists()


def test_day_filter_prunes_partitions(pipe):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    one_day = lake.on_days(pipe.silver(), [20251205])
    assert one_day.count() == 2
    assert lake.on_days(pipe.silver(), [None]).count() == 1
    assert lake.on_days(pipe.silver(), [None, 20251205]).count() == 3
    assert lake.on_days(pipe.silver(), []).count() == 0
    scan = gold.category_performance(one_day)._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in scan and "year" in scan.split("PartitionFilters: ")[1]


def test_compaction_keeps_rows_and_can_be_repeated(pipe, tmp_path):
    golden.write_feed(pipe.feed)
    pipe.ingest(max_files_per_trigger=1)
    root = str(tmp_path / "compact")
    for _ in range(2):
        lake.compact(pipe.silver(), root)
        rows = [tuple(row) for row in lake.read_silver_files(pipe.spark, root).collect()]
        assert sorted(map(str, rows)) == sorted(str(tuple(row)) for row in pipe.silver().collect())
    lake.compact(lake.on_days(pipe.silver(), [20251204]), root)
    assert lake.read_silver_files(pipe.spark, root).count() == 9


def test_compaction_follows_ingest_day_by_day(pipe, tmp_path):
    root, marks = str(tmp_path / "compact"), str(tmp_path / "compact_marks")

    def compact():
        return run_compaction(pipe.spark, pipe.lake, root, marks)

    def compacted():
        return golden.rows(lake.read_silver_files(pipe.spark, root))

    assert not compact()
    golden.write_feed(pipe.feed, FIRST)
    pipe.ingest()
    assert compact() and compacted() == golden.rows(pipe.silver())
    files = set(Path(root).rglob("*.parquet"))
    golden.write_feed(pipe.feed, (golden.DEC4_LATE, golden.DEC5))
    pipe.ingest()
    assert compact() and compacted() == golden.rows(pipe.silver())
    assert files < set(Path(root).rglob("*.parquet"))
    forget_mark(marks)
    assert compact() and compacted() == golden.rows(pipe.silver())
    assert not compact()


def test_compaction_splits_a_crowded_day(spark, tmp_path, monkeypatch):
    feed = sample_events.bronze_frame(sample_events.read_events(spark, "/root/testdata/sf0.1"))
    crowded = to_silver(feed.drop("event_id").repartition(8)).withColumns(
        {"year": F.lit(2025), "month": F.lit(12), "day": F.lit(4)}
    )
    monkeypatch.setattr(lake, "COMPACT_BYTES", "2m")
    root = str(tmp_path / "compact")
    lake.compact(crowded, root)
    files = list(Path(root).rglob("*.parquet"))
    assert len(files) > 2
    assert lake.read_silver_files(spark, root).count() == 100_000
    for path in files:
        kinds = [row[0] for row in spark.read.parquet(str(path)).select("event_type").collect()]
        assert kinds == sorted(kinds)


def test_batch_silver_sink_appends(spark, tmp_path, pipe):
    golden.write_feed(pipe.feed)
    pipe.ingest()
    root = str(tmp_path / "silver")
    assert lake.write_silver(pipe.silver().where("day = 77"), root) == 0
    assert not Path(root).exists()
    for times in (1, 2):
        assert lake.write_silver(pipe.silver(), root) == 9
        assert lake.read_silver_files(spark, root).count() == 9 * times

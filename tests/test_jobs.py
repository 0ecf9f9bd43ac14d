"""The command line jobs, one after the other on the golden feed."""

import pytest

from clickstrata.__main__ import run
from clickstrata.schemas import GOLD
from clickstrata.sources import gold_store, lake
from tests import golden


def test_pipeline_by_jobs(spark, tmp_path, capsys):
    feed, silver, gold = (str(tmp_path / name) for name in ("feed", "lake", "gold"))
    golden.write_feed(feed)

    def job(*arguments):
        run(spark, list(map(str, arguments)))
        return capsys.readouterr().out

    assert "4 files" in job("ready", "--feed", feed)
    assert job("ready", "--feed", feed, "--files", 4).endswith(": ready\n")
    ingest = ("ingest", "--feed", feed, "--lake", silver, "--checkpoint", tmp_path / "marks")
    assert job(*ingest) == "10 lines read, 9 accepted, 1 refused\n"
    assert job(*ingest) == "no new data\n"
    refresh = ("refresh", "--lake", silver, "--gold", gold, "--checkpoint", tmp_path / "gold_marks")
    assert "'user_activity': 3" in job(*refresh)
    assert job(*refresh) == "no new data\n"
    compacted = tmp_path / "compact"
    compact = ("compact", "--lake", silver, "--into", compacted, "--checkpoint", tmp_path / "cm")
    assert job(*compact) == ""
    assert job(*compact) == "no new data\n"
    assert lake.read_silver_files(spark, str(compacted)).count() == 9
    job("rebuild", "--lake", silver, "--gold", tmp_path / "rebuilt")
    job("rebuild", "--compacted", compacted, "--gold", tmp_path / "rebuilt2")
    for name, rows in golden.GOLD.items():
        for root in (gold, str(tmp_path / "rebuilt"), str(tmp_path / "rebuilt2")):
            assert golden.rows(gold_store.read_table(spark, name, root)) == rows
    assert "|p_1001    |electronics|3         |" in job("report", "top_products", "--gold", gold)
    job("report", "user_activity", "--gold", gold, "--into", tmp_path / "report")
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 3


def test_reports_over_registered_tables(spark, tmp_path, capsys):
    feed, silver, gold = (str(tmp_path / name) for name in ("feed", "lake", "gold"))
    golden.write_feed(feed)
    run(spark, ["ingest", "--feed", feed, "--lake", silver, "--checkpoint", f"{tmp_path}/marks"])
    run(spark, ["rebuild", "--lake", silver, "--gold", gold])
    for name in GOLD:
        spark.sql(f"DROP TABLE IF EXISTS gold.{name}")
    run(spark, ["register", "--lake", silver, "--gold", gold])
    capsys.readouterr()
    run(spark, ["report", "conversion_funnel", "--database", "gold"])
    assert "33.33" in capsys.readouterr().out
    assert spark.table("silver.events").count() == 9


def test_jobs_over_named_tables(spark, tmp_path, capsys):
    feed, silver, gold = (str(tmp_path / name) for name in ("feed", "lake", "gold"))
    golden.write_feed(feed)

    def job(*arguments):
        run(spark, list(map(str, arguments)))
        return capsys.readouterr().out

    names = ("--bronze-database", "b_named", "--silver-database", "s_named", "--gold-database", "g_named")
    job("register", "--feed", feed, *names)
    assert "year" in job("newest", "--feed", feed)
    into = tmp_path / "clean"
    assert job("clean", "--table", "b_named.events_lines", "--into", into) == "9 events\n"
    assert lake.read_silver_files(spark, str(into)).count() == 9
    ingest = ("ingest", "--feed", feed, "--lake", silver, "--checkpoint", tmp_path / "marks")
    job(*ingest, "--archive", tmp_path / "archive")
    job("register", "--lake", silver, *names)
    job("build-sql", "--events", "s_named.events", "--database", "g_named")
    for name, rows in golden.GOLD.items():
        assert golden.rows(spark.table(f"g_named.{name}")) == rows
    more = "year=2025/month=12/day=06/hour=00/minute=00"
    golden.write_file(feed, more, [golden.LINES[golden.DEC4][0]])
    assert "1 lines" in job(*ingest, "--database", "s_named", "--archive", tmp_path / "archive")
    assert list((tmp_path / "archive").rglob("*.gz"))
    job("build-sql", "--events", "s_named.events", "--database", "g_named", "--refill")
    assert golden.rows(spark.table("g_named.product_views")) == {("p_1001", "electronics", 4)}
    job("rebuild", "--table", "s_named.events", "--gold", gold, "--database", "g_other")
    refresh = ("refresh", "--lake", silver, "--gold", gold, "--checkpoint", tmp_path / "gm")
    job(*refresh, "--database", "g_other", "--sketches")
    assert golden.rows(spark.table("g_other.product_views")) == {("p_1001", "electronics", 4)}
    assert "|2025-12-01|4" in job("activity", "--gold", gold, "--checkpoint", tmp_path / "gm")
    hours = ("hours", "--feed", feed, "--into", tmp_path / "hours", "--checkpoint", tmp_path / "hm")
    assert "hours closed, 0 purchases too late" in job(*hours)


def test_unknown_report_is_refused(spark):
    with pytest.raises(SystemExit):
        run(spark, ["report", "nothing", "--gold", "x"])

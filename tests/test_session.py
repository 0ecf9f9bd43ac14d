"""Session settings and working folders."""

from types import SimpleNamespace

import pytest

from clickstrata.session import SETTINGS, configure, overridden, path_exists, working_dir


def test_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    assert {key: spark.conf.get(key) for key in SETTINGS} == SETTINGS


def test_working_folders_are_new_and_under_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = working_dir(spark, "x"), working_dir(spark, "x")
    assert first != second
    assert first.startswith(f"{shared}/x-")


def fake_session(master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        working_dir(fake_session("spark://host:7077"), "x")
    assert working_dir(fake_session("local[2]"), "x").startswith("/tmp/run-")


def test_overridden_settings_survive_an_error(spark):
    key, unset = "spark.sql.shuffle.partitions", "spark.clickstrata.test"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), overridden(spark, {key: "3", unset: "1"}):
        assert (spark.conf.get(key), spark.conf.get(unset)) == ("3", "1")
        raise RuntimeError
    assert (spark.conf.get(key), spark.conf.get(unset, None)) == (before, None)


def test_path_exists(spark, tmp_path):
    assert path_exists(spark, str(tmp_path)) and path_exists(spark, f"file://{tmp_path}")
    assert not path_exists(spark, f"{tmp_path}/missing")

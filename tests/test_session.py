"""Session helpers: required settings, shared folder, job labels."""

from __future__ import annotations

from gridmix.session import REQUIRED_CONF, configure, described, shared_dir


def test_configure_sets_required_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    configure(spark)
    for key, value in REQUIRED_CONF.items():
        assert spark.conf.get(key) == value


def test_shared_dir_lives_under_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "a", "b") == f"{base.rstrip('/')}/a/b"
    assert spark.sparkContext.getCheckpointDir() is not None


def test_described_labels_jobs_and_restores(spark):
    sc = spark.sparkContext
    sc.setJobDescription(None)
    with described(spark, "gridmix: probe"):
        assert sc.getLocalProperty("spark.job.description") == "gridmix: probe"
    assert sc.getLocalProperty("spark.job.description") is None

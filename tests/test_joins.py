"""Join helpers: broadcast only when proven small, same results either way."""

from __future__ import annotations

from gridmix.operators import joins as J


def _frames(spark):
    big = spark.createDataFrame([(c, i) for i, c in enumerate(["FR", "BE", "PT", "FR", "CH"])], "country_code string, v int")
    keys = spark.createDataFrame([("FR",), ("PT",)], "country_code string")
    return big, keys


def test_is_small_counts_at_most_bound_plus_one(spark):
    df = spark.range(100)
    assert J.is_small(df, 100) and not J.is_small(df, 99)


def test_checked_broadcast_hints_only_small_sides(spark):
    _, keys = _frames(spark)
    hinted = J.checked_broadcast(keys, 5)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower()
    assert J.checked_broadcast(keys, 1) is keys


def test_semi_and_anti_join_same_results_with_and_without_broadcast(spark):
    big, keys = _frames(spark)
    for bound in (10, 1):
        semi = sorted(r.v for r in J.semi_join(big, keys, "country_code", max_rows=bound).collect())
        anti = sorted(r.v for r in J.anti_join(big, keys, "country_code", max_rows=bound).collect())
        assert semi == [0, 2, 3] and anti == [1, 4]
        looked = J.lookup_join(big, keys.withColumn("k", keys.country_code), "country_code", "inner", max_rows=bound)
        assert sorted(r.v for r in looked.collect()) == [0, 2, 3]


def test_freeze_cuts_lineage(spark):
    df = spark.range(5).withColumnRenamed("id", "x")
    frozen = J.freeze(df)
    assert sorted(r.x for r in frozen.collect()) == [0, 1, 2, 3, 4]
    assert "Range" not in frozen._jdf.queryExecution().optimizedPlan().toString()

"""Declarative data-quality checks (DQ1-DQ5).

A check returns the *failing rows*; it passes when that frame is empty.  The
report runs every configured check and returns one row per check with its
failure count; all not-null checks of one model share a single aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridmix.functions import taxonomy as tx
from gridmix.operators.joins import anti_join


def not_null(df: DataFrame, column: str) -> DataFrame:
    """DQ1: rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """DQ2: values of ``column`` occurring more than once (NULL ignored)."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """DQ3: distinct values outside ``values`` with their counts; NULL passes."""
    return (df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
            .where(~F.col("value_field").isin(values)))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """DQ4 / JN2: child values with no parent row (NULL children pass)."""
    child = df.where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    keys = parent.select(F.col(parent_column).alias("from_field"))
    return anti_join(child, keys, "from_field")


@dataclass(frozen=True)
class Check:
    test: str
    model: str
    column: str
    values: list[str] = field(default_factory=list)
    parent: str | None = None
    parent_column: str | None = None

    @property
    def test_id(self) -> str:
        return f"{self.test}_{self.model}_{self.column}"


# FIXED VALUES: the project's 14 checks (10 not_null, 1 unique, 1 accepted_values,
# 2 relationships), per model.
CHECKS: list[Check] = [
    Check("not_null", "int_generation_daily", "country_code"),
    Check("not_null", "int_generation_daily", "generation_date"),
    Check("unique", "dim_countries", "country_code"),
    Check("not_null", "dim_countries", "country_code"),
    Check("accepted_values", "dim_countries", "country_code", values=tx.ACCEPTED_COUNTRIES),
    Check("not_null", "dim_countries", "country_name"),
    Check("not_null", "fct_energy_mix", "country_code"),
    Check("relationships", "fct_energy_mix", "country_code", parent="dim_countries", parent_column="country_code"),
    Check("not_null", "fct_energy_mix", "generation_date"),
    Check("not_null", "fct_energy_mix", "total_production_mwh"),
    Check("not_null", "fct_renewable_capacity", "country_code"),
    Check("relationships", "fct_renewable_capacity", "country_code", parent="dim_countries",
          parent_column="country_code"),
    Check("not_null", "fct_renewable_capacity", "capacity_date"),
    Check("not_null", "fct_renewable_capacity", "total_installed_capacity_mw"),
]


def failing_rows(check: Check, models: dict[str, DataFrame]) -> DataFrame:
    df = models[check.model]
    if check.test == "not_null":
        return not_null(df, check.column)
    if check.test == "unique":
        return unique(df, check.column)
    if check.test == "accepted_values":
        return accepted_values(df, check.column, check.values)
    if check.test == "relationships":
        return relationships(df, check.column, models[check.parent], check.parent_column)
    raise ValueError(f"unknown test {check.test}")


def _row(check: Check, failures) -> DataFrame:
    return failures.select(
        F.lit(check.test_id).alias("test_id"), F.lit(check.test).alias("test"),
        F.lit(check.model).alias("model"), F.lit(check.column).alias("column_name"),
        F.col("failures").cast("long").alias("failures"))


def observe_nulls(df: DataFrame, model: str, checks: list[Check] | None = None) -> tuple[DataFrame, Observation | None]:
    """DQ1 while a model is written: ``df`` that counts the failures of its not-null checks as its rows pass.

    The counts are known after the one job that writes ``df`` (``null_counts``).  They are taken in the tasks that write, of which
    Spark counts one attempt per partition, so a repeated task does not count twice.  A model without such checks is returned as it is.
    """
    wanted = [c for c in checks or CHECKS if c.test == "not_null" and c.model == model]
    if not wanted:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.count(F.when(F.col(c.column).isNull(), 1)).alias(c.test_id) for c in wanted]), seen


def report(models: dict[str, DataFrame], checks: list[Check] | None = None, known: dict[str, int] | None = None) -> DataFrame:
    """DQ5: one row per check: ``test_id, test, model, column_name, failures``.

    Checks whose failures are ``known`` (by test id, as ``observe_nulls`` counted them) read no model.  The other not-null checks of a model are counted in one aggregation over it; the
    others count their failing rows.  Each branch ends in a global aggregate,
    so the union is a handful of rows.
    """
    checks = checks or CHECKS
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    known = known or {}
    for c in checks:
        if c.test_id in known:
            one = next(iter(models.values())).sparkSession.range(1)
            parts.append(_row(c, one.select(F.lit(known[c.test_id]).alias("failures"))))
        elif c.test == "not_null":
            by_model.setdefault(c.model, []).append(c)
        else:
            counted = failing_rows(c, models).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(_row(c, counted))
    for model, cs in by_model.items():
        counts = models[model].agg(*[
            F.sum(F.when(F.col(c.column).isNull(), 1).otherwise(0)).alias(f"n{i}") for i, c in enumerate(cs)])
        stacked = counts.select(F.explode(F.array(*[
            F.struct(F.lit(c.test_id).alias("test_id"), F.lit(c.test).alias("test"),
                     F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"),
                     F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("long").alias("failures"))
            for i, c in enumerate(cs)])).alias("r")).select("r.*")
        parts.append(stacked)
    return reduce(DataFrame.unionByName, parts)


def failing_keys(models: dict[str, DataFrame], test: str, checks: list[Check] | None = None) -> DataFrame:
    """Failing rows of every check of one kind, as ``(test_id, model, column_name, value)``."""
    parts = []
    chosen = [c for c in checks or CHECKS if c.test == test]
    if test == "not_null":  # one pass over each model, however many of its columns are checked
        for model in dict.fromkeys(c.model for c in chosen):
            failed = F.array_compact(F.array(*[F.when(F.col(c.column).isNull(), F.struct(
                F.lit(c.test_id).alias("test_id"), F.lit(model).alias("model"), F.lit(c.column).alias("column_name")))
                for c in chosen if c.model == model]))
            parts.append(models[model].select(F.explode(failed).alias("f")).select("f.*", F.lit(None).cast("string").alias("value")))
        return reduce(DataFrame.unionByName, parts)
    for c in chosen:
        rows = failing_rows(c, models)
        value = {"unique": F.col("unique_field"), "accepted_values": F.col("value_field"), "relationships": F.col("from_field")}[test]
        parts.append(rows.select(F.lit(c.test_id).alias("test_id"), F.lit(c.model).alias("model"),
                                 F.lit(c.column).alias("column_name"), value.cast("string").alias("value")))
    return reduce(DataFrame.unionByName, parts)

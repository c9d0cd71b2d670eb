"""Print the physical plan tree and scan details of registered queries.

Usage: python scripts/plan_shapes.py [sf_dir] [name ...]
       python scripts/plan_shapes.py --warehouse SCRATCH_DIR [sf_dir]
For each query: the operator tree of ``explain("formatted")`` followed by the
``ReadSchema`` / ``PushedFilters`` / ``PartitionFilters`` lines of its scans.
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridmix.plans.catalog import QUERIES  # noqa: E402
from gridmix.session import local_session  # noqa: E402

DEFAULT = ["energy_mix", "capacity_per_unit", "renewable_capacity", "a71_parse", "ingest_append",
           "dq_report", "report_ranking", "report_country_detail"]


def show(name: str, df) -> None:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
    details = [ln for ln in text.splitlines()
               if ln.startswith(("ReadSchema", "PushedFilters", "PartitionFilters"))]
    print(f"### {name}\n\n```\n{tree}\n")
    print("\n".join(details) + "\n```\n")


def warehouse_plans(spark, sf_dir: str, scratch: str) -> None:
    """Plans of the warehouse path: models over partitioned Parquet bronze."""
    from pyspark.sql import functions as F

    from gridmix.contracts import BRONZE_A68, BRONZE_A71, BRONZE_A75
    from gridmix.functions import taxonomy as tx
    from gridmix.operators import ingest, marts, staging
    from gridmix.operators.ingest import IngestWindow
    from gridmix.plans import layers
    from gridmix.sources import fixtures as fx
    from gridmix.sources import landing
    from gridmix.sources.warehouse import MONTH_COL, Warehouse

    gen = fx.landed_a75(fx.bronze_a75_long(spark, sf_dir))
    landing.land_extract(gen.where(F.col("index") < F.lit("2001-06-01").cast("timestamp")), f"{scratch}/l1")
    landing.land_extract(fx.landed_a68(fx.bronze_a68(spark, sf_dir)), f"{scratch}/l1")
    wh = Warehouse(spark, f"{scratch}/wh")
    countries = fx.COUNTRIES_10
    layers.run_all(spark, wh, f"{scratch}/l1", countries, ["A75", "A68"],
                   IngestWindow(end="2001-06-01", default_start="1995-01-01"), exact_scale=2,
                   now="2026-01-01 00:00:00", fail_on_checks=False)
    wh.append_bronze(fx.bronze_a71(spark, sf_dir), tx.A71_TABLE, BRONZE_A71)
    b75 = wh.read_bronze(tx.BRONZE_TABLES["A75"], BRONZE_A75)
    show("warehouse: high-water marks (latest month per country only)", ingest.high_water_marks(b75))
    key = F.concat_ws("|", F.col("country_code"), F.col(MONTH_COL)).isin(["FR|2001-05", "BE|2001-05"])
    show("warehouse: refresh scan of touched months",
         marts.generation_daily(staging.stg_generation(b75.where(key)), 2))
    dim = spark.table(wh.name("gold", "dim_countries"))
    cpu = marts.capacity_per_unit(staging.stg_capacity_per_unit(wh.read_bronze(tx.A71_TABLE, BRONZE_A71)), 2,
                                  ordered=False)
    show("warehouse: fct_renewable_capacity over bronze and the dimension table",
         marts.renewable_capacity(staging.stg_capacity(wh.read_bronze(tx.BRONZE_TABLES["A68"], BRONZE_A68)),
                                  cpu, dim, 2))


def main() -> None:
    args = sys.argv[1:]
    scratch = None
    if args and args[0] == "--warehouse":
        scratch, args = args[1], args[2:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or DEFAULT
    spark = local_session()
    if scratch:
        warehouse_plans(spark, sf_dir, scratch)
    else:
        for name in names:
            show(name, QUERIES[name](spark, sf_dir))
    spark.stop()


if __name__ == "__main__":
    main()

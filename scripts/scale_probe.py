"""Scale probe: time the generation and per-unit models on replicated bronze.

Usage: python scripts/scale_probe.py SCRATCH_DIR [sf_dir] [factors]

Bronze is built once from the sf tables and replicated ``k`` times: generation
history is shifted by whole years per copy (a longer history, so groups grow
with the data); per-unit rows are repeated as re-appended loads (same units,
new ingestion stamp), the reference's own growth pattern.  The replicated
tables are written as Parquet, then each model is timed reading them through
the ``noop`` sink.  Prints one JSON line per factor.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from gridmix.operators import marts, staging  # noqa: E402
from gridmix.session import local_session  # noqa: E402
from gridmix.sources import fixtures as fx  # noqa: E402


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    scratch = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    factors = [int(x) for x in (sys.argv[3] if len(sys.argv) > 3 else "1,10,100").split(",")]
    spark = local_session()
    for k in factors:
        copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("copy")
        gen = fx.bronze_a75_long(spark, sf_dir).select("*", copies)
        gen = gen.withColumn("index", F.col("index") + F.make_interval(F.col("copy") * 10)).drop("copy")
        units = fx.bronze_a71(spark, sf_dir).select("*", copies)
        units = units.withColumn("ingestion_timestamp", F.col("ingestion_timestamp")
                                 + F.make_interval(days=F.col("copy"))).drop("copy")
        gpath, upath = f"{scratch}/x{k}/a75", f"{scratch}/x{k}/a71"
        gen.write.mode("overwrite").partitionBy("country_code").parquet(gpath)
        units.write.mode("overwrite").partitionBy("country_code").parquet(upath)
        g, u = spark.read.parquet(gpath), spark.read.parquet(upath)
        daily = marts.generation_daily(staging.stg_generation(g), exact_scale=2)
        out = {
            "factor": k,
            "a75_rows": g.count(),
            "a71_rows": u.count(),
            "generation_daily_s": timed(daily),
            "energy_mix_s": timed(marts.energy_mix(daily)),
            "capacity_per_unit_s": timed(marts.capacity_per_unit(staging.stg_capacity_per_unit(u), 2, ordered=False)),
        }
        print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

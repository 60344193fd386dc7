"""

Usage: python -m tools.scale_check [sf_dir] [n ...]

Every row of the derived views is repeated n times; the copy number is
appended to one text column so the copies stay distinct rows (the dedup
still has all of them to compare). Times cover the whole job, stage
included, forced with the ``noop`` sink.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inflate(df: DataFrame, n: int, text_col: str) -> DataFrame:
    copies = df.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    tagged = F.when(F.col(text_col) == "", F.col(text_col)).otherwise(
        F.concat(F.col(text_col), F.lit("~"), F.col("__copy").cast("string"))
    )
    return copies.withColumn(text_col, tagged).drop("__copy")


def main(argv):
    sys.path.insert(0, ".")
    from sluice.plans.admissions import admissions_etl
    from sluice.plans.smart_home import smart_home_etl
    from sluice.session import build_session
    from sluice.sources.fixtures import admissions_raw, smart_home_raw

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    factors = [int(x) for x in argv[2:]] or [1, 10, 30, 60]
    spark = build_session("local[8]", app_name="sluice-scale", shuffle_partitions=32)

    def timed(make) -> float:
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    batch = "20240131123456789"
    timed(lambda: admissions_etl(admissions_raw(spark, sf_dir), batch))  # warm-up
    timed(lambda: smart_home_etl(smart_home_raw(spark, sf_dir), batch))
    for n in factors:
        adm = inflate(admissions_raw(spark, sf_dir), n, "name")
        home = inflate(smart_home_raw(spark, sf_dir), n, "icon")
        a = timed(lambda: admissions_etl(adm, batch))
        s = timed(lambda: smart_home_etl(home, batch))
        print(f"n={n:<3d} admissions_etl {a:7.2f} s   smart_home_etl {s:7.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

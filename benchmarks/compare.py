"""Compare the numbering of dimension keys with its plain alternative.

Usage: python benchmarks/compare.py [rows]   (default 20 million, derived by Spark)
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from dimflow.operators.surrogate import number_densely, place_in_order  # noqa: E402


def run(name, df):
    start = time.perf_counter()
    df().write.format("noop").mode("overwrite").save()
    print(f"{name}: {time.perf_counter() - start:.1f} s", flush=True)


def main() -> None:
    count = int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000
    spark = (
        SparkSession.builder.master("local[*]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.checkpoint.dir", "/tmp/checkpoints/compare")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ids = spark.range(0, count, 1, 64)
    keys = ids.select(
        F.concat(F.lit("L"), (F.col("id") * 7919 % (count + 9)).cast("string")).alias("loan_id"),
        F.md5(F.col("id").cast("string")).alias("attributes"),
    )
    zero = spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
    by_key = F.row_number().over(Window.orderBy("loan_id"))
    run("numbering, range-partitioned", lambda: number_densely(place_in_order(keys, ["loan_id"]), zero))
    run("numbering, one global window", lambda: keys.withColumn("surrogate_key", by_key))
    spark.stop()


if __name__ == "__main__":
    main()

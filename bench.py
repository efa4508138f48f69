"""Headline timings as one JSON line.

Files are staged before the clock starts; each case is run once to warm up and then three times,
and its median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pruefspur import (  # noqa: E402
    export_table,
    hadoop,
    import_archives,
    import_export,
    import_folder,
    infer_types,
    read_booking_batches,
)
from pruefspur.operators import checks  # noqa: E402
from pruefspur.plans import queries as q  # noqa: E402

RUNS = 3


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def cases(spark: SparkSession, sf: str) -> dict:
    items = q.table(spark, sf, "lineitem").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )
    exported = hadoop.fresh_folder(spark, "bench-export")
    export_table(items, exported, "lineitem").collect()
    texts = hadoop.fresh_folder(spark, "bench-texts")
    q._order_texts(spark, sf).repartition(8).write.mode("append").parquet(texts)
    csvs = hadoop.fresh_folder(spark, "bench-csv")
    q._order_texts(spark, sf).repartition(4).write.mode("append").csv(
        csvs, sep=";", header=True, quote='"', escape='"'
    )
    batches = q.staged_batches(spark, sf)
    archives = q.staged_archives(spark, sf)
    target = hadoop.fresh_folder(spark, "bench-target")

    return {
        "export_lineitem": lambda: export_table(items, target, "lineitem").collect(),
        "import_lineitem": lambda: consume(import_export(spark, exported).tables["lineitem"]),
        "infer_types": lambda: consume(infer_types(spark.read.parquet(texts))),
        "import_folder_csv": lambda: consume(import_folder(spark, csvs).combined),
        "booking_batch": lambda: consume(read_booking_batches(spark, batches).combined),
        "archive_batch": lambda: consume(import_archives(spark, archives).combined("orders")),
        "pk_check": lambda: checks.key_check(items, ["l_orderkey", "l_linenumber"]).collect(),
        "de_decimal": lambda: consume(q.de_decimal(spark, sf)),
        "de_date": lambda: consume(q.de_date(spark, sf)),
        "clean_text": lambda: consume(q.clean_text(spark, sf)),
        "normalise_names": lambda: consume(q.normalise_names(spark, sf)),
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name, run in cases(spark, sf).items():
        run()
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

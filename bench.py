"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the number of threads.
Every query runs in full into Spark's no-op sink, once to warm up on the smallest
data set where there is one, then once measured.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from paytrail.session import prepare
from verification.catalog import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
HEADLINE = [
    "bronze_stream", "json_roundtrip", "silver", "alerts", "summary", "fact",
    *(name for name in QUERIES if name.startswith("v_")),
    "fraud_trend_7d", "fraud_heatmap", "dq_silver", "dq_gold",
]


def main() -> None:
    spark = prepare(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("paytrail-bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str, sf_dir: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    warm_up = os.path.join(os.path.dirname(SF_DIR), "sf0.001")
    if os.path.isdir(warm_up):
        for name in ("silver", "alerts", "summary"):
            seconds(name, warm_up)
    timings = {name: seconds(name, SF_DIR) for name in HEADLINE}
    print(json.dumps({
        "metric": "total seconds over headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(SF_DIR).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

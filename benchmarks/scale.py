"""Time queries on the driver's tables replicated with shifted keys, with their shuffles.

    python benchmarks/scale.py [factor ...]       (default: 1 10 100)

Replicas go to a fresh folder under /tmp. One JSON line is printed per factor.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

import bench  # noqa: E402

QUERIES = [
    "ded1_one_row_per_device_day",
    "agg2_null_profile",
    "agg4_constant_profile",
    "win3_cycles",
    "win4_cycle_numbers",
    "win6_lag_features",
    "win7_failed_cycles",
    "win_training_rows",
    "job2_preprocess",
]


def replicate(spark, source: str, target: str, factor: int) -> None:
    """Events with `factor` times the devices."""
    events = spark.read.parquet(f"{source}/events.parquet")
    most = events.agg(F.max("event_id") + 1, F.max("user_id") + 1).first()
    (
        events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
        .withColumn("event_id", F.col("event_id") + F.col("copy") * most[0])
        .withColumn("user_id", F.col("user_id") + F.col("copy") * most[1])
        .drop("copy")
        .repartition(8)
        .write.parquet(f"{target}/events.parquet")
    )


def shuffles(df) -> tuple[int, float]:
    """Run the plan; how many shuffles it has and the megabytes they wrote."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    found = []

    def walk(node) -> None:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleBytesWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(execution.executedPlan())
    return len(found), round(sum(found) / 1e6, 2)


def main(factors: list[int]) -> None:
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = bench.session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    registered = bench.workload.queries()
    for factor in factors:
        folder = tempfile.mkdtemp(prefix="scale-")
        replicate(spark, source, folder, factor)
        line = {"factor": factor, "events": spark.read.parquet(f"{folder}/events.parquet").count()}
        for name in QUERIES:
            best = None
            for _ in range(3):
                begun = time.perf_counter()
                registered[name](spark, folder).write.format("noop").mode("overwrite").save()
                took = time.perf_counter() - begun
                best = took if best is None else min(best, took)
            line[name] = {"seconds": round(best, 2)}
            if not name.startswith("job"):
                count, megabytes = shuffles(registered[name](spark, folder))
                line[name] |= {"shuffles": count, "shuffled_mb": megabytes}
        print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main([int(a) for a in sys.argv[1:]] or [1, 10, 100])

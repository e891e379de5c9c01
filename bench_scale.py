"""One group with most of the rows: chunked operators against one window per key.

Takes the group polls of BENCH_SF_DIR (default /root/testdata/sf0.1), repeats one group's timeline
BENCH_COPIES times (default 40) one after the other, and times each operator with its own chunk
length and with a chunk that holds a key's whole history, on BENCH_CPUS cores. Prints JSON lines.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import functions as F

    from lagwatch.operators import baseline, correlate, forecast, rules
    from lagwatch.operators import timeline as tl
    from lagwatch.plans import inputs
    from lagwatch.session import get_session, stage_table

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "40"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "lagwatch-bench-scale",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "64",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    polls = inputs.polled(spark, sf_dir)
    span = polls.count() * inputs.POLL_SECONDS
    repeats = F.when(F.col("consumer_group") == "group_1", copies).otherwise(1)
    shift = F.col("_copy").cast("long") * (span * tl.SECOND)
    table = stage_table(
        polls.withColumn("_copy", F.explode(F.sequence(F.lit(0), repeats - 1)))
        .withColumn(
            "event_time",
            F.timestamp_micros(F.unix_micros("event_time") + shift),
        )
        .drop("_copy"),
        "hot_polls",
    )
    metrics = stage_table(baseline.collect_metrics(table), "hot_metrics")
    rows = table.count()
    hot = table.where(F.col("consumer_group") == "group_1").count()

    whole = 100_000 * tl.DAY
    cases = {
        "collect_metrics": lambda c: baseline.collect_metrics(
            table, chunk_seconds=c or baseline.v.CHUNK_SECONDS
        ),
        "lag_percentile": lambda c: baseline.lag_percentile(
            table, chunk_seconds=c or baseline.v.CHUNK_SECONDS
        ),
        "group_rules": lambda c: rules.detect(
            metrics,
            [rules.inactive_rule(), rules.rebalance_rule()],
            chunk_seconds=c or rules.CHUNK_SECONDS,
        ),
        "correlation": lambda c: correlate.correlation(
            metrics, chunk_seconds=c or correlate.CHUNK_SECONDS
        ),
        "forecast": lambda c: forecast.forecast(
            metrics, "current_lag", chunk_rows=10**9 if c else forecast.BLOCK_ROWS
        ),
    }
    for name, build in cases.items():
        times = {}
        for label, chunk in (("chunked", 0), ("whole_key", whole)):
            for _ in range(2):
                began = time.perf_counter()
                build(chunk).write.format("noop").mode("overwrite").save()
                times[label] = round(time.perf_counter() - began, 2)
        print(json.dumps({"operator": name, "rows": rows, "hot": hot, "cpus": cpus, **times}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline timings: one JSON line, seconds per query (median of 3 after a warm-up) and rows per second.

``queries`` has whole runs; ``building`` is the part in which plans are built, with the jobs that some operators run
meanwhile. The change log is landed once as files before timing, as a real log would be.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import fixtures as fx  # noqa: E402
from reshard.functions.positions import position  # noqa: E402
from reshard.operators import folding, lag, loading, routing  # noqa: E402
from reshard.operators.audit import log_gap_audit  # noqa: E402
from reshard.operators.changes import assign_log_file  # noqa: E402
from reshard.plans import log_apply  # noqa: E402
from reshard.plans.batch_load import load_rows  # noqa: E402
from reshard.session import build_session, new_folder  # noqa: E402
from reshard.sinks.files import write_shards  # noqa: E402
from reshard.sources.changelog import read_changelog, stream_changelog  # noqa: E402
from reshard.streaming.apply import StreamApply  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = new_folder(spark, "bench")

    landed = f"{folder}/log"
    fx.row_events(spark, SF_DIR).repartitionByRange(int(CPUS), "seq").write.parquet(landed)
    snapshot = fx.build(spark, SF_DIR, fx.SNAPSHOT)
    beats = fx.build(spark, SF_DIR, fx.HEARTBEATS)
    raw, audited = fx.build(spark, SF_DIR, fx.RAW), fx.build(spark, SF_DIR, fx.AUDITED)
    changes = fx.table(spark, SF_DIR, "events").count()
    rows = snapshot.count()
    starts = fx.build(spark, SF_DIR, fx.POSITIONS).select(
        "source", position(F.col("log_file"), F.col("log_pos")).alias("start")
    )
    starts.write.parquet(f"{folder}/starts")
    starts = spark.read.parquet(f"{folder}/starts")
    spec = fx.LOGGED_LIKES

    def log():
        return read_changelog(spark, landed)

    def loaded(of=fx.LIKES):
        return load_rows(snapshot, of)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    step = iter(range(10**6))

    def stream():
        """All batches are part of the run; only the final read is a plan."""
        apply = StreamApply(spec, f"{folder}/state-{next(step)}")

        def run() -> None:
            apply.start(stream_changelog(spark, landed, files_per_trigger=4), every=None).awaitTermination()
            drain(apply.current(spark))

        return run

    def shards():
        routed = loaded()
        return lambda: write_shards(routed, fx.LIKES, f"{folder}/shards-{next(step)}")

    def operations():
        return log_apply.single_key_operations(log(), spec)

    # Each builds a plan, or something to call.
    jobs = {
        "route_snapshot": (rows, lambda: routing.route_snapshot(snapshot, fx.LIKES)),
        "insert_ignore": (rows, loaded),
        "reorder_snapshot": (rows, lambda: loading.reorder(loaded(), fx.LIKES)),
        "write_shards": (rows, shards),
        "number_in_shard": (rows, lambda: loading.number_in_shard(loaded(), fx.LIKES)),
        "dry_run_preview": (rows, lambda: loading.first_of_batches(loaded(), fx.LIKES, 50)),
        "split_key_moves": (changes, operations),
        "compact_changes": (changes, lambda: folding.compact_changes(operations(), spec)),
        "apply_changes": (rows + changes, lambda: log_apply.apply_log(loaded(spec), log(), spec)),
        "bootstrap_state": (rows + changes, lambda: log_apply.bootstrap_state(snapshot, log(), starts, spec)),
        "assign_log_file": (changes, lambda: assign_log_file(raw)),
        "log_gap_audit": (changes, lambda: log_gap_audit(audited)),
        "pause_transitions": (changes, lambda: lag.pause_transitions(beats)),
        "stream_apply": (changes, stream),
    }
    seconds, building, rates = {}, {}, {}
    for name, (count, build) in jobs.items():
        times = []
        for _ in range(1 + RUNS):
            begin = time.perf_counter()
            built = build()
            ready = time.perf_counter()
            built() if callable(built) else drain(built)
            times.append((time.perf_counter() - begin, ready - begin))
        seconds[name], building[name] = (round(statistics.median(t), 4) for t in zip(*times[1:]))
        rates[name] = round(count / seconds[name])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "building": building,
                "rows_per_sec": rates,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()

"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every batch query is executed in full with a ``noop`` write (no collect).
The three service streams (metrics, live snapshot, enrichment) replay the
whole table through the file source one slice per trigger. Publishing and
landing the replay happens once (``stream_landing``); each stream is then
timed end to end (stream + read-back) and reported as events per second of
stream time plus the median micro-batch time. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from editstream.session import build_session  # noqa: E402


def _sf(sf_dir: str) -> float | str:
    tail = os.path.basename(sf_dir.rstrip("/"))
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "2"))
    with_streams = os.environ.get("BENCH_STREAMS", "1") != "0"

    spark = build_session(f"local[{cpus}]", app="editstream-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    import importlib.util
    spec = importlib.util.spec_from_file_location(
        "entry", os.path.join(os.path.dirname(os.path.abspath(__file__)), "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    from editstream.plans.catalog import BATCH_QUERIES

    # Warm-up: JVM start, codegen caches, file listing.
    BATCH_QUERIES["window_metrics"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name, q in BATCH_QUERIES.items():
        best = None
        for _ in range(rounds):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)

    extra = {}
    if with_streams:
        from editstream.plans.catalog import valid
        from editstream.streaming import replays
        n_events = valid(spark, sf_dir).count()
        t0 = time.perf_counter()
        replays.landed_replay(spark, sf_dir)          # publish + land the replay once
        timings["stream_landing"] = round(time.perf_counter() - t0, 3)
        for which in ("metrics", "live", "enriched"):
            try:
                t0 = time.perf_counter()
                table, q, stream_s = replays.run_service_replay(spark, sf_dir, which)
                table.write.format("noop").mode("overwrite").save()
                timings[f"stream_{which}"] = round(time.perf_counter() - t0, 3)
                batches = sorted(int(p["durationMs"]["triggerExecution"]) for p in q.recentProgress)
                extra[f"stream_{which}_events_per_sec"] = round(n_events / stream_s, 1)
                extra[f"stream_{which}_median_batch_ms"] = batches[len(batches) // 2] if batches else None
            except Exception as exc:  # report, keep the batch numbers
                extra[f"stream_{which}_error"] = f"{type(exc).__name__}: {str(exc)[:200]}"

    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": _sf(sf_dir),
        **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

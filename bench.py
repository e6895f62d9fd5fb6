"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is executed in full with the ``noop`` sink (the whole plan runs,
nothing is collected to the driver). A small warm-up query runs first so
JVM start-up is not charged to the first measured query.

Besides seconds, the line carries per-query shuffle-write megabytes, read
from Spark's event log (written to a scratch folder; the
bench is local-only). Jobs are attributed to queries by time window:
queries run one after another and streaming queries finish before their
query function returns.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators import control  # noqa: E402
from tidemark.plans import registry  # noqa: E402
from tidemark.plans import retail as R  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "join_star_fact",
    "agg_daily_category",
    "agg_city",
    "win_rank_topn",
    "win_dense_rank",
    "win_cumulative",
    "win_top10",
    "fn_tenure_segment",
    "join_sort_merge",
    "join_broadcast",
    "sink_parquet_overwrite",
    "st_validate",
    "st_minute_total",
    "st_sliding",
    "st_watermark_append",
    "st_dedup_watermark",
    "st_tx_minute_total",
    "src_stream_json",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def report_suite(spark, sf_dir):
    """All six order-analytics reports from one materialised fact table; the
    independent report jobs run concurrently."""
    fact = R.materialize_for_reports(spark, R.fact_table(R.prepared(spark, sf_dir, skew_safe_joins=True)))
    control.run_concurrently(
        {name: (lambda df=df: _run(df)) for name, df in R.reports(fact).items()})


def _event_log_conf(folder: str) -> dict:
    return {"spark.eventLog.enabled": "true", "spark.eventLog.dir": folder,
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}


def _io_per_query(folder: str, windows: dict[str, tuple[float, float]]) -> dict:
    """Shuffle-write MB per query from the event log (best effort)."""
    metrics = {"shuffle_write": "internal.metrics.shuffle.write.bytesWritten"}
    stage_bytes: dict[int, dict[str, int]] = {}
    stage_start: dict[int, float] = {}
    for root, _, files in os.walk(folder):
        for name in files:
            with open(os.path.join(root, name), encoding="utf-8") as fh:
                for line in fh:
                    e = json.loads(line)
                    if e.get("Event") != "SparkListenerStageCompleted":
                        continue
                    info = e["Stage Info"]
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    stage_bytes[info["Stage ID"]] = {
                        k: int(acc.get(m, 0) or 0) for k, m in metrics.items()}
                    stage_start[info["Stage ID"]] = info.get("Submission Time", 0) / 1000.0
    out = {k: {} for k in metrics}
    for query, (t0, t1) in windows.items():
        for kind in metrics:
            total = sum(b[kind] for sid, b in stage_bytes.items() if t0 <= stage_start[sid] <= t1)
            out[kind][query] = round(total / 1e6, 2)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    evlog = tempfile.mkdtemp(prefix="tidemark-bench-evlog-")
    spark = build_session(
        f"local[{cpus}]", app_name="tidemark-bench", shuffle_partitions=int(cpus) * 2,
        extra={"spark.driver.memory": "16g", **_event_log_conf(evlog)},
    )
    qs = registry.queries()
    _run(qs["proj_select"](spark, sf_dir))  # warm-up

    timings: dict[str, float] = {}
    windows: dict[str, tuple[float, float]] = {}
    for key in HEADLINE:
        w0, t0 = time.time(), time.perf_counter()
        _run(qs[key](spark, sf_dir))
        timings[key] = round(time.perf_counter() - t0, 3)
        windows[key] = (w0, time.time())
    w0, t0 = time.time(), time.perf_counter()
    report_suite(spark, sf_dir)
    timings["retail_report_suite"] = round(time.perf_counter() - t0, 3)
    windows["retail_report_suite"] = (w0, time.time())
    spark.stop()  # flushes the event log
    try:
        io = _io_per_query(evlog, windows)
    except (OSError, ValueError, KeyError):
        io = {}

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "shuffle_write_mb": io.get("shuffle_write", {}),
    }))


if __name__ == "__main__":
    main()

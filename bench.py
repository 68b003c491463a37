"""Headline timings. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query is warmed up once and timed BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from tidemark.operators import parsing, routing, versions  # noqa: E402
from tidemark.plans import reports, rollups  # noqa: E402
from tidemark.session import build_session, fresh_path  # noqa: E402
from tidemark.sources import envelopes, readers, writers  # noqa: E402
from tidemark.sources import sample_tables as st  # noqa: E402
from tidemark.streaming import jobs  # noqa: E402

FROM_TABLES = ["v01_current_items", "q01_product_daily", "q03_customer_segments", "q04_customer_segments_view_literal",
               "q05_hourly_sales_view_lineitem", "q13_rfm_segments", "q17_repeat_purchase", "q18_bought_together",
               "q19_cohort_ltv_all", "q22_revenue_forecast", "q28_order_page", "k06_illegal_transitions"]


def stream_latency(spark, times: int = 5) -> list[float]:
    """Seconds from a file of 100 order changes in the topic to its rows in the log, with the running sync of the fast profile."""
    base = fresh_path(spark, "bench-stream")
    log = st.orders_log(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")).limit(100)
    texts = [r.value for r in envelopes.order_envelopes(log).collect()]
    topic = f"{base}/topics/orders-cdc"
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(topic)
    arrived: list[tuple[int, float]] = []
    query = jobs.sync(readers.change_stream(spark, "orders-cdc", path=f"{base}/topics"), "orders", base, mode="all", profile=writers.FAST,
                      after=lambda batch, number: arrived.append((batch.count(), time.perf_counter())))
    taken = []
    try:
        for number in range(times + 1):
            start = time.perf_counter()
            if number:
                spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(topic)
            while sum(n for n, _ in arrived) < 100 * (number + 1):
                if query.exception() is not None:
                    raise query.exception()
                time.sleep(0.05)
            taken.append(arrived[-1][1] - start)
    finally:
        query.stop()
    return taken[1:]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", cpus, {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    # What the jobs leave behind in operation: topic text and compacted current rows.
    events, items_at, orders_at = (fresh_path(spark, f"bench-{n}") for n in ("events", "items", "orders"))
    envelopes.item_envelopes(st.items_log(spark, root)).write.text(events)
    versions.write_by_month(st.items(spark, root), items_at)
    versions.write_by_month(st.orders(spark, root), orders_at)
    items, orders = spark.read.parquet(items_at), spark.read.parquet(orders_at)

    def current_from_events():
        rows = parsing.item_rows(routing.route(spark.read.text(events), "order_items"))
        return versions.latest(rows, ties=("product_id",))

    timed = {name: (lambda name=name: QUERIES[name](spark, root)) for name in FROM_TABLES}
    timed["events_to_current_rows"] = current_from_events
    timed["q01_on_snapshot"] = lambda: rollups.product_daily(items, orders)
    timed["q08_on_snapshot"] = lambda: reports.kpi_orders(orders, st.AS_OF)
    timed["q32_on_snapshot"] = lambda: reports.daily_revenue_week(orders, st.AS_OF)

    seconds = {}
    for name, build in timed.items():
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    latency = round(statistics.median(stream_latency(spark)), 3)
    n_events = spark.read.text(events).count()
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(root.rstrip("/")), "cpus": cpus, "shuffle_partitions": cpus, "runs": runs,
        "stream_100_changes_to_log_sec": latency,
        "events_per_second": round(n_events / seconds["events_to_current_rows"])}), flush=True)


if __name__ == "__main__":
    main()

"""Headline timings: one warm-up, then the mean of three, printed as one JSON line.

The star is built on storage first (timed as ``refresh_*``); the ``gold_*`` queries then read it,
as the published baseline does. The other queries read the raw tables.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from datetime import datetime

from medalake.operators.scd import scd2_stats
from medalake.operators.star import wide_view
from medalake.plans import catalogue as cat, fixture as fx, registered, run
from medalake.session import local_session

REPEAT = 3
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def gold_queries(spark, star):
    segments = ("frecuente", *(s.lower() for s in fx.SEGMENTS))
    return {
        "bench_a": lambda: cat.monthly_confirmed(star),
        "bench_a_rowstore_form": lambda: registered.queries()["bench_a_rowstore_form"](
            spark, SF_DIR
        ),
        "bench_b": lambda: cat.full_scan(star.fact),
        "gold_q1_monthly": lambda: cat.monthly_revenue(star),
        "gold_q2_utilisation": lambda: cat.seat_utilisation(star, registered.SINCE),
        "gold_q3_conversion": lambda: cat.channel_conversion(star),
        "gold_q4_lead_time": lambda: cat.lead_time(star),
        "gold_q5_peaks": lambda: cat.booking_peaks(star),
        "gold_topk_routes": lambda: cat.top_routes(star),
        "gold_pivot_day_hour": lambda: cat.day_hour_matrix(star),
        "gold_trend_monthly": lambda: cat.monthly_trend(star),
        "gold_kpi_row": lambda: cat.kpi_row(star),
        "gold_pivot_channel_segment": lambda: cat.channel_segment_matrix(star, segments),
        "gold_wide_view": lambda: wide_view(star),
        "gold_scd2_stats": lambda: scd2_stats(star.pasajero, "pasajero_id"),
        "gold_checks_32": lambda: run.check_gold(star),
    }


RAW = (
    "q1_monthly", "q2_utilisation", "q4_lead_time", "clean_silver", "dedupe_keep_first",
    "quality_ledger", "surrogate_key", "two_hop_lookup", "scd2_build", "scd2_apply", "pit_join",
    "fact_build", "rolling_segment", "pre_post_change", "star_wide_view", "dq_unique",
)


def main() -> None:
    spark = local_session(CPUS, app="bench", driver_memory="16g")
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    times = {}
    with tempfile.TemporaryDirectory(prefix="medalake-bench-") as root:
        source = fx.bronze(spark, SF_DIR)
        at = datetime(2026, 1, 1)
        times["refresh_bronze"] = timed(lambda: run.land(source, root, "bench", at))
        times["refresh_silver"] = timed(lambda: run.refresh_silver(spark, root))
        times["refresh_gold"] = timed(
            lambda: run.refresh_gold(spark, root, fx.segment_changes, fx.EPOCH)
        )
        # The same again, with code compiled and files in memory.
        later = datetime(2026, 1, 2)
        times["refresh_bronze_warm"] = timed(lambda: run.land(source, root, "bench", later))
        times["refresh_silver_warm"] = timed(lambda: run.refresh_silver(spark, root))
        times["refresh_gold_warm"] = timed(
            lambda: run.refresh_gold(spark, root, fx.segment_changes, fx.EPOCH)
        )
        star = run.read_star(spark, root)
        todo = gold_queries(spark, star)
        every = registered.queries()
        todo |= {name: (lambda fn=every[name]: fn(spark, SF_DIR)) for name in RAW}
        for name, make in todo.items():
            timed(lambda: materialise(make()))
            runs = [timed(lambda: materialise(make())) for _ in range(REPEAT)]
            times[name] = sum(runs) / len(runs)
        spark.stop()
    times = {name: round(t, 4) for name, t in times.items()}
    print(json.dumps({
        "metric": "total of mean query times", "value": round(sum(times.values()), 4),
        "unit": "sec", "queries": times, "sf": SF_DIR.rstrip("/").rsplit("/sf", 1)[-1],
        "cpus": CPUS,
    }))


if __name__ == "__main__":
    main()

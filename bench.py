"""Benchmark: the warehouse lifecycle at one scale factor, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Stages (each timed separately):
  build_warehouse   materialise dims, facts and marts from the raw test tables
  dash_*            dashboard reads over the written marts
  dq_suite          every declared data test
  forecast_univariate  backtest, champions and publication with the three univariate models only
  forecast_run      the reference configuration: the same plus the pooled gradient-boosting model
                    (one grouped fit per backtest origin and series)
  log_sql_audit     policy audit of the derived statement log
"""

from __future__ import annotations

import dataclasses
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from shipwright.session import build_session
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))

    from shipwright import registry as R
    from shipwright.plans import dashboard as D
    from shipwright.plans import forecasting as FP
    from shipwright.plans import quality_suite as Q
    from shipwright.plans.build import build_warehouse
    from shipwright.operators import querylog as QL
    from shipwright.sources import testbed_logs as LOGS

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    root = spark.conf.get("spark.checkpoint.dir")
    root = os.path.join(root, "bench") if root else tempfile.mkdtemp(prefix="shipwright-bench-")
    wh = R.warehouse(spark, sf_dir)
    timed("build_warehouse", lambda: build_warehouse(wh, f"{root}/wh-{time.time_ns()}"))
    start, end = R.DASH_RANGE
    timed("dash_headline", lambda: D.headline(wh, start, end).collect())
    timed("dash_weekly_service", lambda: D.weekly_service(wh, start, end).collect())
    timed("dash_monthly_unit_economics", lambda: D.monthly_unit_economics(wh, start, end).collect())
    timed("dash_state_scorecard", lambda: D.state_scorecard(wh, start, end).collect())
    timed("dq_suite", lambda: Q.failures_by_test(wh).collect())

    def forecast(cfg):
        out = FP.run_forecasts(wh, cfg, *R.TESTBED_RUN)
        return {k: v.collect() for k, v in out.items()}
    timed("forecast_univariate", lambda: forecast(dataclasses.replace(R.CFG, pooled_model=False)))
    timed("forecast_run", lambda: forecast(R.CFG))
    timed("log_sql_audit", lambda: QL.audit(LOGS.statements(spark, sf_dir), LOGS.allowed_tables(spark)).collect())

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "lifecycle_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

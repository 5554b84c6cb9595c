"""Benchmark of the headline flows.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line: total seconds and seconds per query. Every query
is forced to completion with the ``noop`` sink (full computation, nothing
collected to the driver); multi-report flows run all their reports.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from provisio.session import build_session  # noqa: E402


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8),
                          extra={"spark.driver.memory": "16g"})
    from provisio.operators import clean, evaluate, explain, market as market_ops
    from provisio.plans import book_a, book_b, market, models, sme
    from provisio.queries import queries
    from provisio.session import clear_scratch
    from provisio.sources import fixtures
    from provisio.streaming import ticks

    qs = queries()

    def run_a():
        for df in book_a.run(spark, sf_dir).values():
            _force(df)

    def run_b():
        for df in book_b.run(spark, sf_dir).values():
            _force(df)

    def stress_grid():
        _force(sme.stressed(spark, sf_dir))

    def shapley():
        _force(explain.shapley_against_sample(sme.features(spark, sf_dir), 100))

    def factor_memo():
        _force(qs["r7_factor_table"](spark, sf_dir))

    def auc_split():
        _force(evaluate.auc(models.evaluation_b(spark, sf_dir), "s", "y"))

    def bars_fallback():
        _force(market.prices(spark, sf_dir))

    def clean_b_impute():
        _force(book_b.cleaned(spark, sf_dir, "impute_then_filter"))

    def loader_a():
        _force(clean.loader_a(book_b.landing(spark, sf_dir)))

    def price_index():
        _force(market_ops.cumulative_index(fixtures.fallback_returns(spark, sf_dir), key="company_id", order="step"))

    def trained_a():
        for df in models.run_a(spark, sf_dir).values():
            _force(df)

    def trained_b():
        for df in models.run_b(spark, sf_dir).values():
            _force(df)

    def tree_attributions():
        """The registered queries' job: 100 trees, the whole population as background."""
        _force(models.attributed_by_population(spark, sf_dir))

    def calibration():
        """Frozen: plain Spark, no library code, so a machine can be told from a change."""
        _force(spark.range(40_000_000).selectExpr("id % 1000003 AS k", "hash(id) AS v").groupBy("k").sum("v"))

    def bars_stream():
        _force(ticks.ohlc_bars_stream(spark, sf_dir))

    bench = {
        "flow_a_end_to_end": run_a,
        "flow_b_end_to_end": run_b,
        "stress_grid_315": stress_grid,
        "exact_shapley": shapley,
        "factor_table": factor_memo,
        "auc_stratified_split": auc_split,
        "prices_live_else_fallback": bars_fallback,
        "clean_b_grade_mean_fill": clean_b_impute,
        "loader_a_medians": loader_a,
        "price_index_running_total": price_index,
        "flow_a_trained": trained_a,
        "flow_b_trained": trained_b,
        "tree_attributions_population": tree_attributions,
        "ohlc_stream": bars_stream,
        "calibration": calibration,
    }
    _force(book_a.raw(spark, sf_dir))     # warm-up: JVM, code generation, file listing
    times = {}
    for name, fn in bench.items():
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)
        clear_scratch(spark)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_flows_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--all] [--no-zone] [name ...]

Runs each query to completion with the ``noop`` sink (the full plan executes,
nothing is collected to the driver) and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ..., "zone": {...}}.
``zone`` times the production shape separately: the filtered zone written once,
then the analyses over it.
Each query is timed as the best of two runs after a warm-up run, which warms
the JVM and the file listing caches, as a long-lived cluster session would be.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.plans.queries import QUERIES  # noqa: E402
from marquee.session import local_session  # noqa: E402

HEADLINE = [
    "ingest_roundtrip",
    "quality_report",
    "cleaned_catalogue",
    "typed_projection",
    "null_profile",
    "distinct_profile",
    "outlier_counts",
    "outlier_by_key",
    "genre_grouping_sets",
    "genre_view",
    "genre_top5",
    "company_cumulative_view",
    "company_growth",
    "companies_per_year",
    "title_growth",
    "cumulative_revenue",
    "release_view",
    "strip_text",
    "longest_values",
    "incremental_new_rows",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def zone_bench(spark, sf_dir: str) -> dict:
    """The intended production shape: write the filtered zone once, then run the analyses over it.

    Reported separately from the headline value (which re-derives everything
    from the raw tables in every query).
    """
    from marquee.plans import analyses
    from marquee.plans import catalogue as cat
    from marquee.plans.ingest import read_clean_zone
    from marquee.session import scratch_path
    from marquee.sources import tpch_catalogue as tc
    from marquee.sources.sinks import write_partitioned

    out: dict = {}
    path = scratch_path(spark, "bench-zone")
    t0 = time.perf_counter()
    write_partitioned(cat.cleaned(spark, sf_dir), path, "month", mode="overwrite")
    out["build_filtered_zone"] = round(time.perf_counter() - t0, 3)
    zone = read_clean_zone(spark, path)
    jobs = {
        "genre_metrics_all_grains": lambda: analyses.genre_metrics_all_grains(zone, tc.ORDER_GENRE_ALLOW),
        "company_debut_growth": lambda: analyses.company_debut_growth(zone, tc.ORDER_COMPANY_DENY),
        "companies_per_year": lambda: analyses.companies_per_year(zone),
        "cumulative_revenue": lambda: analyses.cumulative_money(zone, "revenue"),
        "releases_per_year": lambda: analyses.releases_per_year(zone),
        "title_growth": lambda: analyses.entity_debut_growth(zone, "title"),
    }
    for name, build in jobs.items():
        build().write.format("noop").mode("overwrite").save()
        best = 1e9
        for _ in range(2):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        out[name] = round(best, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    args = sys.argv[1:]
    names = sorted(QUERIES) if "--all" in args else [a for a in args if not a.startswith("--")] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="marquee-bench")
    times, errors = {}, {}
    for n in names:
        try:
            run(spark, n, sf_dir)  # warm-up
            times[n] = round(min(run(spark, n, sf_dir) for _ in range(2)), 3)
        except Exception as e:  # noqa: BLE001 - record and keep going: one failure must not hide the rest
            times[n] = None
            errors[n] = f"{type(e).__name__}: {str(e)[:300]}"
    try:
        zone = zone_bench(spark, sf_dir) if "--no-zone" not in args else {}
    except Exception as e:  # noqa: BLE001
        zone = {"error": f"{type(e).__name__}: {str(e)[:300]}"}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "zone": zone,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

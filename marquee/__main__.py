"""Batch jobs over the catalogue zones.

    python -m marquee ingest    --source CSV_DIR --raw RAW_DIR
    python -m marquee stream    --source CSV_DIR --raw RAW_DIR --checkpoint CKPT_DIR
    python -m marquee transform --raw RAW_DIR --filtered FILTERED_DIR
    python -m marquee report    --filtered FILTERED_DIR --out OUT_DIR

On a cluster, submit with ``spark-submit -m marquee ...`` semantics (or call the
functions directly); the session is taken from the environment, never built
with a local master here unless ``--local`` is given.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from marquee import schema as S
from marquee.operators import profile
from marquee.operators.cleaning import clean, outlier_counts
from marquee.plans import analyses, jobs
from marquee.plans.ingest import read_clean_zone
from marquee.session import ADAPTIVE_CONF, local_session
from marquee.sources.files import require_path
from marquee.streaming.csv_stream import ingest_csv_stream


def _session(local: bool) -> SparkSession:
    if local:
        return local_session()
    b = SparkSession.builder.appName("marquee")
    for k, v in ADAPTIVE_CONF.items():
        b = b.config(k, v)
    return b.getOrCreate()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="marquee")
    ap.add_argument("--local", action="store_true", help="run on a local session")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("ingest", help="append unseen titles from the source CSV to the raw zone")
    p.add_argument("--source", required=True)
    p.add_argument("--raw", required=True)
    p.add_argument("--rejects", default=None, help="folder for rows without a usable id and lines that do not fit the header")
    p.add_argument("--single-line", action="store_true", help="no field holds a line break: large files are split over tasks")
    p.add_argument("--state", default=None, help="folder of the load log; needs --load-id")
    p.add_argument("--load-id", default=None, help="name of this load: repeated under it, it is recognised and not counted twice")
    p = sub.add_parser("stream", help="same as ingest, as an availableNow stream over arriving CSV files")
    p.add_argument("--rejects", default=None)
    p.add_argument("--single-line", action="store_true")
    p.add_argument("--state", default=None, help="folder of the load log (default: beside the checkpoint)")
    p.add_argument("--glob", default=None, help="only file names of this pattern")
    p.add_argument("--source", required=True)
    p.add_argument("--raw", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--max-files-per-trigger", type=int, default=None,
                   help="bound each micro-batch (a first backfill of many files then runs as several batches)")
    p = sub.add_parser("transform", help="clean the raw zone into the filtered zone")
    p.add_argument("--raw", required=True)
    p.add_argument("--filtered", required=True)
    p.add_argument("--outlier-mode", default="row", choices=["row", "key"])
    p.add_argument("--loads", nargs="*", help="only the months that these logged loads touched")
    p = sub.add_parser("report", help="write the analyses of the filtered zone as parquet tables")
    p.add_argument("--filtered", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--months", nargs="*", help="only these two-digit month partitions")
    p.add_argument("--raw", default=None, help="raw zone: adds the outlier counts and the quality of every column by stage")
    a = ap.parse_args(argv)

    spark = _session(a.local)
    if a.cmd == "ingest":
        print(json.dumps(jobs.process_raw_data(
            spark, a.source, a.raw, rejects_path=a.rejects, multi_line=not a.single_line, state_path=a.state, load_id=a.load_id)))
    elif a.cmd == "stream":
        print(json.dumps(ingest_csv_stream(
            spark, a.source, a.raw, a.checkpoint, a.state or f"{a.checkpoint.rstrip('/')}-loads", rejects_path=a.rejects,
            multi_line=not a.single_line, glob=a.glob, max_files_per_trigger=a.max_files_per_trigger)))
    elif a.cmd == "transform":
        jobs.transform_data(spark, a.raw, a.filtered, outlier_mode=a.outlier_mode, load_ids=a.loads)
    elif a.cmd == "report":
        cleaned = read_clean_zone(spark, a.filtered, months=a.months or None)
        outputs = {
            "genre_metrics": analyses.genre_metrics_all_grains(cleaned),
            "company_growth": analyses.company_debut_growth(cleaned),
            "companies_per_year": analyses.companies_per_year(cleaned),
            "cumulative_budget": analyses.cumulative_money(cleaned, "budget"),
            "cumulative_revenue": analyses.cumulative_money(cleaned, "revenue"),
            "releases_per_year": analyses.releases_per_year(cleaned),
            **analyses.listings(cleaned),
            "quality": profile.column_report(cleaned, ["status", "genres", "production_companies"]),
        }
        if a.raw:
            require_path(spark, a.raw)
            raw = spark.read.schema(S.raw_typed_schema()).parquet(a.raw)
            outputs["outlier_counts"] = outlier_counts(clean(raw, outlier_mode="none"))
            outputs["quality_by_stage"] = analyses.quality_report(raw)
        for name, df in outputs.items():
            df.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{name}")


if __name__ == "__main__":
    main()

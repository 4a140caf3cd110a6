"""Run a layer job: ``python -m reelstack <job> --root <lake> --day YYYY-MM-DD ...``.

Jobs: land, raw-ingest, trusted-catalog, trusted-api, star, report. The
session is the one the cluster provides (``getOrCreate``); with no cluster it
is a local one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .layout import Layout
from .params import SUBSET_IDS, ApiParams
from .plans import jobs
from .plans.star import GENERAL, GENERAL_TABELA_KEYS
from .schemas import DETAILS_RAW
from .session import RECOMMENDED_CONF
from .sources.readers import scan_ndjson
from .sources.sinks import NDJSON_RECORDS, star_paths


def parse(argv) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="python -m reelstack")
    ap.add_argument("job", choices=["land", "raw-ingest", "trusted-catalog", "trusted-api",
                                    "star", "report"])
    ap.add_argument("--root", required=True, help="lake root (shared storage)")
    ap.add_argument("--day", required=True, help="extraction day, YYYY-MM-DD")
    ap.add_argument("--movies", help="land: movies extract (a path the executors can read)")
    ap.add_argument("--series", help="land: series extract (a path the executors can read)")
    ap.add_argument("--details", help="raw-ingest: NDJSON detail records, one per movie id")
    ap.add_argument("--exact-files", action="store_true",
                    help="raw-ingest: files hold rows 1-100, 101-200, ... in id order")
    ap.add_argument("--records-per-file", type=int, default=NDJSON_RECORDS,
                    help="raw-ingest: rows per NDJSON file")
    ap.add_argument("--single-file", action="store_true",
                    help="trusted-catalog: write one Parquet file (one task)")
    ap.add_argument("--buckets", type=int,
                    help="trusted-*, star: trusted tables bucketed by title id, joined without a shuffle")
    ap.add_argument("--stable-keys", action="store_true",
                    help="star: keys from append-only registries, the same in every extraction")
    ap.add_argument("--star", choices=["geral", "sagas"], default="geral")
    ap.add_argument("--tabela-keys", action="store_true",
                    help="star geral: name keys id_tabela_* and leave id_genero out")
    return ap.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace):
    layout, day = Layout(args.root), args.day
    if args.job == "land":
        sources = {k: v for k, v in (("Movies", args.movies), ("Series", args.series)) if v}
        return jobs.land_extracts_job(spark, sources, layout, day)
    if args.job == "raw-ingest":
        details = scan_ndjson(spark, args.details, DETAILS_RAW)
        return jobs.raw_ingest_job(spark, layout.raw_pages(day), details, layout.raw_api(day),
                                   args.records_per_file, exact_files=args.exact_files)
    if args.job == "trusted-catalog":
        return jobs.trusted_catalog_job(spark, layout, day, single_file=args.single_file,
                                        buckets=args.buckets)
    if args.job == "trusted-api":
        # The extraction date stamped on the rows is the day, as yyyy/MM/dd.
        return jobs.trusted_api_job(spark, layout.raw_api(day), layout, day,
                                    ApiParams(extraction_date=day.replace("-", "/")), buckets=args.buckets)
    if args.job == "star" and args.star == "geral":
        return jobs.star_job(spark, layout, day, "geral",
                             spec=GENERAL_TABELA_KEYS if args.tabela_keys else GENERAL,
                             stable_keys=args.stable_keys, buckets=args.buckets)
    if args.job == "star":
        return jobs.star_job(spark, layout, day, "sagas", ids=SUBSET_IDS,
                             stable_keys=args.stable_keys, buckets=args.buckets)
    # report: counts and column profiles of the published star's tables
    counts, profiles = jobs.star_report(spark, star_paths(spark, layout.refined(args.star)))
    report: dict = {r.tbl: {"rows": r.n, "columns": {}} for r in counts.collect()}
    for r in profiles.collect():
        report[r.tbl]["columns"][r.col] = {k: r[k] for k in ("cnt", "mean", "stddev", "mn", "mx")}
    return report


def main(argv=None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    builder = SparkSession.builder.appName(f"reelstack-{args.job}")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    print(json.dumps({"job": args.job, "result": run(spark, args)}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())

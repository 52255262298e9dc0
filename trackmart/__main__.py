"""Command line, for spark-submit: ``python -m trackmart <command> ...``

run         the end-to-end job: extract, clean, merge, load
load-raw    one source as it is (overwrite or append)
load-clean  one source cleaned into its typed table
lookup      one batch of the incremental channel lookup, and its results' load
profile     the profile of one table
"""

from __future__ import annotations

import argparse
import json
import sys


def _pairs(items: list[str] | None) -> dict:
    return dict(x.partition("=")[::2] for x in items or [])


def _source(spec: str | None, args):
    """FORMAT:LOCATION; jdbc sources take their url and properties, csv
    sources their reader options from the command line."""
    from trackmart.plans.pipeline import Source
    if not spec:
        return None
    fmt, _, location = spec.partition(":") if ":" in spec.split("/")[0] else ("parquet", "", spec)
    if fmt == "jdbc":
        return Source(location, fmt, _jdbc(args))
    return Source(location, fmt, {"multiline": True} if fmt == "csv" and args.csv_multiline else {})


def _jdbc(args) -> dict:
    if not args.jdbc_url:
        raise SystemExit("a jdbc source or target needs --jdbc-url")
    return {"url": args.jdbc_url, **_pairs(args.jdbc_property)}


def _target(args) -> dict:
    """Arguments of the typed write."""
    return {"jdbc": _jdbc(args)} if args.output_format == "jdbc" else {"fmt": args.output_format}


def main(argv: list[str] | None = None) -> int:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--jdbc-url", help="database of jdbc: sources and of --output-format jdbc")
    common.add_argument("--jdbc-property", action="append", metavar="KEY=VALUE", help="e.g. user=..., password=..., driver=...")
    common.add_argument("--csv-multiline", action="store_true", help="quoted csv values may span lines (a file is then one task)")
    common.add_argument("--output-format", default="parquet", choices=["parquet", "table", "jdbc"])
    ap = argparse.ArgumentParser(prog="trackmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", parents=[common], help="extract, clean, merge and load the enriched track table")
    r.add_argument("--tracks", required=True, help="FORMAT:LOCATION, e.g. csv:/data/tracks.csv")
    r.add_argument("--awards", help="FORMAT:LOCATION (parquet, table, csv, jdbc)")
    r.add_argument("--channels", help="FORMAT:LOCATION")
    r.add_argument("--output", required=True)
    r.add_argument("--strict", action="store_true", help="fail when the stored row count differs")
    w = sub.add_parser("load-raw", parents=[common], help="load one source unchanged")
    w.add_argument("source", help="FORMAT:LOCATION")
    w.add_argument("--output", required=True)
    w.add_argument("--append", action="store_true")
    c = sub.add_parser("load-clean", parents=[common], help="clean one source and load it typed")
    c.add_argument("kind", choices=["tracks", "awards", "channels"])
    c.add_argument("source", help="FORMAT:LOCATION")
    c.add_argument("--output", required=True)
    k = sub.add_parser("lookup", parents=[common], help="one incremental lookup batch over landed answers")
    k.add_argument("--batch", type=int, required=True)
    k.add_argument("--log", required=True, help="folder of the checkpoint log")
    for name in ("universe", "search", "stats", "videos", "video-stats"):
        k.add_argument(f"--{name}", required=True, help="Parquet folder")
    k.add_argument("--status", help="Parquet folder of call outcomes")
    k.add_argument("--output", help="load the current results there")
    p = sub.add_parser("profile", parents=[common], help="print the profile of one table")
    p.add_argument("table", help="FORMAT:LOCATION")
    p.add_argument("--approx", action="store_true")
    args = ap.parse_args(argv)

    from trackmart.plans import pipeline
    from trackmart.session import build_session
    spark = build_session()

    def told(check) -> int:
        row = check.first()
        print(json.dumps(row.asDict()))
        return 0 if row["ok"] else 1

    if args.cmd == "run":
        target = _target(args)
        cfg = pipeline.RunConfig(tracks=_source(args.tracks, args), awards=_source(args.awards, args),
                                 channels=_source(args.channels, args), output=args.output, strict_count=args.strict,
                                 output_format=target.get("fmt", "parquet"), output_jdbc=target.get("jdbc"))
        return told(pipeline.run(spark, cfg))
    if args.cmd == "load-raw":
        return told(pipeline.load_raw(spark, _source(args.source, args), args.output,
                                      mode="append" if args.append else "overwrite", **_target(args)))
    if args.cmd == "load-clean":
        return told(pipeline.clean_and_load(spark, args.kind, _source(args.source, args), args.output, **_target(args)))
    if args.cmd == "lookup":
        from trackmart.schemas import LOOKUP_STATUS
        from trackmart.streaming.incremental import LandedPaths, checkpoint_log, run_batch
        log = checkpoint_log(spark, args.log)
        universe, landed = LandedPaths(args.search, args.stats, args.videos, args.video_stats, args.universe).read(spark)
        status = spark.read.schema(LOOKUP_STATUS).parquet(args.status) if args.status else None
        results = run_batch(universe, log, landed, args.batch, status)
        if args.output:
            return told(pipeline.load_lookup_results(log, args.output, **_target(args)))
        print(json.dumps({"batch": args.batch, "artists": results.count()}))
        return 0
    from trackmart.operators.profile import eda_report
    for name, df in eda_report(_source(args.table, args).read(spark), approx=args.approx).items():
        print(f"== {name}")
        df.show(60, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

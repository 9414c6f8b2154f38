"""Job entry points for spark-submit (the session comes from the submit configuration).

  python -m transferlake.cli load-landing --landing PATH --table PATH --dlq PATH --load-id N [--replace] [--only-new]
  python -m transferlake.cli stream-stats --events PATH --table PATH --out PATH --checkpoint PATH
      [--serving PATH] [--serving-format jdbc --serving-option url=... ...] [--source kafka --source-option subscribe=... ...]
  python -m transferlake.cli alerts --events PATH --out PATH --checkpoint PATH [--threshold N] [--source kafka ...]
  python -m transferlake.cli publish --landing PATH --out PATH [--cap N] [--format kafka --option topic=... ...]
  python -m transferlake.cli history --table PATH [-n 5]
  python -m transferlake.cli rollback --table PATH --to N
  python -m transferlake.cli compact --table PATH [--loads N ...]
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from transferlake.schemas import LARGE_TRANSFER_THRESHOLD


def _source(p: argparse.ArgumentParser) -> None:
    p.add_argument("--events", help="folder of JSON event files (file source)")
    p.add_argument("--source", default="files", choices=["files", "kafka"])
    p.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE",
                   help="e.g. kafka.bootstrap.servers=..., subscribe=...")
    p.add_argument("--max-per-trigger", type=int, help="files or offsets of a micro-batch")


def _options(pairs: list[str]) -> dict:
    return dict(p.split("=", 1) for p in pairs)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="transferlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("load-landing")
    a.add_argument("--landing", required=True)
    a.add_argument("--table", required=True)
    a.add_argument("--dlq", required=True)
    a.add_argument("--load-id", type=int, required=True)
    a.add_argument("--replace", action="store_true")
    a.add_argument("--only-new", action="store_true", help="skip landing files that an earlier load has read")
    s = sub.add_parser("stream-stats")
    _source(s)
    s.add_argument("--table", required=True, help="good-transfer lake table for the dimension")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--serving")
    s.add_argument("--serving-format", default="parquet")
    s.add_argument("--serving-option", action="append", default=[], metavar="KEY=VALUE")
    s.add_argument("--state-partitions", type=int)
    s.add_argument("--salt-buckets", type=int, help="spread frequent receivers over so many join tasks")
    s.add_argument("--audit", help="folder for the accounts of each batch (late events, events without a time)")
    pb = sub.add_parser("publish")
    pb.add_argument("--landing", required=True)
    pb.add_argument("--out", help="folder for JSON event files")
    pb.add_argument("--format", default="text", choices=["text", "kafka"])
    pb.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="sink option, e.g. topic=...")
    pb.add_argument("--cap", type=int)
    al = sub.add_parser("alerts")
    _source(al)
    al.add_argument("--out", required=True)
    al.add_argument("--checkpoint", required=True)
    al.add_argument("--threshold", type=float, default=LARGE_TRANSFER_THRESHOLD)
    h = sub.add_parser("history")
    h.add_argument("--table", required=True)
    h.add_argument("-n", type=int, default=5)
    r = sub.add_parser("rollback")
    r.add_argument("--table", required=True)
    r.add_argument("--to", type=int, required=True)
    c = sub.add_parser("compact")
    c.add_argument("--table", required=True)
    c.add_argument("--loads", type=int, nargs="*")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from transferlake.plans import jobs
    from transferlake.sources import tables as tb
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"transferlake-{args.cmd}").getOrCreate()
    if args.cmd == "load-landing":
        out = jobs.load_landing(spark, args.landing, args.table, args.dlq, args.load_id,
                                "replace" if args.replace else "append", args.only_new)
    elif args.cmd == "stream-stats":
        q = jobs.stream_stats_job(spark, dim_source=tb.read_table(spark, args.table),
                                  snapshot_path=f"{args.out.rstrip('/')}/_dimension",
                                  lake_path=f"{args.out.rstrip('/')}/stats", serving_path=args.serving,
                                  serving_format=args.serving_format, serving_options=_options(args.serving_option),
                                  checkpoint=args.checkpoint, source=args.source, source_path=args.events,
                                  source_options=_options(args.source_option),
                                  max_per_trigger=args.max_per_trigger, state_partitions=args.state_partitions,
                                  salt_buckets=args.salt_buckets, audit_path=args.audit)
        out = {"batches": len(q.recentProgress)}
    elif args.cmd == "publish":
        out = {"published": jobs.publish_landing(spark, args.landing, fmt=args.format, out_path=args.out,
                                                 options=_options(args.option), cap=args.cap)}
    elif args.cmd == "alerts":
        q = jobs.alerts_job(spark, out_path=args.out, checkpoint=args.checkpoint, source=args.source,
                            source_path=args.events, source_options=_options(args.source_option),
                            max_per_trigger=args.max_per_trigger, threshold=args.threshold)
        out = {"batches": len(q.recentProgress)}
    elif args.cmd == "history":
        out = {"loads": [r.asDict() for r in tb.load_history(spark, args.table, args.n).collect()]}
    elif args.cmd == "rollback":
        out = {"load_id": tb.rollback(spark, args.table, args.to)}
    else:
        out = {"compacted": True, "partitions": tb.compact_files(spark, args.table, args.loads or None)}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])

"""Command line: python -m detour {ingest,watch,seed,stream,compact,report} ..."""

from __future__ import annotations

import argparse
import json


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="detour")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest", help="line-status JSON documents -> broker records")
    a.add_argument("docs")
    a.add_argument("out")
    a.add_argument("--format", default="parquet")
    a.add_argument("--multiline", action="store_true", help="one document or array per file, in any layout")
    a.add_argument("--quarantine", default=None, help="folder for documents that don't parse")
    a.add_argument("--kafka-options", default=None, help="JSON object of Kafka sink options")
    s = sub.add_parser("seed", help="documents -> graph tables + options snapshot")
    s.add_argument("stations")
    s.add_argument("nearby", help="nearby-stop documents, or - to pair --stop-points with the stations by radius")
    s.add_argument("members")
    s.add_argument("out")
    s.add_argument("--stop-points", default=None, help="parquet folder of all stop points (id, commonName, lat, lon, stopType, lines)")
    s.add_argument("--multiline", action="store_true", help="one document or array per file, in any layout")
    s.add_argument("--current", default=None)
    s.add_argument("--mode", choices=["upsert", "replace"], default="upsert")
    s.add_argument("--publish", default=None, help="options root that running streams read")
    r = sub.add_parser("stream", help="broker records -> alert history")
    r.add_argument("options")
    r.add_argument("history")
    r.add_argument("checkpoint")
    r.add_argument("--source", default=None, help="parquet/JSON folder of broker records (value, timestamp)")
    r.add_argument("--kafka-options", default=None, help="JSON object of Kafka source options")
    r.add_argument("--run-id", default=None)
    r.add_argument("--quarantine", default=None)
    r.add_argument("--partials", default=None, help="folder for partial results of each batch, for reports")
    r.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    r.add_argument("--trigger", default=None, help="processing-time interval, default 30 seconds")
    p = sub.add_parser("report", help="summarise the alert history")
    p.add_argument("history")
    p.add_argument("--run-id", default=None, help="report one run only (partition pruning)")
    p.add_argument("--partials", default=None, help="folder of partial results: summary and newest alerts without reading alerts")
    w = sub.add_parser("watch", help="line-status JSON documents that arrive -> broker records, as a running job")
    for name in ("docs", "out", "checkpoint", "quarantine"):
        w.add_argument(name)
    w.add_argument("--run-id", required=True, help="the same on every restart from the checkpoint")
    w.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    k = sub.add_parser("compact", help="closed history batches into large files")
    k.add_argument("history")
    k.add_argument("--keep-open", type=int, default=1, help="newest batches of a run that are left alone")
    k.add_argument("--grace", type=int, default=86_400, help="seconds before what was replaced is deleted")
    args = ap.parse_args(argv)

    from detour import jobs
    from detour.session import build_session
    spark = build_session(app=f"detour-{args.cmd}")

    if args.cmd == "ingest":
        opts = json.loads(args.kafka_options) if args.kafka_options else None
        jobs.ingest(spark, args.docs, args.out, args.format, opts, args.multiline, args.quarantine).show(truncate=False)
    elif args.cmd == "seed":
        if args.nearby == "-" and not args.stop_points:
            ap.error("without nearby documents --stop-points is needed")
        points = spark.read.parquet(args.stop_points) if args.nearby == "-" else None
        jobs.seed(spark, args.stations, None if args.nearby == "-" else args.nearby, args.members, args.out, args.current,
                  args.mode, publish_root=args.publish, stop_points=points, multiline=args.multiline).show()
    elif args.cmd == "stream":
        from detour.schemas import BROKER_RECORD
        from detour.sources.broker import read_broker
        if args.kafka_options:
            records = read_broker(spark, json.loads(args.kafka_options))
        else:
            records = spark.readStream.schema(BROKER_RECORD).parquet(args.source)
        trigger = ({"availableNow": True} if args.available_now
                   else {"processingTime": args.trigger} if args.trigger else None)
        for q in jobs.stream(records, args.options, args.history, args.checkpoint, args.run_id, trigger,
                             args.quarantine, partials_path=args.partials):
            q.awaitTermination()
    elif args.cmd == "report":
        for name, df in jobs.report(spark, args.history, args.run_id, args.partials).items():
            print(name)
            df.show(truncate=False)
    elif args.cmd == "watch":
        trigger = {"availableNow": True} if args.available_now else None
        jobs.ingest_stream(spark, args.docs, args.out, args.checkpoint, args.quarantine, args.run_id, trigger).awaitTermination()
    elif args.cmd == "compact":
        print(jobs.compact_history(spark, args.history, args.keep_open, args.grace))


if __name__ == "__main__":
    main()

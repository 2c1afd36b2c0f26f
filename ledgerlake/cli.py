"""Command line: the pipeline's jobs, one per command.

  python -m ledgerlake produce  --events events.json --topic-dir DIR
  python -m ledgerlake ingest   --topic-dir DIR --root OUT [--stream]
  python -m ledgerlake quality  --root OUT --profile local
  python -m ledgerlake gold     --root OUT --profile local
  python -m ledgerlake monitor  --root OUT --metrics-path OUT/metrics
  python -m ledgerlake run      --topic-dir DIR --root OUT

Layers go under ``--root`` (paths) or into ``--schema`` (catalog tables).
Broker sources: ``--bootstrap HOST:PORT --topic NAME``, or an Event Hubs
namespace with ``--eventhubs-namespace NS --topic HUB`` and the connection
string in the environment variable named by ``--secret-env``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):        # run as a file, e.g. spark-submit ledgerlake/cli.py
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.functions.rules import PROFILES  # noqa: E402


def _session(args):
    from ledgerlake.session import build_session
    extra = {}
    if args.shuffle_partitions:
        extra["spark.sql.shuffle.partitions"] = str(args.shuffle_partitions)
    spark = build_session(args.master, app_name=f"ledgerlake-{args.command}", extra=extra)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _store(spark, args):
    from ledgerlake.plans.jobs import LayerStore
    if not (args.root or args.schema):
        raise SystemExit("--root or --schema is required")
    return LayerStore(spark, root=args.root, schema=args.schema, fmt=args.format,
                      layout=args.layout)


def _broker_options(args) -> dict[str, str]:
    from ledgerlake.sources import kafka
    if not (args.topic and (args.bootstrap or args.eventhubs_namespace)):
        raise SystemExit("a source is required: --topic-dir DIR, or --topic with "
                         "--bootstrap or --eventhubs-namespace")
    rates = {"min_partitions": args.min_partitions, "max_offsets_per_trigger": args.max_offsets_per_trigger}
    if args.eventhubs_namespace:
        return kafka.eventhubs_options(args.eventhubs_namespace, args.topic,
                                       kafka.secret_from_env(args.secret_env), **rates)
    return kafka.kafka_options(args.bootstrap, args.topic, **rates)


def _messages(spark, args):
    from ledgerlake.sources import kafka
    if args.topic_dir:
        return kafka.read_message_files(spark, args.topic_dir)
    return kafka.read_kafka(spark, _broker_options(args))


def _next_offset(spark, topic_dir: str) -> int:
    from pyspark.sql import functions as F

    from ledgerlake.sources.kafka import read_message_files
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(topic_dir)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return 0
    last = read_message_files(spark, topic_dir).agg(F.max("offset")).first()[0]
    return 0 if last is None else last + 1


def cmd_produce(spark, args) -> dict:
    from pyspark.sql import functions as F

    from ledgerlake import sinks
    from ledgerlake.operators.bronze import encode_messages
    from ledgerlake.sources.files import read_event_json
    events = read_event_json(spark, args.events, multiline=not args.json_lines)
    if args.topic_dir:
        # a partition by the key, and offsets above those already in the topic
        first = _next_offset(spark, args.topic_dir)
        placed = events.withColumns({
            "_ts": F.current_timestamp(),
            "_partition": F.pmod(F.hash("transaction_id"), F.lit(args.partitions)),
            "_offset": F.lit(first) + F.monotonically_increasing_id()})
        msgs = encode_messages(placed, args.topic or "transactions", partition="_partition",
                               offset="_offset", timestamp="_ts")
        msgs.write.mode("append").parquet(args.topic_dir)
    else:
        sinks.publish(events, _broker_options(args), topic=args.topic)
    return {"produced": True}


def cmd_ingest(spark, args) -> dict:
    from ledgerlake.plans.jobs import ingest
    from ledgerlake.streaming.ingest import (
        bronze_stream_from_files,
        bronze_stream_from_kafka,
        progress_report,
        run_with_totals,
        start_stream,
    )
    store = _store(spark, args)
    profile = PROFILES[args.profile]
    if not args.stream:
        return ingest(_messages(spark, args), store, profile)
    if not args.checkpoint:
        raise SystemExit("--stream needs --checkpoint")
    stream = (bronze_stream_from_files(spark, args.topic_dir, profile.lineage_prefix,
                                       max_bytes_per_trigger=args.max_bytes_per_trigger)
              if args.topic_dir else
              bronze_stream_from_kafka(spark, _broker_options(args), profile.lineage_prefix))
    target = store.location(args.stream_name or "stream_bronze", profile)
    if args.schema:
        from ledgerlake import sinks
        sinks.create_schema(spark, args.schema)
    q, totals = run_with_totals(spark, lambda: start_stream(
        stream, args.checkpoint, fmt=args.format, path=None if args.schema else target,
        table=target if args.schema else None))
    last = [r.asDict() for r in progress_report(spark, q).collect()]   # Spark keeps the last batches only
    return {**totals, "batches": last}


DEDUP = {"earliest": (True, "aggregate"), "window": (True, "window"), "any": (False, "aggregate")}


def cmd_quality(spark, args) -> dict:
    from ledgerlake.plans.jobs import quality
    deterministic, method = DEDUP[args.dedup]
    return quality(_store(spark, args), PROFILES[args.profile], deterministic, method)


def cmd_gold(spark, args) -> dict:
    from ledgerlake.operators.gold import top
    from ledgerlake.plans.jobs import gold
    store = _store(spark, args)
    profile = PROFILES[args.profile]
    out = gold(store, profile, args.money)
    if args.show:
        for name in ("risk_summary", "country", "payment"):
            print(f"{name}:")
            top(store.read(name, profile), 20).show(20, truncate=False)
    return out


def cmd_monitor(spark, args) -> dict:
    from ledgerlake.plans.jobs import monitor_layers
    return monitor_layers(_store(spark, args), args.metrics_path, PROFILES[args.profile])


def cmd_run(spark, args) -> dict:
    from ledgerlake.plans.jobs import run_batch
    deterministic, method = DEDUP[args.dedup]
    return run_batch(spark, _messages(spark, args), _store(spark, args),
                     PROFILES[args.profile], deterministic=deterministic,
                     dedup_method=method, money_mode=args.money,
                     metrics_path=args.metrics_path)


COMMANDS = {"produce": cmd_produce, "ingest": cmd_ingest, "quality": cmd_quality,
            "gold": cmd_gold, "monitor": cmd_monitor, "run": cmd_run}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="ledgerlake", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("command", choices=sorted(COMMANDS))
    ap.add_argument("--master", default=None, help="e.g. local[8]; default: the launcher's")
    ap.add_argument("--profile", default="local", choices=["local", "cloud"])
    ap.add_argument("--root", help="folder of layer paths")
    ap.add_argument("--schema", help="catalog schema of layer tables")
    ap.add_argument("--format", default="parquet", help="parquet, delta, ...")
    ap.add_argument("--layout", choices=["local", "cloud"],
                    help="layer names to use (default: those of --profile)")
    ap.add_argument("--topic-dir", help="Kafka-shaped Parquet folder (offline topic)")
    ap.add_argument("--bootstrap", help="Kafka bootstrap servers")
    ap.add_argument("--topic", help="topic / event hub name")
    ap.add_argument("--eventhubs-namespace")
    ap.add_argument("--secret-env", default="EVENTHUB_CONNECTION_STRING")
    ap.add_argument("--events", help="JSON array file of events (produce)")
    ap.add_argument("--json-lines", action="store_true", help="--events is JSON Lines")
    ap.add_argument("--stream", action="store_true", help="ingest as an availableNow stream")
    ap.add_argument("--checkpoint", help="stream checkpoint location")
    ap.add_argument("--stream-name", help="bronze table / folder name for the stream "
                    "(default: the layout's streaming bronze)")
    ap.add_argument("--metrics-path", help="where monitor writes the metrics JSON")
    ap.add_argument("--partitions", type=int, default=3, help="produce: partitions of the offline topic")
    ap.add_argument("--min-partitions", type=int, help="broker: split topic partitions over this many tasks")
    ap.add_argument("--max-offsets-per-trigger", type=int, help="broker stream: messages of a micro-batch")
    ap.add_argument("--max-bytes-per-trigger", type=int, help="--topic-dir stream: bytes of a micro-batch")
    ap.add_argument("--money", default="decimal", choices=["decimal", "double"])
    ap.add_argument("--dedup", default="earliest", choices=sorted(DEDUP),
                    help="survivor of a duplicated transaction_id: the earliest message "
                         "(aggregate or window plan), or any (dropDuplicates)")
    ap.add_argument("--shuffle-partitions", type=int)
    ap.add_argument("--show", action="store_true", help="gold: print the top 20 rows of "
                    "the risk, country and payment tables")
    return ap


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession
    args = parser().parse_args(argv)
    owned = SparkSession.getActiveSession() is None   # stop only what we start
    spark = _session(args)
    try:
        out = COMMANDS[args.command](spark, args)
        print(json.dumps(out, default=str))
    finally:
        if owned:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Score a message stream continuously.

    spark-submit ... -m valence.jobs.stream_scores --source kafka --sink kafka --sink console
    python -m valence.jobs.stream_scores --source json --path hdfs:///in --sink parquet --out hdfs:///scored

Sinks of one job share one query: a batch is read and scored once.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from ..functions.text import event_time
from ..session import build_session, prepare_streaming, work_dir
from ..sources.messages import INPUT_TOPIC, RESULT_TOPIC, message_stream
from ..streaming import jobs


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", choices=["kafka", "json", "parquet", "text"], default="kafka")
    parser.add_argument("--path", help="folder of a file source")
    parser.add_argument("--servers", help="Kafka servers; default: environment")
    parser.add_argument("--input-topic", default=INPUT_TOPIC)
    parser.add_argument("--result-topic", default=RESULT_TOPIC)
    parser.add_argument("--sink", action="append", choices=["console", "kafka", "parquet"])
    parser.add_argument("--out", help="folder of the Parquet sink")
    parser.add_argument("--checkpoint", help="folder that all executors share; a run goes on where the last one with it ended")
    parser.add_argument("--once", action="store_true", help="score what is there and end")
    parser.add_argument("--starting-offsets", help="Kafka: earliest, latest or JSON; for the first run of a checkpoint")
    parser.add_argument("--fail-on-data-loss", action="store_true", help="Kafka: stop where records are gone")
    parser.add_argument("--max-offsets-per-trigger", help="Kafka: most records of a batch")
    parser.add_argument("--min-partitions", help="Kafka: least number of tasks that read")
    parser.add_argument("--max-files-per-trigger", help="file sources: most files of a batch")
    parser.add_argument("--rounding", choices=["exact", "binary"], default="exact")
    args = parser.parse_args(argv)
    args.sink = args.sink or ["console"]
    if args.source != "kafka" and not args.path:
        parser.error("a file source needs --path")
    if "parquet" in args.sink and not args.out:
        parser.error("the Parquet sink needs --out")
    if not args.checkpoint and not (args.once and args.sink == ["console"]):
        parser.error("all but a single run to the console need --checkpoint")
    return args


def source_options(args: argparse.Namespace) -> dict[str, str]:
    """Options of the source that were given; the others keep their defaults."""
    if args.source != "kafka":
        return {"maxFilesPerTrigger": args.max_files_per_trigger} if args.max_files_per_trigger else {}
    given = {
        "startingOffsets": args.starting_offsets,
        "failOnDataLoss": "true" if args.fail_on_data_loss else None,
        "maxOffsetsPerTrigger": args.max_offsets_per_trigger,
        "minPartitions": args.min_partitions,
    }
    return {name: value for name, value in given.items() if value}


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = prepare_streaming(build_session("score messages", kafka="kafka" in [args.source, *args.sink]))
    if args.source == "kafka":
        messages = message_stream(spark, "kafka", topic=args.input_topic, servers=args.servers, **source_options(args))
    else:
        messages = message_stream(spark, args.source, args.path, **source_options(args))
    checkpoint = args.checkpoint or work_dir(spark, "console-checkpoint")
    sinks = {
        "console": lambda: jobs.console_sink(),
        "kafka": lambda: jobs.kafka_sink(args.result_topic, args.servers),
        # Runs with another checkpoint count their batches from zero: they write beside, not over, each other.
        "parquet": lambda: jobs.batch_folder(jobs.run_folder(args.out, checkpoint)),
    }
    # The time as a column of its own lets later time filters skip files and row groups.
    timed = messages.withColumn("event_ts", F.expr(event_time("timestamp")))
    query = jobs.start_batches(
        jobs.score_stream(timed, keep=("event_ts",), rounding=args.rounding),
        jobs.fan_out(*[sinks[name]() for name in args.sink]),
        checkpoint,
        once=args.once,
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()

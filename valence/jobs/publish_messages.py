"""Build messages from the samples and text files, and publish them.

    spark-submit ... -m valence.jobs.publish_messages --lines hdfs:///lines --sink kafka
    python -m valence.jobs.publish_messages --lines lines.txt --sink json --out /in
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.messages import build_messages, encode, number_rows
from ..session import build_session
from ..sinks.writers import write_kafka
from ..sources.files import read_lines
from ..sources.messages import INPUT_TOPIC
from ..sources.samples import sample_messages


def messages(spark: SparkSession, lines: str | None) -> DataFrame:
    """Sample messages, then those of the text files; all copies are kept, numbered from 1 without a gap."""
    items = sample_messages(spark)
    if lines:
        items = items.unionByName(read_lines(spark, lines))
    return build_messages(number_rows(items).withColumn("ts", F.current_timestamp()), "number", "ts")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--lines")
    parser.add_argument("--sink", choices=["kafka", "json"], default="kafka")
    parser.add_argument("--topic", default=INPUT_TOPIC)
    parser.add_argument("--servers")
    parser.add_argument("--out")
    args = parser.parse_args(argv)
    if args.sink == "json" and not args.out:
        parser.error("the JSON sink needs --out")
    spark = build_session("publish messages", kafka=args.sink == "kafka")
    rows = messages(spark, args.lines)
    if args.sink == "kafka":
        write_kafka(encode(rows), args.topic, args.servers)
    else:
        rows.write.mode("append").json(args.out)


if __name__ == "__main__":
    main()

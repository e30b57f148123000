"""Report on a table of scored rows, such as the Parquet sink of ``stream_scores``.

    spark-submit ... -m valence.jobs.report --scored hdfs:///scored
"""

from __future__ import annotations

import argparse

from ..operators import keywords, latest, metrics, throughput
from ..session import build_session
from ..sinks.writers import preview


def main(argv: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--scored", required=True)
    parser.add_argument("--rows", type=int, default=latest.FEED_SIZE)
    args = parser.parse_args(argv)
    spark = build_session("report")
    scored = spark.read.parquet(args.scored)
    rate = throughput.throughput_asof(scored, "event_ts").select("throughput_eps").scalar()
    snapshot = metrics.snapshot(scored, rate).select("metrics").first().metrics
    print(snapshot)
    preview(metrics.kpi_display(metrics.kpi(scored)))
    preview(keywords.top_keywords(keywords.keyword_counts(scored)))
    preview(latest.feed_view(latest.latest(scored, args.rows, "event_ts", "id", arrival="processed_at")), args.rows)
    return snapshot


if __name__ == "__main__":
    main()

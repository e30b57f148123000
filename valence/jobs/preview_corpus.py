"""Count the rows of a CSV corpus and print some of them.

    spark-submit ... -m valence.jobs.preview_corpus --corpus hdfs:///corpus.csv --rows 10
"""

from __future__ import annotations

import argparse

from ..session import build_session
from ..sinks.writers import preview
from ..sources.files import read_corpus


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--corpus", required=True)
    parser.add_argument("--rows", type=int, default=10)
    args = parser.parse_args(argv)
    corpus = read_corpus(build_session("preview corpus"), args.corpus)
    total = corpus.count()
    print(f"rows: {total}")
    preview(corpus, args.rows)
    return total


if __name__ == "__main__":
    main()

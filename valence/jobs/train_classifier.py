"""Train the text classifier on a header-less CSV corpus, save it, and print its accuracy.

    spark-submit ... -m valence.jobs.train_classifier --corpus hdfs:///corpus.csv --model hdfs:///models/sentiment
"""

from __future__ import annotations

import argparse

from ..operators import classifier, sampling
from ..session import build_session
from ..sinks.writers import preview, stage
from ..sources.files import read_corpus


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--corpus", required=True)
    parser.add_argument("--model", required=True)
    parser.add_argument("--work", required=True, help="folder that all executors share, for rows between the steps")
    parser.add_argument("--rows", type=int, default=100_000, help="most rows to fit on; 0 for all. All test rows are evaluated")
    parser.add_argument("--train-percent", type=int, default=80)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> float:
    args = arguments(argv)
    spark = build_session("train classifier")
    # The CSV is parsed once; the later passes read what they need of it.
    rows = stage(classifier.binarize(read_corpus(spark, args.corpus)).select("id", "text", "label"), "corpus", args.work)
    train, test = sampling.train_test_split(rows, "id", args.train_percent)
    model = classifier.fit(sampling.exact_sample(train, "id", args.rows, args.work) if args.rows else train)
    classifier.save(model, args.model)
    predicted = classifier.classify(model, test)
    preview(predicted)
    result = classifier.accuracy_row(predicted).first()
    print(f"test rows: {result.total}  accuracy: {result.accuracy_pct} %")
    return result.accuracy


if __name__ == "__main__":
    main()

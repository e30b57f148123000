"""Samples, splits, term statistics and the text classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.sentiment import with_sentiment
from ..functions.stop_words import ENGLISH
from ..operators import classifier, sampling, terms
from ..session import work_dir
from ..sinks.writers import stage
from ..sources.tables import table
from . import sql
from .registry import query

SAMPLE_FRACTION, SAMPLE_ROWS = 0.25, 2500


@query(f"SELECT event_id, event_type, value FROM events WHERE {sql.bucket('event_id')} < {int(SAMPLE_FRACTION * 2**32)}")
def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of the events, chosen by key."""
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return sampling.hash_sample(events, "event_id", SAMPLE_FRACTION)


@query(
    "SELECT event_id, event_type, value FROM events "
    f"ORDER BY md5(CAST(event_id AS VARCHAR)), event_id LIMIT {SAMPLE_ROWS}"
)
def hash_sample_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Exactly the wanted number of events, first by hash."""
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return sampling.exact_sample(events, "event_id", SAMPLE_ROWS)


def _walk_sql() -> str:
    """The permutation by half rounds as nested selects, and rows that fall beyond the count again."""
    mod, (m1, m2), n = sampling._MODULUS, sampling._MIX, "(SELECT n FROM size)"
    shift = lambda v, bits: f"xor({v}, ({v}) >> {bits})"

    def mixed(v: str, key: int) -> str:
        return shift(f"({shift(f'(({v} + {key}) % {mod} * {m1} % {mod})', 15)} * {m2} % {mod})", 13)

    def once(source: str) -> str:
        out = f"SELECT id, place // b AS l, place % b AS r, a, b FROM {source}"
        for i, key in enumerate(sampling.round_keys(42)):
            side = f"(l + {mixed('r', key)}) % a AS l, r" if i % 2 == 0 else f"l, (r + {mixed('l', key)}) % b AS r"
            out = f"SELECT id, {side}, a, b FROM ({out})"
        return f"SELECT id, l * b + r AS place, a, b FROM ({out})"

    return f"""WITH RECURSIVE size AS (SELECT count(*) AS n FROM events), sides AS (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM size),
grid AS (SELECT a, CAST(ceil(n / a) AS BIGINT) AS b FROM sides),
start AS (SELECT event_id AS id, row_number() OVER (ORDER BY event_id) - 1 AS place, a, b FROM events, grid),
walk AS ({once("start")} UNION ALL {once(f"(SELECT * FROM walk WHERE place >= {n})")})
SELECT id AS event_id, place FROM walk WHERE place < {n}"""


@query(_walk_sql())
def shuffle_order(spark: SparkSession, folder: str) -> DataFrame:
    """A random order of all events."""
    return sampling.shuffle_order(table(spark, folder, "events").select("event_id"), "event_id")


_SIDE = f"CASE WHEN {sql.bucket('doc_id')} % 100 < 80 THEN 'train' ELSE 'test' END"


@query(f"SELECT doc_id, {_SIDE} AS side FROM documents")
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = sampling.train_test_split(table(spark, folder, "documents").select("doc_id"), "doc_id")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(f"""WITH d AS (SELECT doc_id, quality, {_SIDE} AS side FROM documents LEFT JOIN labels USING (doc_id))
SELECT count(*) AS raw, count(quality) AS labelled, count(quality) FILTER (side = 'train') AS train,
  count(quality) FILTER (side = 'test') AS test FROM d""")
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All counts of the training job in one pass, instead of one pass each."""
    documents = table(spark, folder, "documents").select("doc_id")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    known = F.col("quality").isNotNull()
    in_train = F.expr(f"{sampling.stable_hash('doc_id')} % 100 < 80")
    return documents.join(labels, "doc_id", "left").agg(
        F.count("*").alias("raw"),
        F.count_if(known).alias("labelled"),
        F.count_if(known & in_train).alias("train"),
        F.count_if(known & ~in_train).alias("test"),
    )


_STOP = "[" + ", ".join(map(sql.quote, ENGLISH)) + "]"
# The trailing empty strings of a split do not count as words.
_WORDS = f"""raw AS (SELECT doc_id, string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]') AS s FROM documents),
w AS (SELECT doc_id, CASE WHEN coalesce(len(list_filter(s, lambda x: x <> '')), 0) = 0
    THEN CASE WHEN len(s) = 1 THEN s ELSE [] END
    ELSE list_slice(s, 1, list_max(list_transform(range(1, len(s) + 1), lambda i: CASE WHEN s[i] <> '' THEN i ELSE 0 END)))
  END AS words FROM raw),
f AS (SELECT doc_id, words, list_filter(words, lambda x: NOT list_contains({_STOP}, x)) AS filtered FROM w)"""
_TF = f"""{_WORDS}, t AS (SELECT doc_id, unnest(filtered) AS term FROM f),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
idf AS (SELECT term, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf
        FROM tf GROUP BY term)"""


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


@query(f"WITH {_WORDS} SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, array_to_string(words, ' ') AS words FROM f")
def ml_tokenize(spark: SparkSession, folder: str) -> DataFrame:
    words = classifier.words(_documents(spark, folder))
    return words.select("doc_id", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words"))


@query(f"WITH {_WORDS} SELECT doc_id, CAST(len(filtered) AS INTEGER) AS n_words, array_to_string(filtered, ' ') AS words FROM f")
def ml_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    words = classifier.content_words(_documents(spark, folder))
    return words.select("doc_id", F.size("filtered").alias("n_words"), F.array_join("filtered", " ").alias("words"))


@query(f"WITH {_TF} SELECT doc_id, term, tf FROM tf")
def tf_exact(spark: SparkSession, folder: str) -> DataFrame:
    return terms.term_counts(_documents(spark, folder), "doc_id")


@query(f"WITH {_TF} SELECT term, df, round(idf, 9) AS idf FROM idf")
def idf_exact(spark: SparkSession, folder: str) -> DataFrame:
    return terms.idf(_documents(spark, folder)).withColumn("idf", F.round("idf", 9))


@query(f"WITH {_TF} SELECT doc_id, term, tf, round(idf, 9) AS idf, round(tf * idf, 9) AS tfidf FROM tf JOIN idf USING (term)")
def tfidf_exact(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    counts = stage(terms.term_counts(documents, "doc_id"), "term-counts")
    weighted = terms.tfidf(counts, stage(terms.idf_of_counts(counts, documents), "term-weights"))
    return weighted.select("doc_id", "term", "tf", F.round("idf", 9).alias("idf"), F.round("tfidf", 9).alias("tfidf"))


_RATED = f"""{sql.score('documents', 'doc_id')}, p AS (
  SELECT CASE WHEN sentiment = 'Positive' THEN 1 ELSE 0 END AS prediction, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label
  FROM score JOIN labels ON doc_id = k),
n AS (SELECT count(*) AS total, count(*) FILTER (prediction = label) AS correct FROM p)"""


@query(f"""WITH {_RATED} SELECT total, correct, correct / greatest(total, 1) AS accuracy,
  {sql.half_up('correct * 100', 'greatest(total, 1)', 100)} / 100.0 AS accuracy_pct FROM n""")
def eval_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """How often the word list's class agrees with the label of a document."""
    return classifier.accuracy_row(_rated(spark, folder))


@query(f"""WITH {_RATED} SELECT total, correct, correct / greatest(total, 1) AS accuracy,
  {sql.round_even('CAST(correct AS DOUBLE) / greatest(total, 1) * 100', 2)} AS accuracy_pct FROM n""")
def eval_accuracy_binary(spark: SparkSession, folder: str) -> DataFrame:
    """The same, rounded as plain double arithmetic does."""
    return classifier.accuracy_row(_rated(spark, folder), rounding="binary")


def _targets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").select("doc_id", (F.col("quality") * 4).alias("target"))


def _rated(spark: SparkSession, folder: str) -> DataFrame:
    """Texts are scored where they are read; the join carries a class."""
    scored = with_sentiment(table(spark, folder, "documents").select("doc_id", "text"))
    predicted = scored.select("doc_id", F.when(F.col("analysis.sentiment") == "Positive", 1).otherwise(0).alias("prediction"))
    return classifier.binarize(predicted.join(_targets(spark, folder), "doc_id"))


def labelled_features(spark: SparkSession, folder: str) -> DataFrame:
    """Texts are hashed where they are read; the join carries a sparse vector."""
    features = classifier.hashed(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    return classifier.binarize(features.join(_targets(spark, folder), "doc_id"))


def _fit(spark: SparkSession, folder: str):
    rows = stage(labelled_features(spark, folder).select("doc_id", "label", "rawFeatures"), "features")
    train, test = sampling.train_test_split(rows, "doc_id")
    return classifier.fit_hashed(train), test


@query()
def classify(spark: SparkSession, folder: str) -> DataFrame:
    """Train on one side of the split, save, load, and predict the other side."""
    model, test = _fit(spark, folder)
    path = work_dir(spark, "model")
    classifier.save(model, path)
    return classifier.classify_hashed(classifier.load(path), test, keep=("doc_id", "label"))


@query()
def classify_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of the trained classifier on the test side."""
    model, test = _fit(spark, folder)
    return classifier.accuracy_row(classifier.classify_hashed(model, test, keep=("doc_id", "label")))

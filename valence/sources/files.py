"""Text-line and corpus file sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.arithmetic import literal
from ..functions.sentiment import SPACE, strip
from ..operators.messages import stand_in_user
from ..schemas import CORPUS

# Fixed value: source name of messages read from text files.
LINE_SOURCE = "FileStream"


def clean_lines(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages from text lines (column ``value``): stripped, without blanks and ``#`` comments.

    The user is a stand-in that depends on the line, so runs repeat.
    """
    # The test reads a line up to its first visible character; the line is stripped once, after it.
    kept = lines.where(F.col("value").rlike(f"^[{SPACE}]*[^{SPACE}#]"))
    text = kept.selectExpr(*keep, f"{strip('value')} AS text")
    return text.selectExpr("*", f"{literal(LINE_SOURCE)} AS source", f"{stand_in_user('text')} AS user")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned lines of text files; a missing path gives no rows."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return clean_lines(lines)


def read_corpus(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Header-less CSV corpus. The schema is declared: inference would read all data once more."""
    return spark.read.schema(CORPUS).options(**options).csv(path).toDF(*CORPUS.names)

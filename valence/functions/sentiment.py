"""Sentiment of a text in native Spark expressions.

Scoring is row by row: no shuffle and no Python worker. Tokens are taken once per
text; a set lookup for each tells whether any is listed, and only then their
places are sought and the few hits weighed. Sums are exact integers (millionths), so results do not depend on
order or platform. The arithmetic follows in separate projections, which Spark
compiles, because expressions inside array lambdas are interpreted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import lexicon as lx
from .arithmetic import bind, half_up_ratio, literal, literals, lookup, round_binary

# A token starts and ends with a letter, digit or underscore; apostrophes and
# hyphens may join its parts. Possessive quantifiers keep the match linear.
# ASCII is named first, as it is told apart faster than the classes of all scripts.
TOKEN = r"[a-z0-9_\p{L}\p{N}]++(?:['-]++[a-z0-9_\p{L}\p{N}]++)*+"
# White space as Python strips it, and as browsers trim it.
SPACE = r"\s\p{Z}\x1C-\x1F\x85"
BROWSER_SPACE = r"\s\p{Z}\uFEFF"

SCORE_FIELDS = (
    "sentiment", "emoji", "label", "polarity", "confidence", "positive_score", "negative_score", "keywords",
)


def tokens(text: str) -> str:
    """Lower-case word tokens of a text, in order."""
    return f"regexp_extract_all(lower({text}), {literal(TOKEN)}, 0)"


def strip(text: str, space: str = SPACE) -> str:
    """Remove white space from both ends; a run inside the text is passed once."""
    pattern = f"^[{space}]++|(?<![{space}])[{space}]++$"
    return f"regexp_replace({text}, {literal(pattern)}, '')"


def is_blank(text: str, space: str = SPACE) -> str:
    return f"coalesce({text} RLIKE {literal(f'^[{space}]*+$')}, true)"


def contains_any(text: str, parts: list[str]) -> str:
    """Whether a text holds any of the emoji.

    Most emoji share their first two bytes; a text without these bytes is
    searched once for all of them.
    """
    groups: dict[bytes, list[str]] = {}
    for part in parts:
        groups.setdefault(part.encode()[:2], []).append(part)
    tests = []
    for lead, members in groups.items():
        test = " OR ".join(f"contains({text}, {literal(member)})" for member in members)
        first = f"contains(CAST({text} AS BINARY), X'{lead.hex()}') AND "
        tests.append(f"({first}({test}))" if len(members) > 1 else test)
    return "(" + " OR ".join(tests) + ")"


def face(sentiment: str) -> str:
    cases = " ".join(f"WHEN {sentiment} = {literal(name)} THEN {literal(lx.FACES[name])}" for name in ("Positive", "Negative"))
    return f"(CASE {cases} ELSE {literal(lx.FACES['Neutral'])} END)"


def _hit(words: str, i: str, exact: bool) -> str:
    """Contribution (above zero: to the positive side) and keyword of the listed word at ``i``."""
    word, before, before2 = f"get({words}, {i})", f"get({words}, {i} - 1)", f"get({words}, {i} - 2)"
    negation = lambda token: f"coalesce({token} IN ({literals(lx.NEGATIONS)}), false)"
    modifier = f"CASE WHEN {negation(before)} THEN 100 ELSE coalesce({lookup(lx.MODIFIERS, before)}, 100) END"
    weight = lookup(lx.WORD_WEIGHTS, word)
    if exact:
        value, factor = f"CAST({weight} * {modifier} AS BIGINT)", literal
    else:
        value, factor = f"({weight} / 100.0D) * ({modifier} / 100.0D)", lambda hundredths: literal(hundredths / 100)
    part = (
        f"named_struct('word', {word}, 'value', {value}, 'negated', {negation(before)} OR {negation(before2)})"
    )
    scaled = f"""CASE WHEN NOT part.negated THEN part.value * {factor(lx.PLAIN_FACTOR)}
        WHEN part.value > 0 THEN -part.value * {factor(lx.NEGATED_POSITIVE_FACTOR)}
        ELSE -part.value * {factor(lx.NEGATED_NEGATIVE_FACTOR)} END"""
    keyword = "CASE WHEN part.negated THEN concat('not ', part.word) ELSE part.word END"
    return bind("part", part, f"named_struct('value', {scaled}, 'keyword', {keyword})")


def _word_sums(text: str, exact: bool) -> str:
    """Sums of both sides over the listed words of a text, in token order."""
    zero = "0L" if exact else "0.0D"
    known = literals(lx.WORD_WEIGHTS)
    places = f"filter(sequence(0, size(words) - 1), i -> get(words, i) IN ({known}))"
    # Most texts hold no listed word; one set lookup for each token tells, without a lambda.
    listed = f"CASE WHEN arrays_overlap(words, array({known})) THEN {places} ELSE CAST(array() AS ARRAY<INT>) END"
    sums = f"""named_struct(
        'p', aggregate(hits, {zero}, (total, hit) -> total + greatest(hit.value, {zero})),
        'n', aggregate(hits, {zero}, (total, hit) -> total - least(hit.value, {zero})),
        'keywords', transform(hits, hit -> hit.keyword),
        'wordless', size(words) = 0)"""
    hits = f"transform({listed}, i -> {_hit('words', 'i', exact)})"
    return bind("words", tokens(text), bind("hits", hits, sums))


def _exact_numbers(p: str, n: str) -> dict[str, str]:
    one = 1_000_000
    share = lambda side: half_up_ratio(side, f"{p} + {n} + {one // 10}", 1000)
    return {
        "milli": half_up_ratio(f"{p} - {n}", f"{p} + {n} + {one // 2}", 1000),
        "p_tenths": share(p),
        "n_tenths": share(n),
        "positive_score": half_up_ratio(p, str(one), 100) + " / 100.0D",
        "negative_score": half_up_ratio(n, str(one), 100) + " / 100.0D",
    }


def _binary_numbers(p: str, n: str) -> dict[str, str]:
    whole = lambda value, digits: f"CAST(round({round_binary(value, digits)} * {10**digits}) AS BIGINT)"
    return {
        "milli": whole(f"(({p} - {n}) / ({p} + {n} + 0.5D))", 3),
        "p_tenths": whole(f"({p} / ({p} + {n} + 0.1D) * 100)", 1),
        "n_tenths": whole(f"({n} / ({p} + {n} + 0.1D) * 100)", 1),
        "positive_score": round_binary(p, 2),
        "negative_score": round_binary(n, 2),
    }


def _steps(text: str, c: Callable[[str], str], exact: bool) -> list[dict[str, str]]:
    """New values, step by step; a step refers to a value ``x`` of an earlier step as ``c(x)``."""
    body = f"coalesce({text}, '')"
    bonus, zero = (lx.EMOJI_UNITS, 0) if exact else (lx.EMOJI_UNITS / 1e6, 0.0)
    extra = lambda flag: f"CASE WHEN {c(flag)} THEN {literal(bonus)} ELSE {literal(zero)} END"
    word = lambda flag, keyword: f"CASE WHEN {c(flag)} THEN array('{keyword}') ELSE CAST(array() AS ARRAY<STRING>) END"
    found = {
        "words": _word_sums(body, exact),
        "good": contains_any(body, lx.POSITIVE_EMOJI),
        "bad": contains_any(body, lx.NEGATIVE_EMOJI),
    }
    sums = {
        "p": f"{c('words')}.p + {extra('good')}",
        "n": f"{c('words')}.n + {extra('bad')}",
        "keywords": f"concat({c('words')}.keywords, {word('good', 'positive_emoji')}, {word('bad', 'negative_emoji')})",
        "blank": f"{c('words')}.wordless AND {is_blank(body)}",
    }
    numbers = (_exact_numbers if exact else _binary_numbers)(c("p"), c("n"))
    limit = lx.CLASS_LIMIT_MILLI
    name = f"CASE WHEN {c('milli')} >= {limit} THEN 'Positive' WHEN {c('milli')} <= -{limit} THEN 'Negative' ELSE 'Neutral' END"
    tenths = f"""CASE WHEN {c('blank')} THEN {lx.BLANK_CONFIDENCE}
        WHEN {c('p')} + {c('n')} = 0 THEN {lx.NO_HIT_CONFIDENCE}
        WHEN {c('sentiment')} = 'Positive' THEN least({c('p_tenths')}, {lx.TOP_CONFIDENCE})
        WHEN {c('sentiment')} = 'Negative' THEN least({c('n_tenths')}, {lx.TOP_CONFIDENCE})
        ELSE 1000 - abs({c('milli')}) END"""
    score = f"""named_struct(
        'sentiment', {c('sentiment')},
        'emoji', {face(c('sentiment'))},
        'label', concat_ws(' ', {face(c('sentiment'))}, {c('sentiment')}),
        'polarity', {c('milli')} / 1000.0D,
        'confidence', ({tenths}) / 10.0D,
        'positive_score', {c('positive_score')},
        'negative_score', {c('negative_score')},
        'keywords', sort_array(array_distinct({c('keywords')})))"""
    return [found, sums, numbers, {"sentiment": name}, {"score": score}]


def with_sentiment(df: DataFrame, text: str = "text", into: str = "analysis", rounding: str = "exact") -> DataFrame:
    """Add the score struct (``SCORE_FIELDS``) of a text column; null counts as blank.

    ``rounding="exact"`` sums integers and rounds half away from zero.
    ``rounding="binary"`` sums IEEE doubles in token order and rounds the binary
    value half to even; it differs by one last digit in rare cases.
    """
    if rounding not in ("exact", "binary"):
        raise ValueError(f"rounding must be 'exact' or 'binary', not {rounding!r}")
    tag = f"__{into}_"
    own = [f"`{name}`" for name in df.columns]
    for step in _steps(f"`{text}`", lambda name: f"`{tag}{name}`", rounding == "exact"):
        df = df.selectExpr("*", *[f"{value} AS `{tag}{name}`" for name, value in step.items()])
    return df.selectExpr(*own, f"`{tag}score` AS `{into}`")


def register_sql(spark: SparkSession, name: str = "sentiment", rounding: str = "exact") -> None:
    """Let SQL users call ``sentiment(text)``, one expression in which the steps are nested bindings.

    On large tables ``with_sentiment`` is faster: Spark compiles its steps.
    """
    step_of = {"words": 0, "good": 0, "bad": 0, "p": 1, "n": 1, "keywords": 1, "blank": 1, "sentiment": 3}
    *steps, last = _steps("text", lambda value: f"s{step_of.get(value, 2)}.{value}", rounding == "exact")
    body = last["score"]
    for depth, step in reversed(list(enumerate(steps))):
        values = ", ".join(f"{literal(key)}, {value}" for key, value in step.items())
        body = bind(f"s{depth}", f"named_struct({values})", body)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURN {body}")

"""Scoring rules: the golden table, edge cases, and random texts against a second implementation."""

import os
import random
import re

import pytest
from brute import score
from pyspark.sql import functions as F

from valence.functions import lexicon as lx
from valence.functions.arithmetic import round_binary
from valence.functions.sentiment import register_sql, strip, tokens, with_sentiment
from valence.sources.samples import FEED_PHRASES

FIXTURES = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "FIXTURES.md")
ROW = re.compile(r"\| (\d+) \| `(.*)` \| (\w+) \| (\S+) \| (\S+) \| (\S+) \| (\S+) \| (.*?) ?\| \S+ \|")


def run(spark, texts, rounding="exact"):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4)
    out = with_sentiment(rows, rounding=rounding).orderBy("i").collect()
    return [
        (
            r.analysis.sentiment, r.analysis.polarity, r.analysis.confidence, r.analysis.positive_score,
            r.analysis.negative_score, r.analysis.keywords,
        )
        for r in out
    ]


def random_texts(n, seed):
    rng = random.Random(seed)
    words = list(lx.WORD_WEIGHTS) + list(lx.MODIFIERS) * 2 + lx.NEGATIONS * 2
    odd = lx.POSITIVE_EMOJI + lx.NEGATIVE_EMOJI + ["❤", "café", "naïve", "日本", "x_1", "a--b", "--good", "bad'", "'t", "’", "-", "'"]
    gaps = [" ", " ", " ", ", ", ". ", "!", "\n", "\t", " - ", "'", "-", "", "_"]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 14)):
            word = rng.choice(words if rng.random() < 0.8 else odd)
            parts += [word.upper() if rng.random() < 0.1 else word, rng.choice(gaps)]
        texts.append("".join(parts))
    return texts


def test_golden_phrases(spark):
    with open(FIXTURES, encoding="utf-8") as f:
        golden = [m.groups() for m in map(ROW.match, f) if m]
    assert len(golden) == 64
    assert [g[1] for g in golden] == FEED_PHRASES
    want = [
        (g[2], float(g[3]), float(g[4]), float(g[5]), float(g[6]), [k for k in g[7].strip().split(",") if k])
        for g in golden
    ]
    assert run(spark, FEED_PHRASES) == want


# Fixed values, a second time and as decimals: a wrong weight in the package must not pass.
GOLDEN_WORDS = """fantastic 0.95 amazing 0.95 excellent 0.9 great 0.85 love 0.9 enjoyed 0.8 awesome 0.9 good 0.7
wonderful 0.9 delicious 0.85 happy 0.8 best 0.9 positive 0.75 superb 0.9 perfect 0.95 brilliant 0.9 loved 0.9 enjoy 0.8
helpful 0.75 nice 0.7 beautiful 0.85 recommend 0.8 flawless 0.95 outstanding 0.95 excited 0.85 pleased 0.8 glad 0.75
delightful 0.9 impressive 0.85 clean 0.6 fast 0.65 smooth 0.7 worth 0.75 solid 0.7 masterpiece 0.98 favorite 0.85
top-notch 0.95 super 0.8 terrible -0.95 horrible -0.95 worst -0.98 boring -0.85 hate -0.9 awful -0.95 bad -0.75 poor -0.8
disappointed -0.85 disappointing -0.85 waste -0.85 annoying -0.8 slow -0.6 useless -0.9 sucks -0.9 broken -0.8 fail -0.85
failed -0.85 trash -0.95 crap -0.9 garbage -0.95 hated -0.9 painful -0.85 pathetic -0.9 mess -0.8 unacceptable -0.9
nightmare -0.95 problem -0.65 buggy -0.8 flawed -0.75 regret -0.85 disaster -0.95 ugly -0.8 mediocre -0.7 dull -0.75"""
GOLDEN_MODIFIERS = """very 1.3 really 1.3 extremely 1.5 super 1.35 so 1.25 absolutely 1.4 highly 1.3 totally 1.3
completely 1.4 somewhat 0.7 slightly 0.8"""
GOLDEN_NEGATIONS = """not no never hardly barely scarcely without isn't aren't wasn't weren't haven't hasn't don't doesn't
didn't won't wouldn't can't cannot couldn't"""
GOLDEN_EMOJI = {"😊😀😃😄😍👍🔥✨🎉💯": 1, "😞😢😡😠👎💔💩🤮😭": -1}


def pairs(text):
    items = text.split()
    return dict(zip(items[::2], map(float, items[1::2])))


def test_every_word_modifier_negation_and_emoji(spark):
    words, want = pairs(GOLDEN_WORDS), {}
    assert len(words) == 73 == len(lx.WORD_WEIGHTS)
    for word, weight in words.items():
        want[f"xx {word}."] = weight
        want[f"not {word}"] = -weight * (0.85 if weight > 0 else 0.7)
    for modifier, factor in pairs(GOLDEN_MODIFIERS).items():
        want[f"{modifier} bad"] = -0.75 * factor
        want[f"{modifier} boring"] = -0.85 * factor
    del want["super bad"], want["super boring"]  # "super" is a word as well
    for negation in GOLDEN_NEGATIONS.split():
        want[f"{negation} bad"] = want[f"{negation} yy bad"] = 0.75 * 0.7
    for emoji, side in GOLDEN_EMOJI.items():
        want |= {f"x {e}": 1.2 * side for e in emoji}
    want["x ❤️"], want["x ❤"] = 1.2, 0.0
    for text, (_, polarity, _, p, n, _) in zip(want, run(spark, list(want))):
        value = want[text]
        assert (p, n) == (pytest.approx(max(value, 0), abs=0.00501), pytest.approx(max(-value, 0), abs=0.00501)), text
        assert polarity == pytest.approx(value / (abs(value) + 0.5), abs=0.000501), text
    (name, _, _, p, n, _), = run(spark, ["super bad"])
    assert (p, n) == (0.8, pytest.approx(0.75 * 1.35, abs=0.0051))


@pytest.mark.parametrize("rounding", ["exact", "binary"])
def test_words_inside_other_tokens_do_not_count(spark, rounding):
    texts = ["goodness", "nogood", "good-bad", "bad's", "_bad", "bad_", "badé", "ébad", "bad1", "1bad", "-bad-", "'bad'", "BAD", "İbad"]
    got = run(spark, texts, rounding)
    assert [bool(g[5]) for g in got] == [bool(score(t)[5]) for t in texts]


@pytest.mark.parametrize("rounding", ["exact", "binary"])
def test_random_texts_match_second_implementation(spark, rounding):
    texts = random_texts(3000, seed=7)
    got = run(spark, texts, rounding)
    for text, result in zip(texts, got):
        assert result == score(text, binary=rounding == "binary"), text


def test_both_roundings_differ_by_one_last_digit_at_most(spark):
    texts = FEED_PHRASES + random_texts(500, seed=11)
    for text, a, b in zip(texts, run(spark, texts), run(spark, texts, "binary")):
        assert abs(a[1] - b[1]) < 0.0011 and abs(a[2] - b[2]) < 0.11, text
        assert abs(a[3] - b[3]) < 0.011 and abs(a[4] - b[4]) < 0.011, text
        assert a[5] == b[5]


def test_edge_cases(spark):
    texts = [None, "", " \t\n \x1c\x85", "'- '-", "great " * 40, "The package arrived on time."]
    got = run(spark, texts)
    assert got[0] == got[1] == got[2] == ("Neutral", 0.0, 50.0, 0.0, 0.0, [])
    assert got[3] == ("Neutral", 0.0, 65.0, 0.0, 0.0, [])
    assert got[4][0] == "Positive" and got[4][2] == 99.5 and got[4][5] == ["great"]
    assert got[5] == ("Neutral", 0.0, 65.0, 0.0, 0.0, [])


def test_long_texts(spark):
    chain, word = "a-" * 200_000 + "a", "x" * 1_000_000
    texts = [chain + " good", word + " not bad", "-" * 500_000 + "good", " " * 500_000 + "good" + " " * 500_000 + ".", "good " * 100_000]
    got = run(spark, texts)
    assert [g[5] for g in got] == [["good"], ["not bad"], ["good"], ["good"], ["good"]]
    assert got[4][3] == 70_000.0
    spaces = spark.createDataFrame([("x" + " " * 500_000 + "y" + " " * 500_000,)], "t string")
    assert spaces.selectExpr(f"length({strip('t')}) AS n").first().n == 500_002


def test_blank_text_has_a_label(spark):
    row = with_sentiment(spark.createDataFrame([(None,)], "text string")).first()
    assert row.analysis.label == "\U0001F610 Neutral"


def test_invariants(spark):
    for name, polarity, confidence, p, n, keywords in run(spark, random_texts(500, seed=3)):
        assert -1 <= polarity <= 1 and 0 <= confidence <= 100
        assert (name == "Positive") == (polarity >= 0.15) and (name == "Negative") == (polarity <= -0.15)
        assert keywords == sorted(set(keywords)) and bool(keywords) == (p + n > 0)


def test_order_of_separate_clauses_does_not_matter(spark):
    clauses = ["really good . . .", "not bad at all", "so slow , , ,", "never mind it , superb one"]
    pad = " xx yy "
    a, b = run(spark, [pad.join(clauses), pad.join(reversed(clauses))])
    assert a == b


def test_tokens(spark):
    cases = {"Top-Notch don't a--b 'x'": ["top-notch", "don't", "a--b", "x"], "don’t ❤️ café": ["don", "t", "café"], "": []}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", F.expr(tokens("t")).alias("w"))
    assert {r.t: r.w for r in rows.collect()} == cases


def test_binary_rounding_is_python_rounding(spark):
    rng = random.Random(5)
    values = [2.675, 0.0625, 0.125, 0.375, 0.5, 1.005, 0.605, 0.0, 99.95, 1e-9]
    values += [rng.randint(0, 20000) / 2000 for _ in range(300)] + [rng.random() * 100 for _ in range(300)]
    values += [-v for v in values]
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    for digits in (1, 2, 3):
        got = rows.select("v", F.expr(round_binary("v", digits)).alias("r")).collect()
        for r in got:
            assert r.r == round(r.v, digits), (r.v, digits)


@pytest.mark.parametrize("rounding", ["exact", "binary"])
def test_sql_function_gives_the_same(spark, rounding):
    register_sql(spark, "mood", rounding)
    texts = FEED_PHRASES + random_texts(200, seed=23) + [None]
    spark.createDataFrame(list(enumerate(texts)), "i int, text string").createOrReplaceTempView("some_texts")
    rows = spark.sql("SELECT i, mood(text) AS a, mood('not bad').polarity AS p FROM some_texts ORDER BY i").collect()
    assert [(*r.a[:1], *r.a[3:]) for r in rows] == run(spark, texts, rounding)
    assert {r.p for r in rows} == {0.512}


def test_unknown_rounding(spark):
    with pytest.raises(ValueError):
        with_sentiment(spark.createDataFrame([("x",)], "text string"), rounding="bank")

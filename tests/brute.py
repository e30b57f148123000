"""A plain second implementation of the scoring rules, for checks on small input."""

from __future__ import annotations

import re
from fractions import Fraction

from valence.functions import lexicon as lx

_RUN = re.compile(r"[\w'-]+")


def token_list(text: str) -> list[str]:
    trimmed = (run.strip("'-") for run in _RUN.findall(text.lower()))
    return [t for t in trimmed if t]


def contributions(text: str):
    """(keyword, favourable, weight, modifier, factor) per listed word, in hundredths."""
    words = token_list(text)
    for word, before, before2 in zip(words, [None, *words], [None, None, *words]):
        if word not in lx.WORD_WEIGHTS:
            continue
        weight = lx.WORD_WEIGHTS[word]
        negated = before in lx.NEGATIONS or before2 in lx.NEGATIONS
        modifier = 100 if before in lx.NEGATIONS else lx.MODIFIERS.get(before, 100)
        factor = (85 if weight > 0 else 70) if negated else 100
        yield ("not " if negated else "") + word, (weight > 0) != negated, abs(weight), modifier, factor


def half_up(value: Fraction, digits: int) -> Fraction:
    scaled = abs(value) * 10**digits
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return Fraction(whole if value >= 0 else -whole, 10**digits)


def score(text: str | None, binary: bool = False) -> tuple:
    text = text or ""
    number = float if binary else (lambda x: Fraction(str(x)))
    rounded = round if binary else half_up
    p = n = number(0)
    keywords = set()
    for keyword, favourable, weight, modifier, factor in contributions(text):
        value = number(weight / 100) * number(modifier / 100)
        if factor != 100:
            value = value * number(factor / 100)
        p, n = (p + value, n) if favourable else (p, n + value)
        keywords.add(keyword)
    if any(e in text for e in lx.POSITIVE_EMOJI):
        p += number(1.2)
        keywords.add("positive_emoji")
    if any(e in text for e in lx.NEGATIVE_EMOJI):
        n += number(1.2)
        keywords.add("negative_emoji")
    polarity = rounded((p - n) / (p + n + number(0.5)), 3)
    name = "Positive" if polarity >= number(0.15) else "Negative" if polarity <= number(-0.15) else "Neutral"
    if not text.strip():
        confidence = 50
    elif p + n == 0:
        confidence = 65
    elif name == "Neutral":
        confidence = rounded(100 - abs(polarity) * 100, 1)
    else:
        confidence = min(number(99.5), rounded((p if name == "Positive" else n) / (p + n + number(0.1)) * 100, 1))
    return (
        name, float(polarity) + 0.0, float(confidence), float(rounded(p, 2)), float(rounded(n, 2)), sorted(keywords)
    )

"""Text, time and display helpers as Spark SQL expressions."""

from __future__ import annotations

from . import lexicon as lx
from .arithmetic import literal, literals, round_binary

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Parts that mark a keyword as negative on the display. A
# substring test: it flags "top-notch" and misses "worst".
DISPLAY_NEGATIVE_PARTS = ["terrible", "boring", "hate", "bad", "not"]
# Limits of the polarity band, narrower than the class limits.
BAND_LIMIT = 0.1


def iso_utc(ts: str) -> str:
    """ISO-8601 text ending in Z; whole seconds carry no fraction. Session time zone: UTC."""
    text = f"date_format({ts}, {literal(ISO_MICROS)})"
    return f"concat(regexp_replace({text}, '[.]000000$', ''), 'Z')"


def event_time(text: str) -> str:
    """Timestamp of an ISO text; null where it is no timestamp."""
    return f"try_to_timestamp({text})"


def time_of_day(ts: str) -> str:
    return f"date_format({ts}, 'HH:mm:ss')"


def escape_html(text: str) -> str:
    out = f"coalesce({text}, '')"
    # Fixed values; the ampersand goes first, as the entities hold one.
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        out = f"replace({out}, {literal(char)}, {literal(entity)})"
    return out


def signed_text(value: str) -> str:
    """Two decimals with a sign, e.g. ``+0.66``."""
    size = f"format_string('%.2f', {round_binary(f'abs({value})', 2, ties_even=False)})"
    return f"concat(CASE WHEN {value} >= 0 THEN '+' ELSE '-' END, {size})"


def polarity_band(value: str) -> str:
    return f"CASE WHEN {value} > {BAND_LIMIT}D THEN 'good' WHEN {value} < -{BAND_LIMIT}D THEN 'bad' ELSE 'mid' END"


def pointer_percent(value: str) -> str:
    """Position of a polarity on a dial from 0 to 100."""
    return f"greatest(0.0D, least(100.0D, ({value} + 1.0D) / 2.0D * 100.0D))"


def displays_negative(keyword: str) -> str:
    """The display's substring test."""
    return "(" + " OR ".join(f"contains({keyword}, {literal(part)})" for part in DISPLAY_NEGATIVE_PARTS) + ")"


def adds_negative(keyword: str) -> str:
    """Whether a keyword adds to the negative side."""
    words = [w if weight < 0 else f"not {w}" for w, weight in lx.WORD_WEIGHTS.items()]
    return f"{keyword} IN ({literals([*words, 'negative_emoji'])})"


def digest(key: str) -> str:
    """MD5 of a key; a null key counts as empty text."""
    return f"md5(coalesce(CAST({key} AS STRING), ''))"


def stable_hash(key: str) -> str:
    """32 bits of the key's MD5 as a bigint: the same in every run, partitioning and engine."""
    return f"CAST(conv(substring({digest(key)}, 1, 8), 16, 10) AS BIGINT)"

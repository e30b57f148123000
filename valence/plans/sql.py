"""DuckDB SQL that computes the same results in another way: tokens as rows, joins and window functions."""

from __future__ import annotations

from ..functions import lexicon as lx
from ..sources.samples import FEED_PHRASES, PRESET_SAMPLES, PRODUCER_SAMPLES

# Written without possessive quantifiers, for the other regex engine.
TOKEN = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_''-]*[\p{L}\p{N}_])?"
# The \x{..} ranges are control characters that count as white space.
SPACE = r"\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}"
BROWSER_SPACE = r"\s\p{Z}\x{0B}\x{FEFF}"
ISO = "replace(strftime({0}, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') || 'Z'"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    cell = lambda x: quote(x) if isinstance(x, str) else str(x)
    return "(VALUES " + ", ".join("(" + ", ".join(cell(x) for x in row) + ")" for row in rows) + ")"


def strip(text: str, space: str = SPACE) -> str:
    return f"regexp_replace({text}, '^[{space}]+|[{space}]+$', '', 'g')"


def blank(text: str, space: str = SPACE) -> str:
    return f"coalesce(regexp_full_match({text}, '[{space}]*'), true)"


FEED = f"""
phrases AS (SELECT * FROM {values(enumerate(FEED_PHRASES))} AS v(n, phrase)),
feed AS (
  SELECT printf('msg_%05d', event_id) AS id, phrase AS text, event_type AS source,
         'user_' || user_id AS "user", {ISO.format('ts')} AS "timestamp", ts AS event_ts, event_id
  FROM events JOIN phrases ON n = event_id % {len(FEED_PHRASES)})"""

SAMPLES = f"""
samples AS (SELECT * FROM {values(PRODUCER_SAMPLES + PRESET_SAMPLES)} AS v(text, source, "user"))"""


def half_up(numerator: str, denominator: str, scale: int) -> str:
    """Integer units of 1/scale, half away from zero."""
    return (
        f"(CASE WHEN ({numerator}) < 0 THEN -1 ELSE 1 END"
        f" * ((abs({numerator}) * {2 * scale} + ({denominator})) // (({denominator}) * 2)))"
    )


def _any_of(text: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {quote(p)})" for p in parts) + ")"


def round_even(value: str, digits: int) -> str:
    """Correct rounding of the binary value: the decimal text of 30 digits shows on which side of a tie it lies."""
    return f"CAST(printf('%.{digits}f', {value}) AS DOUBLE)"


def score(source: str, key: str, text: str = "text", rounding: str = "exact") -> str:
    """CTEs that end in ``score(k, sentiment, ..., keywords)`` for the relation ``source``."""
    exact = rounding == "exact"
    negations = "(" + ", ".join(quote(w) for w in lx.NEGATIONS) + ")"
    if exact:
        value = (
            "abs(weight) * modifier * CASE WHEN NOT negated THEN 100 WHEN weight > 0 THEN 85 ELSE 70 END"
        )
        bonus, zero = lx.EMOJI_UNITS, "0"
        total = lambda side: f"CAST(coalesce(sum(value) FILTER (favourable = {side}), 0) AS BIGINT)"
        milli = half_up("p - n", "p + n + 500000", 1000)
        share = lambda side: half_up(side, "p + n + 100000", 1000)
        points = lambda side: f"{half_up(side, '1000000', 100)} / 100.0"
    else:
        base = "(abs(weight) / 100.0::DOUBLE) * (modifier / 100.0::DOUBLE)"
        value = (
            f"CASE WHEN NOT negated THEN {base} WHEN weight > 0 THEN {base} * 0.85::DOUBLE ELSE {base} * 0.7::DOUBLE END"
        )
        bonus, zero = "1.2::DOUBLE", "0.0::DOUBLE"
        total = lambda side: (
            f"coalesce(list_reduce(list(value ORDER BY i) FILTER (favourable = {side}), lambda a, b: a + b),"
            " 0.0::DOUBLE)"
        )
        milli = f"CAST(round({round_even('(p - n) / (p + n + 0.5::DOUBLE)', 3)} * 1000) AS BIGINT)"
        share = lambda side: (
            f"CAST(round({round_even(f'{side} / (p + n + 0.1::DOUBLE) * 100', 1)} * 10) AS BIGINT)"
        )
        points = lambda side: round_even(side, 2)
    face = f"CASE sentiment WHEN 'Positive' THEN '{lx.FACES['Positive']}' WHEN 'Negative' THEN '{lx.FACES['Negative']}' ELSE '{lx.FACES['Neutral']}' END"
    return f"""
weights AS (SELECT * FROM {values(lx.WORD_WEIGHTS.items())} AS v(word, weight)),
modifiers AS (SELECT * FROM {values(lx.MODIFIERS.items())} AS v(word, modifier)),
texts AS (SELECT {key} AS k, {text} AS body FROM {source}),
lists AS (SELECT k, regexp_extract_all(lower(body), '{TOKEN}') AS ws FROM texts),
tokens AS (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM lists),
near AS (SELECT k, w, i, lag(w, 1) OVER t AS w1, lag(w, 2) OVER t AS w2
         FROM tokens WINDOW t AS (PARTITION BY k ORDER BY i)),
hits AS (SELECT k, w, i, weight,
           coalesce(w1 IN {negations}, false) OR coalesce(w2 IN {negations}, false) AS negated,
           CASE WHEN coalesce(w1 IN {negations}, false) THEN 100 ELSE coalesce(modifier, 100) END AS modifier
         FROM near JOIN weights ON weights.word = w LEFT JOIN modifiers ON modifiers.word = w1),
parts AS (SELECT k, i, (weight > 0) <> negated AS favourable, {value} AS value,
            CASE WHEN negated THEN 'not ' || w ELSE w END AS keyword FROM hits),
by_text AS (SELECT k, {total('true')} AS p, {total('false')} AS n, list(keyword) AS found FROM parts GROUP BY k),
flags AS (SELECT k, {blank('body')} AS blank,
            coalesce({_any_of('body', lx.POSITIVE_EMOJI)}, false) AS good,
            coalesce({_any_of('body', lx.NEGATIVE_EMOJI)}, false) AS bad FROM texts),
sums AS (SELECT k, blank,
           coalesce(p, {zero}) + CASE WHEN good THEN {bonus} ELSE {zero} END AS p,
           coalesce(n, {zero}) + CASE WHEN bad THEN {bonus} ELSE {zero} END AS n,
           list_sort(list_distinct(coalesce(found, []) || CASE WHEN good THEN ['positive_emoji'] ELSE [] END
             || CASE WHEN bad THEN ['negative_emoji'] ELSE [] END)) AS keywords
         FROM flags LEFT JOIN by_text USING (k)),
rated AS (SELECT *, {milli} AS milli FROM sums),
named AS (SELECT *, CASE WHEN milli >= 150 THEN 'Positive' WHEN milli <= -150 THEN 'Negative' ELSE 'Neutral' END
            AS sentiment FROM rated),
score AS (SELECT k, sentiment, {face} AS emoji, {face} || ' ' || sentiment AS label, milli,
            milli / 1000.0 AS polarity,
            CASE WHEN blank THEN 500 WHEN p + n = 0 THEN 650
                 WHEN sentiment = 'Positive' THEN least({share('p')}, 995)
                 WHEN sentiment = 'Negative' THEN least({share('n')}, 995)
                 ELSE 1000 - abs(milli) END / 10.0 AS confidence,
            {points('p')} AS pos_score, {points('n')} AS neg_score, keywords FROM named)"""


SCORE_COLUMNS = (
    "sentiment, emoji, label, polarity, confidence, pos_score, neg_score, array_to_string(keywords, ',') AS keywords"
)

SCORED_FEED = f"""{FEED}, {score('feed', 'id')},
scored AS (SELECT id, text, source, "user", "timestamp", event_ts, event_id, score.* EXCLUDE (k)
           FROM feed JOIN score ON k = id)"""


def percent(part: str, total: str, rounding: str = "exact") -> str:
    if rounding == "binary":
        return f"CASE WHEN {total} > 0 THEN {round_even(f'CAST({part} AS DOUBLE) / greatest({total}, 1) * 100', 1)} ELSE 0.0 END"
    return f"CASE WHEN {total} > 0 THEN {half_up(f'{part} * 100', f'greatest({total}, 1)', 10)} / 10.0 ELSE 0.0 END"


def mean(total_milli: str, total: str, rounding: str = "exact") -> str:
    if rounding == "binary":
        value = round_even(f"coalesce({total_milli}, 0) / 1000.0::DOUBLE / greatest({total}, 1)", 3)
        return f"CASE WHEN {total} > 0 THEN {value} ELSE 0.0 END"
    return f"CASE WHEN {total} > 0 THEN {half_up(f'coalesce({total_milli}, 0)', f'greatest({total}, 1)', 1)} / 1000.0 ELSE 0.0 END"


def kpi(source: str, keys: str = "", rounding: str = "exact") -> str:
    """CTE body of the metrics of scored rows."""
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {lead}total, positive, negative, neutral,
  {percent('positive', 'total', rounding)} AS positive_pct, {percent('negative', 'total', rounding)} AS negative_pct,
  {percent('neutral', 'total', rounding)} AS neutral_pct, {mean('milli', 'total', rounding)} AS avg_polarity
FROM (SELECT {lead}count(*) AS total, count(*) FILTER (sentiment = 'Positive') AS positive,
        count(*) FILTER (sentiment = 'Negative') AS negative, count(*) FILTER (sentiment = 'Neutral') AS neutral,
        CAST(sum(milli) AS BIGINT) AS milli FROM {source} {group})"""


def signed(value: str, milli: str) -> str:
    """Sign and two decimals; exact binary ties, such as 0.125, go away from zero."""
    size = f"CASE WHEN abs({milli}) % 250 = 125 THEN (abs({milli}) + 5) // 10 / 100.0 ELSE abs({value}) END"
    return f"CASE WHEN {value} >= 0 THEN '+' ELSE '-' END || printf('%.2f', CAST({size} AS DOUBLE))"


def escape(text: str) -> str:
    out = f"coalesce({text}, '')"
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#039;")):
        out = f"replace({out}, '{char}', '{entity}')"
    return out


def bucket(key: str) -> str:
    return f"CAST('0x' || substr(md5(coalesce(CAST({key} AS VARCHAR), '')), 1, 8) AS BIGINT)"

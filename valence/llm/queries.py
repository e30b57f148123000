"""Queries of the operators over whole tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import Query
from ..session import prepare
from ..sources.tables import table
from . import (
    decontaminate, fingerprints, language_id, licenses, merkle, near_dedup, packing, quality, sharding, suffixes, toxicity, warc, whitening,
)
from .common import fold, held_out, small_batches

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(small_batches(prepare(spark)), folder)

    QUERIES[build.__name__] = run
    return build


# Brute force over all windows that hold a shingle of an item; lengths in words.
ORACLES["op2_benchmark_decontamination"] = r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, len(w) AS m, least(5, len(w)) AS n FROM i WHERE len(w) > 0),
runs AS (SELECT item_id, m, n, unnest(list_transform(range(1, m - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS s
  FROM sized),
items AS (SELECT item_id, m, n, s, count(*) AS c FROM runs GROUP BY ALL),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
placed AS (SELECT doc_id, n, len(w) AS size, unnest(range(0, len(w) - n + 1)) AS p,
  unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS s
  FROM d JOIN (SELECT DISTINCT n FROM sized) ON len(w) >= n),
hits AS (SELECT doc_id, item_id, m, n, size, p, s, c FROM placed JOIN items USING (n, s)),
near AS (SELECT doc_id, item_id, m, n, size, p, unnest(range(0, m - n + 1)) AS back FROM hits),
windows AS (SELECT DISTINCT doc_id, item_id, greatest(0, least(p - back, size - m)) AS first_word, least(m, size) AS n_words
  FROM near),
inside AS (SELECT doc_id, item_id, first_word, n_words, m, n, s, c, count(*) AS x
  FROM windows JOIN hits USING (doc_id, item_id) WHERE p BETWEEN first_word AND first_word + n_words - n GROUP BY ALL),
common AS (SELECT doc_id, item_id, first_word, n_words, m, n, sum(least(x, c)) AS shared FROM inside GROUP BY ALL),
scored AS (SELECT *, CAST(shared AS DOUBLE) / ((m - n + 1) + (n_words - n + 1) - shared) AS similarity FROM common)
SELECT doc_id, item_id, similarity, CAST(first_word AS BIGINT) AS first_word, CAST(n_words AS BIGINT) AS n_words FROM scored
WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, first_word) = 1"""


def _shard_sql(shards: int) -> str:
    """CTE body ``rid, shard``: all draws of a level as rows, the smallest one kept."""
    leaves = ", ".join(f"({x.region}, {x.rack}, {x.shard}, {x.weight})" for x in sharding.layout(shards))
    draw = lambda path, child: (
        f"-ln((CAST('0x' || substr(md5(concat_ws('/', {path}, {child}, k)), 1, 13) AS BIGINT) + 0.5::DOUBLE)"
        " / 4503599627370496.0::DOUBLE) / w"
    )
    return f"""WITH leaf AS (SELECT * FROM (VALUES {leaves}) AS v(region, rack, shard, weight)),
g AS (SELECT rid, k, region FROM doc, (SELECT region, CAST(sum(weight) AS DOUBLE) AS w FROM leaf GROUP BY region)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY {draw("'tree'", 'region')}, region) = 1),
r AS (SELECT rid, k, region, rack FROM g JOIN (SELECT region, rack, CAST(sum(weight) AS DOUBLE) AS w FROM leaf GROUP BY ALL)
  USING (region) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY {draw('region', 'rack')}, rack) = 1)
SELECT rid, shard FROM r JOIN (SELECT region, rack, shard, CAST(weight AS DOUBLE) AS w FROM leaf) USING (region, rack)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY {draw("concat_ws('/', region, rack)", 'shard')}, shard) = 1"""


def _crc_sql(rows: str, value: str) -> str:
    """CTEs that end in ``crc(rid, crc32)``: CRC-32 of the UTF-8 bytes of ``value``, bit by bit, for each ``rid`` of ``rows``."""
    return f"""bits AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
bytes AS (SELECT rid, list_transform(regexp_extract_all(hex(encode({value})), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS b FROM {rows}),
crc AS (SELECT rid, xor(list_reduce(list_prepend(4294967295, b),
  lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INTEGER) + 1])), 4294967295) AS crc32 FROM bytes, bits)"""


# Slots as Spark numbers them where one input split holds all rows, as in a file of one row group.
ORACLES["op7_sharding"] = f"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, coalesce(text, '') AS text
  FROM documents),
{_crc_sql("doc", "text")},
own AS ({_shard_sql(40)}), grown AS ({_shard_sql(41)}),
rows AS (SELECT doc_id, CAST(octet_length(encode(text)) + 16 AS BIGINT) AS size, CAST(crc32 AS BIGINT) AS text_crc32, 'key' AS law,
  own.shard AS shard, grown.shard AS grown_shard FROM doc JOIN crc USING (rid) JOIN own USING (rid) JOIN grown USING (rid))
SELECT doc_id, size, text_crc32, law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard FROM rows"""


# Each window as a row; removed windows that touch or overlap are one span.
ORACLES["op12_suffix_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT rid, doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(length(h) // 2 - 49)) AS i FROM d)),
again AS (SELECT rid, i FROM windows JOIN (SELECT s, min(doc_id) AS least FROM windows GROUP BY s) USING (s) WHERE doc_id > least),
marked AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER o + 50 THEN 0 ELSE 1 END AS fresh FROM again WINDOW o AS (PARTITION BY rid ORDER BY i)),
numbered AS (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS span FROM marked),
spans AS (SELECT rid, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY ALL),
edges AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM edges JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN cut USING (rid)"""


def _leaf_sql(n_chars: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + "))"


def _levels_sql(name: str, leaves: str) -> str:
    """CTE ``name(tree, level, pos, n, h)``: all nodes of the trees over ``leaves(tree, pos, n, h)``."""
    return f"""{name} AS (SELECT tree, 0 AS level, pos, n, h FROM {leaves} UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1
  GROUP BY tree, level, pos // 2, n)"""


# Trees level by level; a row's way to the root as rows, folded one after the other.
ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE doc AS (SELECT row_number() OVER () AS rid, * FROM documents),
{_crc_sql("doc", "coalesce(CAST(doc_id AS VARCHAR), '')")},
leaf AS (SELECT rid, doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("n_chars")} AS h,
  CASE WHEN doc_id IS NOT NULL AND n_chars IS NOT NULL AND crc32 % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} END AS tampered
  FROM doc JOIN crc USING (rid)),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h, rid) - 1 AS pos,
  count(*) OVER (PARTITION BY tree) AS n FROM leaf),
{_levels_sql("node", "placed")},
sub AS (SELECT tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, '' AS tree FROM node WHERE n = 1),
{_levels_sql("upper", "sub")},
way AS (SELECT p.rid, a.level AS step, a.pos AS at, b.h AS sibling FROM placed p
    JOIN node a ON a.tree = p.tree AND a.n > 1 AND a.pos = p.pos >> a.level
    LEFT JOIN node b ON b.tree = a.tree AND b.level = a.level AND b.pos = xor(a.pos, 1)
  UNION ALL SELECT p.rid, 100 + a.level, a.pos, b.h FROM placed p JOIN sub s ON s.name = p.tree
    JOIN upper a ON a.n > 1 AND a.pos = s.pos >> a.level LEFT JOIN upper b ON b.level = a.level AND b.pos = xor(a.pos, 1)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY step) AS k FROM way),
folded AS (SELECT rid, 0::BIGINT AS k, coalesce(tampered, h) AS h FROM placed UNION ALL
  SELECT f.rid, o.k, sha256(CASE WHEN o.at % 2 = 1 THEN concat(sibling, f.h) ELSE concat(f.h, sibling) END)
  FROM folded f JOIN ordered o ON o.rid = f.rid AND o.k = f.k + 1),
ends AS (SELECT rid, arg_max(h, k) AS folded_root FROM folded GROUP BY rid),
proofs AS (SELECT rid, sha256(coalesce(string_agg(sibling, '' ORDER BY k), '')) AS proof_sha256 FROM placed LEFT JOIN ordered USING (rid) GROUP BY rid)
SELECT doc_id, placed.h AS leaf, sub.h AS subroot, upper.h AS root, proof_sha256, folded_root, folded_root = upper.h AS verified
FROM placed JOIN ends USING (rid) JOIN proofs USING (rid) JOIN sub ON sub.name = placed.tree JOIN upper ON upper.n = 1"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(documents(spark, folder), table(spark, folder, "labels"))


def digests(pieces: DataFrame) -> DataFrame:
    """Packed pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document and benchmark item that it leaks."""
    found = decontaminate.leaks(documents(spark, folder), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "first_word", "n_words")


@query
def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_dedup.near_duplicates(documents(spark, folder))
    return groups.select("doc_id", near_dedup.hex_of().alias("fingerprint"), "component_id")


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(documents(spark, folder), table(spark, folder, "labels"))


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return digests(packing.pack(documents(spark, folder)))


@query
def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """The longest shared passages as words, with their places in the document and in the other text; null where there is none."""
    study = fingerprints.edit_study(documents(spark, folder))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for other in ("edited", "next"):
        longest = f"array_max(transform(shared_{other}, p -> named_struct('words', p.words, 'back', -p.pos, 'other', p.other)))"
        study = study.withColumn(f"longest_{other}", F.expr(longest))
        columns += [F.col(f"longest_{other}.words").alias(f"passage_{other}"), (-F.col(f"longest_{other}.back")).alias(f"passage_{other}_at"),
                    F.col(f"longest_{other}.other").alias(f"passage_{other}_there")]
    return study.select(*columns)


@query
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.assign(documents(spark, folder), sharding.layout(40), sharding.layout(41))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language_id.learn(rows.where(fold("doc_id", 3) != 1))
    found = language_id.identify(rows, model)
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "runner_up", "ambiguous")


@query
def op9_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """Two derived records of each page's response record."""
    return warc.derivatives(warc.responses(table(spark, folder, "pages")))


@query
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licences(documents(spark, folder))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@query
def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.cut_repeats(documents(spark, folder))


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))

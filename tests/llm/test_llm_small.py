"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from valence.llm import decontaminate, fingerprints, language_id, licenses, near_dedup, packing, quality, sharding, toxicity, warc
from valence.llm.common import fold, held_out
from valence.llm.queries import digests

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog"), (2, "The quick brown fox jumps over the lazy dog"), (3, None), (4, ""),
    (5, " \n\t "), (None, "a row without an id"), (None, None), (6, LONG), (7, "12 34 ... !!"), (8, "\U0001f600 naïve Ünïcode 漢字テスト"),
    (1, "the quick brown fox jumps over the lazy dog"),
]
# Names that the operators use themselves.
EXTRA = "doc_id bigint, text string, key string, fp string, score string, range int, tie int, guest int, shard int, part int, slot int, ids int, lang string, item_id int, sequence_id int, label string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, *["x" if "string" in c else 1 for c in EXTRA.split(", ")[2:]]) for i, t in ROWS]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (None, 1, 1), (6, None, None), (4, 1, 0), (4, 0, 0), (99, 1, 1), (7, 0, 1)],
        "doc_id bigint, quality int, toxic int",
    )


def collected(df):
    return [r.asDict() for r in df.collect()]


def test_folds(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "k bigint").select("k", fold("k", 5).alias("f"), held_out("k", 5, 0).alias("h"))
    for r in rows.collect():
        want = None if r.k is None else zlib.crc32(str(r.k).encode()) % 5
        assert (r.f, r.h) == (want, want == 0)


def test_quality(spark, docs, none, labels):
    rows = collected(quality.score(docs, labels))
    assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(str(i) for i, _ in ROWS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert quality.score(none, labels).count() == 0
    assert {r["score"] for r in collected(quality.score(docs, labels.limit(0)))} == {0.0}


def test_statistics_are_finite_and_cover_whole_texts():
    for _, text in ROWS:
        assert np.isfinite(quality.statistics(text)).all()
    assert (quality.statistics(LONG) != quality.statistics(LONG + " ###")).any()


def test_toxicity(spark, docs, none, labels):
    rows = collected(toxicity.score(docs, labels))
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(none, labels).count() == 0
    assert len({r["score"] for r in collected(toxicity.score(docs, labels.limit(0)))}) == 1
    kept = toxicity.without_toxic(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(ROWS)


def test_language(spark, docs, none):
    learned = language_id.learn(docs.withColumn("lang", F.when(F.col("doc_id") == 1, "en").when(F.col("doc_id") == 8, "xx")))
    rows = {r["doc_id"]: r for r in collected(language_id.identify(docs.where("doc_id IS NOT NULL"), learned))}
    assert {i for i, r in rows.items() if r["lang_pred"] == "und"} == {3, 4, 5, 7}
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] == "en" and rows[8]["lang_pred"] == "xx"
    empty = language_id.learn(none)
    assert {(r["lang_pred"], r["score"]) for r in collected(language_id.identify(docs, empty))} == {("und", 0.0)}
    assert language_id.identify(none, learned).count() == 0
    kept = language_id.with_language(docs, learned)
    assert kept.columns == docs.columns and kept.count() == 6


def test_near_duplicates(spark, docs, none):
    rows = collected(near_dedup.near_duplicates(docs))
    assert len(rows) == len(ROWS)
    group = {}
    for r in rows:
        group.setdefault(r["component_id"], []).append(r["doc_id"])
        assert (r["fp"] == 0) == (r["doc_id"] in (3, 4, 5) or (r["doc_id"] is None and r["fp"] == 0))
    assert sorted(group[1]) == [1, 1, 2] and sorted(group[3], key=str) == [3, 4, 5, None]
    assert near_dedup.near_duplicates(none).count() == 0
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.select("doc_id").collect()))) == ["1", "3", "6", "7", "8", "None", "None"]


def test_leaks(spark, docs, none):
    items = spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy"), (2, None), (3, ""), (4, "naïve Ünïcode"), (1, "quick brown fox jumps over the lazy"), (None, "a row without an id")],
        "item_id int, text string",
    )
    rows = [(r["doc_id"], r["item_id"], r["passage"]) for r in collected(decontaminate.leaks(docs, items))]
    text = "quick brown fox jumps over the lazy"
    assert sorted(rows, key=str) == sorted(
        [(i, 1, text) for i in (1, 1, 2) for _ in range(2)] + [(8, 4, "naïve Ünïcode"), (None, None, "a row without an id")], key=str
    )
    assert decontaminate.leaks(none, items).count() == 0 == decontaminate.leaks(docs, items.limit(0)).count()
    kept = decontaminate.without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [3, 4, 5, 6, 7]
    assert decontaminate.without_leaks(docs, items.limit(0)).count() == len(ROWS)


def test_items_in_several_blocks_give_the_same(spark, docs, monkeypatch):
    items = spark.createDataFrame([(i, "quick brown fox jumps over the lazy dog"[: 39 - i % 2 * 4]) for i in range(9)], "item_id int, text string")
    whole = sorted(map(str, collected(decontaminate.leaks(docs, items))))
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 2)
    assert whole and sorted(map(str, collected(decontaminate.leaks(docs, items)))) == whole


def test_packing(spark, docs, none):
    rows = collected(packing.pack(docs, window=64, open_windows=3))
    sequences, total, ids = {}, 0, []
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] > 0
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        total += r["length"]
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 64 or at & (at - 1) == 0
    encode = packing.encoder(packing.public_vocabulary())
    assert total == sum((len(encode(t)) if t else 0) + 1 for _, t in ROWS)
    long = sorted((r["start"], bytes(r["ids"])) for r in rows if r["doc_id"] == 6)
    assert b"".join(p for _, p in long) == np.append(encode(LONG), np.uint32(1)).astype("<u4").tobytes()
    assert packing.pack(none).count() == 0
    assert digests(packing.pack(docs)).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_left_over_windows_of_many_tasks_are_packed_again(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 3)
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat('some words ', CAST(id % 7 AS INT)) AS text").repartition(20, "doc_id")
    rows = collected(packing.pack(docs, window=32, open_windows=2))
    sizes = {}
    for r in rows:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    short = sorted(n for n in sizes.values() if n < 32)
    assert len(set(short)) == len(short) and all(n & (n - 1) == 0 for n in short)
    assert {r["doc_id"] for r in rows} == set(range(40))


def test_fingerprints(spark, docs, none):
    rows = collected(fingerprints.fingerprints(docs))
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by[3] == by[4] == by[5] == {""} and len(by[1]) == 1 and by[1] != by[6]
    study = collected(fingerprints.edit_study(docs))
    assert len(study) == len(ROWS) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in study)
    assert fingerprints.edit_study(none).count() == 0
    (one,) = collected(fingerprints.edit_study(docs.where("doc_id = 6")))
    assert one["near_next"] == 1.0 and one["near_edited"] > 0.3
    assert [tuple(p) for p in one["shared_next"]] == [(0, 0, 60_000)] and one["shared_edited"][0]["words"] > 29_000
    text_keys = collected(fingerprints.edit_study(docs.withColumn("doc_id", F.col("doc_id").cast("string"))))
    plain = lambda rows: sorted(repr({**r, "doc_id": str(r["doc_id"])}) for r in rows)
    assert plain(text_keys) == plain(study)


def test_shards(spark, docs, none):
    rows = collected(sharding.assign(docs, sharding.layout(40), sharding.layout(41)))
    assert len(rows) == len(ROWS) and len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {16}
    assert sharding.assign(none, sharding.layout(40)).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.example/x", "<title>T &amp; U</title><p>one<br>two<script>no</script><a href='/y'>three</a>"), (2, None, None),
         (None, "http://b.example/\r\nX: y", ""), (1, "http://a.example/x", "<title>T &amp; U</title><p>one<br>two<script>no</script><a href='/y'>three</a>")],
        "page_id int, url string, html string",
    )
    rows = collected(warc.derivatives(warc.responses(pages)))
    assert len(rows) == 8
    texts = {r["page_id"]: warc.parse(bytes(r["record"])) for r in rows if r["record_type"] == "conversion"}
    assert texts[1][1].decode() == "T & U\none\ntwo three" and texts[2][1] == b"" and "warc-target-uri" not in texts[2][0]
    assert "\r" not in texts[None][0]["warc-target-uri"] and "x" not in texts[None][0]
    about = next(warc.parse(bytes(r["record"])) for r in rows if r["record_type"] == "metadata" and r["page_id"] == 1)
    assert b"outlink: http://a.example/y\r\n" in about[1] and b"title: T & U\r\n" in about[1]
    assert b"source-header: Content-Type: text/html; charset=utf-8\r\n" in about[1]
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0
    odd = spark.createDataFrame([(1, None), (2, b"no record"), (3, b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort")], "page_id int, record binary")
    assert warc.derivatives(odd).count() == 0


def test_licences(spark, docs, none):
    assert licenses.licences(docs).count() == 0 == licenses.licences(none).count()
    rows = spark.createDataFrame([(1, "Released under the MIT License.\nReleased under the MIT License."), (None, "released under   the MIT license"), (2, None)], "doc_id int, text string")
    assert sorted(((r["doc_id"], r["license"], r["first_char"]) for r in collected(licenses.licences(rows))), key=str) == [
        (1, "MIT", 0), (1, "MIT", 32), (None, "MIT", 0),
    ]


def test_stages_keep_the_columns_of_documents(spark, tmp_path, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "near_dedup", "decontamination", "packing"]
    folder = "/root/testdata/sf0.001"
    few = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60")
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, few, folder)
        if name != "packing":
            assert out.columns == few.columns and out.schema.simpleString() == few.schema.simpleString()
            assert 30 < out.count() <= few.count()
    assert out.count() >= 60

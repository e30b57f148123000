"""Whitening, removal of repeated strings and the Merkle manifest against plain versions; stages on awkward columns."""

import hashlib
import zlib

import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from valence.llm import merkle, suffixes, whitening

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


# --- whitening ---


def plain_whitening(vectors):
    """By the library's double eigenvectors."""
    x = np.floor(1024 * np.array(vectors, float)) + 100000
    centred = x - x.mean(axis=0)
    values, parts = np.linalg.eigh(centred.T @ centred / len(x))
    values, parts = values[::-1], parts[:, ::-1]
    n, whole = len(x), [[int(v) for v in row] for row in x]
    sums = [sum(column) for column in zip(*whole)]
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in whole]
    return centred @ parts[:, :8] / np.sqrt(values[:8]), values / values.sum(), deviation


def test_whitening_query(spark):
    got = driver.queries()["op11_whitening"](spark, LARGER).toPandas().sort_values(["vec_id", "component"])
    given = spark.read.parquet(f"{LARGER}/embeddings.parquet").toPandas().sort_values("vec_id")
    white, explained, deviation = plain_whitening(given["embedding"].tolist())
    assert len(got) == 8 * len(given) and (got["identity_error"] < 1e-9).all() and (got["n"] == len(given)).all()
    found = got["whitened"].to_numpy().reshape(-1, 8)
    for k in range(8):
        assert min(np.abs(found[:, k] - white[:, k]).max(), np.abs(found[:, k] + white[:, k]).max()) < 1e-8
    assert np.allclose(got["explained"].to_numpy()[:8], explained[:8], rtol=1e-10)
    assert got["deviation"].tolist()[::8] == deviation


def test_whitening_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0], 0), (2, [2.0, 1.0, 3.0], 0), (None, [0.0, 0.5, 3.0], 0), (2, [2.0, 1.0, 3.0], 0), (3, None, 0), (4, [1.0, nan, 0.0], 0),
            (5, [inf, 1.0, 0.0], 0), (6, [None, 1.0, 2.0], 0), (7, [], 0), (8, [1.0], 0), (9, [-1.0, 0.25, 3.0], 0)]
    table = spark.createDataFrame(rows, "vec_id int, embedding array<double>, n int").repartition(3)
    got = whitening.whiten(table).toPandas()
    assert sorted(got["vec_id"].fillna(-1).tolist()) == sorted([1, 2, -1, 2, 9] * 3) and (got["n"] == 5).all()
    flat = got[got["component"] == 3]
    assert flat["whitened"].isna().all() and (flat["explained"].abs() < 1e-12).all() and (got["identity_error"] < 1e-9).all()
    assert whitening.whiten(table.limit(0)).count() == 0 and whitening.whiten(table.where("vec_id = 7")).count() == 0
    alone = whitening.whiten(table.where("vec_id = 1")).toPandas()
    assert len(alone) == 3 and alone["whitened"].isna().all() and (alone["deviation"] == 0).all()


def test_products_are_exact():
    for most in (5, 1 << 20, 1 << 33):
        y = np.random.default_rng(2).integers(-most, most, (3000, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.exact_gram(y).tolist() == want


@pytest.mark.parametrize("spectrum", [[5, 5, 5 - 1e-9, 5 - 2e-9, 3, 3, 1e-3, 0], [1 + 1e-7 * i for i in range(20)], [2.0] * 6, range(1, 40)])
def test_eigenvectors_of_clusters(spectrum):
    lam = np.array(list(spectrum), float)
    turn = np.linalg.qr(np.random.default_rng(0).normal(size=(len(lam), len(lam))))[0]
    matrix = (turn * lam) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.eigenvectors(matrix.astype(np.longdouble))
    assert np.abs(vectors.T @ vectors - np.eye(len(lam))).max() < 1e-15
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-14 * max(1, lam.max())
    assert np.allclose(values, sorted(lam, reverse=True), atol=1e-13 * max(1, lam.max()))


# --- repeated strings ---


@pytest.mark.parametrize("symbols", [1, 2, 5, 250])
def test_suffix_order(symbols):
    draw = np.random.default_rng(symbols)
    for n in [*range(30), 400, 1500]:
        s = draw.integers(1, symbols + 1, n)
        assert suffixes.suffix_order(s, 10**9).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())
        firsts = [tuple(s[i : i + 50]) for i in suffixes.suffix_order(s, 50)]
        assert firsts == sorted(firsts) and len(firsts) == n


def plain_cuts(rows, length=50):
    rows = [(key, (text or "").encode()) for key, text in rows]
    first = {}
    for key, text in rows:
        for i in range(len(text) - length + 1):
            if key is not None:
                first[text[i : i + length]] = min(first.get(text[i : i + length], key), key)
    out = []
    for key, text in rows:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if key is not None and first[text[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((key, len(text), sum(gone), len([s for s in bytes(gone).split(b"\0") if s]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cuts(docs):
    return sorted((tuple(r) for r in suffixes.cut_repeats(docs).collect()), key=str)


def test_repeats_in_the_table(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = plain_cuts([(r.doc_id, r.text) for r in docs.collect()])
    got = driver.queries()["op12_suffix_dedup"](spark, FOLDER)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and sum(r[2] > 0 for r in want) > 20
    # Small portions, buckets and slices; every anchor common, then some.
    for name, value in {"PORTION_BYTES": 1 << 16, "BUCKET_BYTES": 1 << 15, "WINDOWS_AT_ONCE": 700, "ROWS_AT_ONCE": 50}.items():
        monkeypatch.setattr(suffixes, name, value)
    for records, parts in ((1, 1), (3, 4)):
        monkeypatch.setattr(suffixes, "COMMON_RECORDS", records)
        monkeypatch.setattr(suffixes, "COMMON_PORTIONS", parts)
        assert cuts(docs.repartition(4)) == want


def test_repeats_in_awkward_texts(spark):
    a, b = "".join(chr(97 + i * i % 26) for i in range(70)), "é" * 40 + "ü" * 30
    rows = [(3, a), (1, a[:60]), (2, "x" * 200), (5, "x" * 120 + a), (5, b), (5, b), (7, b + a), (None, a + b), (8, None), (9, ""), (-4, "z" + b[5:]),
            (10, a[:49]), (11, (a + " ") * 30), (None, None)]
    docs = spark.createDataFrame([(k, t, 1, "y") for k, t in rows], "doc_id bigint, text string, c int, body string").repartition(3)
    assert cuts(docs) == plain_cuts(rows)
    assert cuts(docs.limit(0)) == [] and cuts(docs.where("text IS NULL"))[0][1:4] == (0, 0, 0)


# --- Merkle manifest ---


def plain_manifest(rows):
    """Whole trees in memory. Rows hold doc_id, source, lang, n_chars and text."""
    h = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    leaf = lambda r: h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def tree(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([h(*found[-1][i : i + 2]) for i in range(0, len(found[-1]), 2)])
        return found

    langs = sorted({r[2] for r in rows}, key=lambda name: (name is not None, (name or "").encode()))
    order = {name: sorted((r for r in rows if r[2] == name), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for name in langs}
    trees = {name: tree([leaf(r) for r in order[name]]) for name in langs}
    top = tree([trees[name][-1][0] for name in langs]) if rows else []
    out = []
    for k, name in enumerate(langs):
        for i, r in enumerate(order[name]):
            hit = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node, others = leaf((*r[:3], r[3] + 1, r[4]) if hit else r), []
            for found, at in ((trees[name], i), (top, k)):
                for level in found[:-1]:
                    run = list(level[at // 2 * 2 : at // 2 * 2 + 2])
                    others += [x for j, x in enumerate(run) if j != at % 2]
                    run[at % 2] = node
                    node, at = h(*run), at // 2
            out.append((r[0], leaf(r), trees[name][-1][0], top[-1][0], h(*others), node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest_of(docs, **how):
    return sorted((tuple(r) for r in merkle.manifest(docs, **how).collect()), key=str)


def test_manifest_of_the_table(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    want = plain_manifest(rows)
    got = driver.queries()["op13_merkle_manifest"](spark, LARGER)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and {r[-1] for r in want} == {True, False}
    assert manifest_of(docs.repartition(5), bits=2) == want


def test_manifest_of_awkward_rows(spark):
    rows = [(1, "s", "en", 3, "abc"), (1, "s", "en", 3, "abc"), (1, "s", "en", 4, "abcd"), (None, None, None, None, None), (2, "", "", 0, ""), (3, "s", None, None, "é" * 9),
            (4, "s", "zz", 5, "x" * 100_000), *[(i, "t", "de", i, f"text {i}") for i in range(20, 41)], *[(i, "u", f"l{i}", 1, "1") for i in range(50, 61)]]
    kind = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, pos int, node string"
    docs = spark.createDataFrame([(*r, "q", 1, "q") for r in rows], kind).repartition(4)
    for bits in (1, 2, 10):
        assert manifest_of(docs, bits=bits) == plain_manifest(rows)
    assert manifest_of(docs.limit(0)) == []
    one = manifest_of(docs.where("lang = 'zz'"))[0]
    assert one[1] == one[2] == one[3] and one[4] == hashlib.sha256(b"").hexdigest()


# --- stages ---


def test_stages_leave_clashing_columns_alone(spark):
    names = ["fp", "fp_", "__fp", "__tie", "key", "a.b", "root", "vectors"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 50")
    given = docs.selectExpr("*", *[f"doc_id + {k} AS `{name}`" for k, name in enumerate(names)])
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, given, FOLDER)
        assert out.columns == given.columns, name
        rows = out.collect()
        assert len(rows) > 30 and all(r[n] == r["doc_id"] + k for r in rows for k, n in enumerate(names)), name
    assert corpus_pipeline.STAGES[-1][1](spark, given, FOLDER).count() >= 50

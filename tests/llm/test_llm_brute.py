"""The operators against plain second implementations and held-out labels, on the given tables."""

import re
import zlib
from collections import Counter, defaultdict

import hypothesis.strategies as st
import numpy as np
import oracle
import pytest
import xxhash
from hypothesis import given, settings

import __spark_entry__ as driver
from valence.llm import decontaminate, fingerprints, language_id, licenses, near_dedup, packing, sharding, toxicity, warc
from valence.llm.common import Isotonic
from valence.llm.queries import ORACLES

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


def rows_of(spark, name, folder=FOLDER):
    return [r.asDict(recursive=True) for r in driver.queries()[name](spark, folder).collect()]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("folder", [FOLDER, LARGER])
def test_matches_sql(spark, name, folder):
    count, extra, missing = oracle.compare(driver.queries()[name](spark, folder), oracle.connect(folder), ORACLES[name])
    assert count and not extra and not missing, (extra[:3], missing[:3])


# --- near duplicates ---


def plain_simhash(text):
    words = text.encode().lower().split()
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, radius=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_near_duplicates(spark, texts):
    ids = sorted(texts)
    fps = [plain_simhash(texts[i]) for i in ids]
    groups = [ids[g] for g in plain_groups(fps)]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows_of(spark, "op3_simhash_near_dedup")}
    assert got == {i: (f"{fp:016x}", g) for i, fp, g in zip(ids, fps, groups)}


def test_golay_code_is_perfect_and_its_keys_meet():
    code = near_dedup.Golay()
    assert set(code.counts.tolist()) == {1, 6} and (code.counts == 6).sum() == 1771
    draw = np.random.default_rng(1)
    words = draw.integers(0, 1 << 23, 4000)
    other = words.copy()
    for _ in range(2):
        other ^= 1 << draw.integers(0, 23, len(words))
    (a, n), (b, m) = code.keys(words), code.keys(other)
    for i in range(len(words)):
        assert set(a[i, : n[i]].tolist()) & set(b[i, : m[i]].tolist())


def test_every_pair_within_four_bits_shares_a_key():
    draw, code = np.random.default_rng(2), near_dedup.Golay()
    fps = draw.integers(-(1 << 63), 1 << 63, 3000, dtype=np.int64)
    near = fps.copy()
    for _ in range(4):
        near ^= np.int64(1) << draw.integers(0, 64, len(fps))
    sets = []
    for values in (fps, near):
        keys, rows = near_dedup.fuzzy_keys(values, code)
        by = defaultdict(set)
        for k, r in zip(keys.tolist(), rows.tolist()):
            by[r].add(k)
        sets.append(by)
    assert all(sets[0][i] & sets[1][i] for i in range(len(fps)))


@pytest.mark.parametrize("pairwise", [4096, 3])
def test_crowded_keys_lose_no_link(spark, monkeypatch, pairwise):
    monkeypatch.setattr(near_dedup, "PAIRWISE", pairwise)
    draw = np.random.default_rng(3)
    fps = []
    for centre in draw.integers(0, 1 << 62, 12):
        for _ in range(25):
            fp = int(centre)
            for bit in draw.choice(64, draw.integers(0, 6), replace=False):
                fp ^= 1 << int(bit)
            fps.append(fp - (1 << 64) if fp >> 63 else fp)
    fps = sorted(set(fps))
    table = spark.createDataFrame([(f, f) for f in fps], "key bigint, fp bigint").repartition(5)
    from valence.llm.components import components

    root = {r.node: r.root for r in components(near_dedup.links(table)).collect()}
    got = [root.get(f, f) for f in fps]
    assert got == [fps[g] for g in plain_groups([f & (1 << 64) - 1 for f in fps])]


def test_components_of_a_long_path(spark):
    from valence.llm.components import components

    path = spark.range(1, 300).selectExpr("id AS a", "id - 1 AS b")
    assert {(r.node, r.root) for r in components(path).collect()} == {(i, 0) for i in range(1, 300)}


def test_a_key_at_several_texts_keeps_one_text_of_each_group(spark):
    line = lambda name: " ".join(f"{name}{i}" for i in range(40))
    rows = [(1, line("a")), (1, line("b")), (2, line("b")), (2, line("c")), (3, line("c")), (3, line("a")), (4, line("d")), (4, line("d").upper()), (4, line("d"))]
    for parts in (1, 3, 7):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        kept = [(r.doc_id, r.text.lower()) for r in near_dedup.keep_first(docs).collect()]
        assert sorted(kept) == [(1, line("a")), (1, line("b")), (2, line("c")), (4, line("d"))]


# --- decontamination ---


def plain_leaks(texts, items):
    words = lambda s: re.findall(r"[^\W_]+", s.lower())
    shingles = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    found = {}
    for i, item in items.items():
        w, a = words(item), shingles(words(item))
        for d, text in texts.items():
            v = words(text)
            best = 0
            places = [p for p in range(len(v) - 4) if tuple(v[p : p + 5]) in a]
            for s in {min(max(0, p - k), max(0, len(v) - len(w))) for p in places for k in range(len(w) - 4)}:
                b = shingles(v[s : s + len(w)])
                best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= 0.8:
                found[d, i] = round(best, 9)
    return found


def test_leaks(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows_of(spark, "op2_benchmark_decontamination")}
    assert got == plain_leaks(texts, items)


def test_near_copies_of_passages_are_found(spark):
    draw = np.random.default_rng(4)
    word = lambda: "".join(draw.choice(list("abcdefgh"), 4))
    items = {i: " ".join(word() for _ in range(60)) for i in range(30)}
    texts = {}
    for i, item in items.items():
        words = item.split()
        words[int(draw.integers(5, 55))] = "changed"
        texts[i] = " ".join([word() for _ in range(40)] + words + [word() for _ in range(40)])
    want = plain_leaks(texts, items)
    frame = lambda rows, name: spark.createDataFrame(list(rows.items()), f"{name} int, text string")
    rows = decontaminate.leaks(frame(texts, "doc_id"), frame(items, "item_id")).collect()
    assert len(want) == 30 and {(r.doc_id, r.item_id): round(r.similarity, 9) for r in rows} == want


def test_blocks_miss_no_fingerprint_within_the_radius():
    draw = np.random.default_rng(5)
    sized = decontaminate.Sized(items=list(range(50)), fps=draw.integers(0, 1 << 63, 50, dtype=np.uint64))
    sized.close()
    windows = sized.fps.repeat(40)
    for _ in range(decontaminate.RADIUS + 3):
        windows = windows ^ (np.uint64(1) << draw.integers(0, 64, len(windows), dtype=np.uint64))
    w, i, distance = sized.within(windows)
    every = np.bitwise_count(windows[:, None] ^ sized.fps[None, :])
    assert set(zip(w.tolist(), i.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(every <= decontaminate.RADIUS))))


# --- toxicity, language, quality ---


@given(st.lists(st.sampled_from(["stupidly", "Stupid", "stupidity", "abcdefghij", "abcdexyz", "no", "x1y", "naïveté"])).map(" ".join), st.integers(0, 2**20))
@settings(max_examples=200, deadline=None)
def test_chosen_terms_are_counted_as_all_terms(text, pick):
    find = toxicity._finder()
    every = toxicity.terms_of("stupidly stupid stupidity abcdefghij abcdexyz no no x1y naïveté naïveté stupid", find)
    terms = [t for i, t in enumerate(sorted(every)) if pick >> (i % 20) & 1]
    vocabulary, whole = toxicity.Vocabulary(terms), toxicity.terms_of(text, find)
    assert vocabulary.counts(text, find) == {i: whole[t] for i, t in enumerate(terms) if t in whole}


def test_block_max_search_is_exact():
    draw = np.random.default_rng(6)
    vectors = []
    for _ in range(500):
        terms = np.sort(draw.choice(40, draw.integers(0, 8), replace=False))
        weights = draw.choice([1.0, 2.0, 3.0], len(terms))
        vectors.append((terms, weights / max(np.sqrt((weights**2).sum()), 1e-9)))
    index, dense = toxicity.Index(vectors, 40), np.zeros((500, 40))
    for row, (t, w) in enumerate(vectors):
        dense[row, t] = w
    for t, w in vectors[:120]:
        cosine = np.round(dense[:, t] @ w, 9)
        want = [(-c, i) for c, i in sorted((-c, i) for i, c in enumerate(cosine) if c > 0)[:15]]
        got = index.nearest(t, w, 15)
        assert [round(c, 9) for c, _ in got] == [c for c, _ in want]


def auc(score, label):
    score, label = np.array(score), np.array(label)
    a, b = score[label == 1][:, None], score[label == 0][None, :]
    return ((a > b).mean() + (a == b).mean() / 2) if a.size and b.size else 1.0


def test_held_out_quality(spark):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = [r for r in rows_of(spark, "op1_quality", LARGER) if r["held_out"] and r["doc_id"] in labels]
    assert auc([r["score"] for r in rows], [labels[r["doc_id"]].quality for r in rows]) > 0.95
    assert {zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows} == {0}


def test_held_out_toxicity(spark):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = [r for r in rows_of(spark, "op4_toxicity", LARGER) if r["held_out"] and r["doc_id"] in labels]
    flagged = [r["doc_id"] for r in rows if r["predicted"]]
    assert flagged and all(labels[d].toxic for d in flagged)
    assert all(r["evidence"] for r in rows if r["predicted"])


def test_held_out_language(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in rows_of(spark, "op8_language_id", LARGER) if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) > 0.99 * len(rows)


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 12, 40])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    apart = [(a != b).sum() for k, a in enumerate(code) for b in code[:k]]
    assert min(apart) >= (2 ** (n - 2) if n <= 6 else 15)
    assert all(len(set(column)) == 2 for column in code.T)


def test_many_languages_are_told_apart(spark):
    draw = np.random.default_rng(7)
    kinds = {f"l{i}": ["".join(draw.choice(list("abcdefghijklmnop"), 3)) for _ in range(12)] for i in range(9)}
    rows = [(k, lang, " ".join(draw.choice(words, 60))) for k in range(8) for lang, words in kinds.items()]
    table = spark.createDataFrame([(i, lang, text) for i, (_, lang, text) in enumerate(rows)], "doc_id int, lang string, text string")
    model = language_id.learn(table.where("doc_id < 45"))
    got = language_id.identify(table, model).join(table, "doc_id")
    assert got.where("lang_pred = lang").count() == len(rows)


def test_ngrams_of_long_texts_do_not_depend_on_the_parts(monkeypatch):
    text = "some Words ünd mehr, 12! " * 40
    whole = language_id.ngrams(text)
    monkeypatch.setattr(language_id, "AT_ONCE", 7)
    assert (language_id.ngrams(text) == whole).all()


@given(st.lists(st.tuples(st.floats(-1, 2), st.integers(0, 1)), max_size=40))
@settings(max_examples=50, deadline=None)
def test_calibration_never_falls(rows):
    x, y = np.array([r[0] for r in rows]), np.array([float(r[1]) for r in rows])
    out = Isotonic(x, y, np.ones(len(rows)))(np.linspace(-1, 2, 50))
    assert ((0 <= out) & (out <= 1)).all() and (np.diff(out) >= -1e-12).all()


# --- packing ---


def test_packed_pieces_hold_every_id_once(spark, texts):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows_of(spark, "op5_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == list(np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1])
        sizes.append(sum(n for _, n in parts))
    short = [n for n in sizes if n < 2048]
    assert len(short) <= 11 and all(n & (n - 1) == 0 for n in short) and max(sizes) == 2048


@pytest.fixture(scope="module")
def encoders():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    return packing.encoder(path("byte_bpe_50k.json")), Tokenizer.from_file(path("byte_bpe_50k.json"))


@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["<|endoftext|>", " it's", "  \n\t", "é́", "漢字", "१२", "½Ⅷ", "\x85  ", "a" * 50, "!?", "‍"])).map("".join)))
@settings(max_examples=300, deadline=None)
def test_fast_ids_are_the_ids_of_the_library(encoders, text):
    fast, library = encoders
    assert fast(text).tolist() == library.encode(text, add_special_tokens=False).ids


# --- fingerprints ---


def plain_anchors(text):
    """Hash, first word and words of each closed syncmer."""
    chain = lambda numbers: [seed := 42, *[seed := xxhash.xxh64_intdigest((n % 2**64).to_bytes(8, "little"), seed) for n in numbers]][-1]
    words = re.sub(r"([\u0E00-\u0E7F\u2E80-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF])", r" \1 ", text)
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split(r"[ \t\n\x0b\f\r]+", words) if w]
    signed = lambda n: n - 2**64 if n >> 63 else n
    if len(h) < 5:
        return [(chain(h) >> 32, 0, len(h))] if h else []
    g = [signed(chain(h[i : i + 2])) for i in range(len(h) - 1)]
    return [(chain(h[i : i + 5]) >> 32, i, 5) for i in range(len(h) - 4) if min(g[i], g[i + 3]) <= min(g[i + 1], g[i + 2])]


def plain_fingerprint(anchors):
    places = [0, *[place for _, place, _ in anchors]]
    assert all(0 <= b - a <= 3 for a, b in zip(places, places[1:]))
    return "".join(f"{b - a:x}{h:08x}" for a, b, (h, _, _) in zip(places, places[1:], anchors))


def plain_comparison(own, other):
    """Likeness, and the shared passages as place, other place and words."""
    if not own and not other:
        return 1.0, []
    there = defaultdict(list)
    for h, place, _ in reversed(other):
        there[h].append(place)
    met = [(place, there[h].pop(), n) for h, place, n in own if there[h]]
    passages = []
    for place, at, n in met:
        if passages and place - at == passages[-1][0] - passages[-1][1] and place <= passages[-1][3] + 5:
            passages[-1] = (*passages[-1][:2], place + n - passages[-1][0], place)
        else:
            passages.append((place, at, n, place))
    return len(met) / (len(own) + len(other) - len(met)), [p[:3] for p in passages]


def test_fingerprints_and_edits(spark, texts):
    import hashlib

    ids = sorted(texts)
    rows = {r["doc_id"]: r for r in rows_of(spark, "op6_fingerprints")}
    study = fingerprints.edit_study(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    shared = {r.doc_id: ([tuple(p) for p in r.shared_edited], [tuple(p) for p in r.shared_next]) for r in study.collect()}
    assert sorted(rows) == sorted(shared) == ids
    for place, i in enumerate(ids):
        text, following = texts[i], texts[ids[(place + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = plain_anchors(text), plain_anchors(edited), plain_anchors(following)
        (near_edited, in_edited), (near_next, in_next) = plain_comparison(own, other), plain_comparison(own, after)
        assert shared[i] == (in_edited, in_next)
        want = {
            "doc_id": i, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(), "fingerprint": plain_fingerprint(own),
            "edited_fingerprint": plain_fingerprint(other), "near_edited": near_edited, "near_next": near_next,
        }
        for name, passages in (("edited", in_edited), ("next", in_next)):
            at, there, n = min(passages, key=lambda p: (-p[2], p[0], -p[1]), default=(None, None, None))
            want |= {f"passage_{name}": n, f"passage_{name}_at": at, f"passage_{name}_there": there}
        assert rows[i] == want


def test_a_passage_of_long_texts_is_found_with_its_places(spark):
    draw, word = np.random.default_rng(11), lambda n: [f"w{x}" for x in draw.integers(0, 5000, n)]
    rows, planted = [], {}
    for pair in range(60):
        passage = word(60)
        for side in range(2):
            at = int(draw.integers(0, 2900))
            rows.append((f"{pair:03d}{side}", " ".join([*word(at), *passage, *word(3000 - at)])))
            planted[pair, side] = at
    # Keys are text here: each first text is followed by its partner.
    study = fingerprints.edit_study(spark.createDataFrame(rows, "name string, body string"), "name", "body")
    found = {r.name: [(p.pos, p.other, p.words) for p in r.shared_next] for r in study.collect()}
    assert len(found) == 120
    for pair in range(60):
        a, b = planted[pair, 0], planted[pair, 1]
        at, there, n = max(found[f"{pair:03d}0"], key=lambda p: p[2])
        assert a - 8 <= at <= a + 3 and at - there == a - b and 54 <= n <= 68


# --- shards, records, licences ---


def test_shards(spark, texts):
    import hashlib
    import math

    def winner(children, path, key):
        draw = lambda c: -math.log((int(hashlib.md5("/".join([*path, str(c), key]).encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / children[c]
        return min(children, key=lambda c: (draw(c), c))

    def shard(key, leaves):
        regions = {}
        for leaf in leaves:
            regions.setdefault(leaf.region, {}).setdefault(leaf.rack, {})[leaf.shard] = leaf.weight
        total = lambda racks: sum(sum(r.values()) for r in racks.values())
        g = winner({g: total(r) for g, r in regions.items()}, ["tree"], key)
        r = winner({r: sum(s.values()) for r, s in regions[g].items()}, [str(g)], key)
        return winner(regions[g][r], [str(g), str(r)], key)

    got = {r["doc_id"]: r for r in rows_of(spark, "op7_sharding")}
    assert set(got) == set(texts)
    for doc, r in got.items():
        assert r["shard"] == shard(str(doc), sharding.layout(40)) and r["grown_shard"] == shard(str(doc), sharding.layout(41))
        assert r["text_crc32"] == zlib.crc32(texts[doc].encode()) and r["size"] == len(texts[doc].encode()) + 16


def test_shards_follow_weights_and_move_only_where_weights_change(spark):
    leaves = sharding.layout(40)
    heavy = [sharding.Leaf(x.region, x.rack, x.shard, 4.0 if x.shard == 7 else 1.0) for x in leaves]
    rows = spark.range(40_000).withColumnRenamed("id", "k")
    both = sharding.shard_of(sharding.shard_of(rows, leaves, "k", "a"), heavy, "k", "b")
    moved = [(r.a, r.b, r["count"]) for r in both.groupBy("a", "b").count().collect()]
    sizes = Counter()
    for a, b, n in moved:
        sizes[b] += n
        # Out of another region into the grown one, or within it into the grown rack, or within that into the grown shard.
        assert a == b or (a // 20 != 0 and b // 20 == 0) or (a // 4 != 1 and b // 4 == 1) or b == 7
    assert 3 < sizes[7] / (40_000 / 43) < 5 and abs(sizes[30] / (40_000 / 43) - 1) < 0.3


def test_derived_records_follow_their_response(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = rows_of(spark, "op9_warc_derivatives")
    assert Counter(r["page_id"] for r in rows) == {p: 2 for p in pages}
    for r in rows:
        page = pages[r["page_id"]]
        source, _ = warc.parse(warc.response(page.url, page.html.encode(), str(page.page_id)))
        headers, block = warc.parse(bytes(r["record"]))
        assert headers["warc-refers-to"] == source["warc-record-id"] == r["refers_to"]
        assert headers["warc-target-uri"] == page.url and headers["warc-date"] == source["warc-date"]
        assert headers["warc-block-digest"] == warc.digest(block) and r["source_payload_digest"] == warc.digest(page.html.encode())
        assert warc.serialize([(k, v) for k, v in headers.items() if k != "content-length"], block).endswith(block + b"\r\n\r\n")
        if r["record_type"] == "conversion":
            assert not re.search(rb"<[a-z/]", block) and b"track(" not in block
    assert len({r["record_id"] for r in rows}) == len(rows)


def test_licences(spark, texts):
    lines = {
        "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    }
    want = Counter((d, name) for d, t in texts.items() for line, name in lines.items() for _ in range(t.count(line)))
    rows = rows_of(spark, "op10_license_scan")
    assert Counter((r["doc_id"], r["license"]) for r in rows) == want and want
    assert all(texts[r["doc_id"]][r["first_char"] : r["last_char"]] in lines for r in rows)


APACHE = """# Copyright 2020 Someone
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""


def test_licence_rules():
    scan = licenses.Scanner().licences
    (found,) = scan("import x\n" + APACHE + "\nimport y")
    assert found[:2] == ("Apache-2.0", "notice") and len(found[4]) >= 4
    mit = "\n".join(s for name in ("mit-permission", "mit-notice", "mit-as-is", "mit-liability") for s in licenses.SENTENCES[name])
    assert [f[:2] for f in scan(mit)] == [("MIT", "text")]
    bsd = " ".join(licenses.SENTENCES[n][0] for n in ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-as-is"))
    assert [f[:2] for f in scan(bsd)] == [("BSD-2-Clause", "text")]
    assert scan("SPDX-License-Identifier: GPL-2.0-only\n")[0][:2] == ("GPL-2.0-only", "spdx")
    assert scan("The above copyright notice and this permission notice shall be included in all copies.") == []
    out_of_order = " ".join(licenses.SENTENCES[n][0] for n in ("bsd-as-is", "bsd-binary", "bsd-source", "bsd-redistribute"))
    assert scan(out_of_order) == []


GPL = """/* This program is free software{0}
 * modify it under the terms of the GNU General Public License as
 * published by the Free Software Foundation{1} of the
 * License, or (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details. */
"""
MPL = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def test_wrapped_headers_with_punctuation_inside_sentences():
    scan = licenses.Scanner().licences
    hope = ["gpl-hope", "gpl-see"]
    gpl2 = GPL.format("; you can redistribute it and/or", "; either version 2")
    gpl3 = GPL.format(": you can redistribute it and/or", ", either version 3")
    wanted = {
        gpl2: ("GPL-2.0-or-later", ["gpl2-or-later", *hope]), gpl3: ("GPL-3.0-or-later", ["gpl3-or-later", *hope]),
        MPL: ("MPL-2.0", ["mpl2-subject", "mpl2-copy"]), " ".join(MPL.replace("//", "").split()): ("MPL-2.0", ["mpl2-subject", "mpl2-copy"]),
    }
    for text, (name, used) in wanted.items():
        for whole in (text, text.replace("\n", "\r\n"), "int a;\n" + text + "\nint b; int c;"):
            ((found, kind, first, last, sentences),) = scan(whole)
            assert (found, kind, sentences) == (name, "notice", used)
            assert whole[first:].lstrip("/* ").startswith("This") and whole[:last].rstrip(" */").endswith(".")
    # A word on each line is as good as a long line.
    assert [f[:2] for f in scan("\n".join(MPL.replace("//", "").split()))] == [("MPL-2.0", "notice")]
    assert scan(gpl3.replace("redistribute", "sell").replace("version 3", "version 4")) == []
    for before in ("", "x = 1  ", "Copyright 2020 Someone. ", "/*"):
        (found,) = scan(text := f"{before}SPDX-License-Identifier: MIT\nimport x")
        assert found[:2] == ("MIT", "spdx") and text[found[2] : found[3]].lstrip("/*") == "SPDX-License-Identifier: MIT"


def test_every_known_sentence_holds_a_cue():
    known, _ = licenses.catalogue()
    assert all(any(cue in sentence for cue in licenses.CUES) for sentence in known)


def test_cues_are_found_however_words_are_parted():
    known, _ = licenses.catalogue()
    scan = licenses.Scanner().licences
    for gap in ("-", "  ", "\n", "\n# ", "\t", "_", " \r\n * "):
        for sentence in known:
            assert any(cue in gap.join(sentence.split()).lower() for cue in licenses.CUES)
        for text, name in {"Released under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Released under CC BY 4.0": "CC-BY-4.0"}.items():
            assert [f[:2] for f in scan(text.replace("CC BY", f"CC{gap}BY"))] == [(name, "reference")]
        unlicense = licenses.SENTENCES["unlicense"][0].replace("public domain", f"public{gap}domain")
        assert [f[:2] for f in scan(unlicense)] == [("Unlicense", "text")]


# --- the pipeline ---


def test_stages_do_what_their_operators_say(spark):
    """Each stage against its operator's own answer on the stage's input."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels, items = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    kept = stages["toxicity"](spark, docs, FOLDER)
    assert ids(kept) == ids(toxicity.score(docs, labels).where("predicted = 0"))
    kept = stages["language_id"](spark, docs, FOLDER)
    assert ids(kept) == ids(docs)
    kept = stages["near_dedup"](spark, docs, FOLDER)
    assert ids(kept) == ids(near_dedup.near_duplicates(docs).where("component_id = doc_id")) != ids(docs)
    leaked = {r.doc_id for r in decontaminate.leaks(docs, items).collect()}
    assert leaked and ids(stages["decontamination"](spark, docs, FOLDER)) == sorted(set(ids(docs)) - leaked)
    whole = {r["doc_id"] for r in rows_of(spark, "pipeline")}
    assert 100 < len(whole) < docs.count() and not whole & leaked

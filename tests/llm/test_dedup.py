"""Near duplicates, repeated substrings and line dedup against brute force, and on nulls, ties and empty tables."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lorgnette.llm import graph, jaccard, line_dedup, substring

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return re.findall(rb"[0-9a-z_\x80-\xff]+", (text or "").lower().encode())


def corpus(seed=0, n=60):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)] + ["é%dü" % i for i in range(40)]
    out = []
    for i in range(n):
        if out and rnd.random() < 0.5:
            ws = rnd.choice(out).split(" ")
            ws = [rnd.choice(vocab) if rnd.random() < rnd.choice([0, 0.03, 0.1]) else w for w in ws]
        else:
            ws = [rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 5, 30, 120, 300, 900]))]
        if rnd.random() < 0.3 and out:
            other = rnd.choice(out).split(" ")
            at = rnd.randrange(len(other))
            ws[len(ws) // 2 : len(ws) // 2] = other[at : at + rnd.choice([20, 49, 50, 51, 70, 130])]
        out.append(" ".join(ws))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    texts = corpus()
    rows = [(i, t, "en", "s%d" % (i % 5), len(t)) for i, t in enumerate(texts)]
    rows += [(500, None, None, None, None), (501, "", "en", "s1", 0), (502, "!!! ...", "en", "s1", 7), (503, texts[0], "en", None, 1), (504, "x " * 30000, "en", "s2", 60000)]
    return spark.createDataFrame(rows + [rows[3]], SCHEMA).withColumn("block", F.lit(1)).withColumn("component", F.lit("x"))


def sets(rows, n=3):
    out = {}
    for r in rows:
        w = words(r["text"])
        if w:
            out[r["doc_id"]] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}
    return out


def brute_force(rows):
    """The alike pairs of documents, and (class_id, n_links, nearest) of each that has one."""
    s = sets(rows)
    parent = {k: k for k in s}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = {(a, b): len(s[a] & s[b]) for a in s for b in s if a < b and len(s[a] & s[b]) >= 0.5 * len(s[a] | s[b])}
    links, nearest = {}, {}
    for (a, b), o in pairs.items():
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
        for k in (a, b):
            links[k] = links.get(k, 0) + 1
            nearest[k] = max(nearest.get(k, 0), o / len(s[a] | s[b]))
    return s, pairs, {k: (root(k), n, round(nearest[k], 6)) for k, n in links.items()}


def near(df, **kwargs):
    out = jaccard.near_duplicates(df, **kwargs).collect()
    assert len(out) == len({r["doc_id"] for r in out})
    return {r["doc_id"]: (r["class_id"], r["n_links"], r["nearest"]) for r in out}


@pytest.mark.parametrize("shard", [2048, 3])
def test_jaccard_classes_match_brute_force(docs, shard, monkeypatch):
    s, pairs, want = brute_force(docs.collect())
    monkeypatch.setattr(jaccard, "SHARD_ROWS", shard)
    monkeypatch.setattr(jaccard, "LEAST", min(64, shard))
    assert near(docs) == want
    found = {(r["doc_a"], r["doc_b"]): (r["overlap"], r["jaccard"]) for r in jaccard.jaccard_join(docs).collect()}
    first = {}
    for k in sorted(s):
        first.setdefault(frozenset(s[k]), k)
    distinct = {p for p in pairs if s[p[0]] != s[p[1]] and p[0] in first.values() and p[1] in first.values()}
    assert set(found) == distinct and all(pairs[p] == o and abs(x - o / len(s[p[0]] | s[p[1]])) < 1e-12 for p, (o, x) in found.items())


def test_a_hot_group_of_near_copies_and_a_passage_that_many_share(spark, monkeypatch):
    rnd = random.Random(31)
    monkeypatch.setattr(jaccard, "SHARD_ROWS", 20)
    monkeypatch.setattr(jaccard, "LEAST", 16)
    draw = lambda n: ["w%d" % rnd.randrange(3000) for _ in range(n)]
    base, passage = draw(120), draw(40)
    texts = []
    for i in range(400):
        ws = list(base) if i % 3 == 0 else draw(rnd.randrange(60, 200))
        if i % 3 == 0 and i % 2:
            ws[rnd.randrange(120)] = "changed%d" % i
        if i % 3 == 1:
            ws[30:30] = passage
        texts.append(" ".join(ws))
    rows = [{"doc_id": i, "text": t} for i, t in enumerate(texts)]
    _, _, want = brute_force(rows)
    assert near(spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id bigint, text string")) == want


def test_texts_that_share_a_doc_id(spark):
    a, b = " ".join("a%d" % k for k in range(30)), " ".join("b%d" % k for k in range(30))
    got = jaccard.near_duplicates(spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (3, b), (4, "c d e"), (None, a)], "doc_id bigint, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1, 1.0), (2, 1, 1, 1.0), (2, 2, 1, 1.0), (3, 2, 1, 1.0)]


def test_alike_texts_that_share_a_doc_id_and_have_no_other_partner(spark):
    a = ["a%d" % k for k in range(30)]
    df = spark.createDataFrame([(1, " ".join(a)), (1, " ".join(a[:27] + ["x", "y", "z"])), (2, "c d e f g")], "doc_id bigint, text string")
    assert [tuple(r) for r in jaccard.near_duplicates(df).collect()] == [(1, 1, 1, round(25 / 31, 6))] * 2
    assert [tuple(r) for r in jaccard.jaccard_join(df).collect()] == [(1, 1, 25, 25 / 31)]


def test_small_sets_at_the_threshold_whose_hashes_collide(spark):
    seen, rows, used = {}, [], 0
    names = ["v%d" % k for k in range(6000)]
    grams = jaccard.gram_sets(jaccard.Words(), pa.array(names), 1)
    for name, g in zip(names, grams, strict=True):
        seen.setdefault(int(g[0]) >> 20 & 0xFFFF, []).append(name)
    for a, b in [x[:2] for x in seen.values() if len(x) > 1][:20]:
        own = ["u%d" % k for k in range(used, used + 30)]
        used += 30
        both = [a, b, *own[:14]]
        rows += [(2 * len(rows), " ".join(both + own[14:22])), (2 * len(rows) + 1, " ".join(both + own[22:]))]
    got = near(spark.createDataFrame(rows, "doc_id bigint, text string"), n=1)
    assert {k: v[0] for k, v in got.items()} == {rows[k][0]: rows[k - k % 2][0] for k in range(40)}


def test_large_sets_that_share_nothing_in_some_parts(spark):
    names = ["v%d" % k for k in range(12000)]
    part = [int(g[0] >> np.uint64(40)) % 32 for g in jaccard.gram_sets(jaccard.Words(), pa.array(names), 1)]
    inner, rows = iter([w for w, k in zip(names, part, strict=True) if k >= 4]), []
    for k in range(24):
        size = (300, 402, 450)[k % 3]
        # Of each two, 2/3 of the words are shared, or all of the smaller one's are in one of twice its size.
        both = [next(inner) for _ in range(size // 2 if k % 2 else size * 2 // 3)]
        a, b = (["%s%dx%d" % (side, k, i) for i in range(n)] for side, n in (("p", 0 if k % 2 else size // 3), ("q", size // 2 if k % 2 else size // 3)))
        rows += [(2 * k, " ".join(both + a)), (2 * k + 1, " ".join(b + both))]
    assert near(spark.createDataFrame(rows, "doc_id bigint, text string"), n=1) == {i: (i - i % 2, 1, 0.5) for i in range(48)}


def test_jaccard_apply_keeps_one_of_each_group(docs):
    kept = {r["doc_id"] for r in jaccard.apply(docs).collect()}
    assert 0 in kept and 503 not in kept and {500, 501, 502, 504} <= kept


def test_divide_skip_is_exact():
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 1 << 50, int(rng.integers(1, 200)), dtype=np.uint64) for _ in range(20)]
    s = [np.unique(b[rng.random(len(b)) > rng.random() * 0.4]) for b in base for _ in range(5)]
    s = [x for x in s if len(x)]
    for t in (0.5, 0.8):
        got = {(min(a, b), max(a, b), n) for a, b, n in jaccard.divide_skip(s, t)}
        want = {(a, b, n) for a in range(len(s)) for b in range(a + 1, len(s)) if (n := len(np.intersect1d(s[a], s[b]))) >= t * len(np.union1d(s[a], s[b]))}
        assert got == want
        side = rng.integers(0, 2, len(s))
        assert {(min(a, b), max(a, b), n) for a, b, n in jaccard.divide_skip(s, t, side)} == {x for x in want if side[x[0]] != side[x[1]]}


def test_divide_skip_counts_and_looks_up_alike(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(jaccard, "COUNTED", 7)
    base, passage = rng.integers(0, 1 << 50, (3, 40), dtype=np.uint64), rng.integers(0, 1 << 50, 30, dtype=np.uint64)
    # Near copies, and sets that share a passage alone, whose long lists bring few candidates.
    s = [np.unique(np.where(rng.random(40) < rng.random() * 0.6, rng.integers(0, 1 << 50, 40, dtype=np.uint64), base[k % 3])) for k in range(60)]
    s += [np.unique(np.concatenate([passage, rng.integers(0, 1 << 50, 40, dtype=np.uint64), base[0][: k % 30]])) for k in range(200)]
    got = sorted((min(a, b), max(a, b), n) for a, b, n in jaccard.divide_skip(s, 0.5))
    want = [(a, b, n) for a in range(len(s)) for b in range(a + 1, len(s)) if (n := len(np.intersect1d(s[a], s[b]))) >= 0.5 * (len(s[a]) + len(s[b]) - n)]
    assert got == want and len(want) > 60


def test_components_take_the_rounds_they_need(spark, monkeypatch):
    monkeypatch.setattr(graph, "ROUNDS", 1, raising=False)
    ids = list(range(40))
    random.Random(5).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids[:-1], ids[1:], strict=True)) + [(50, 51)], "a bigint, b bigint")
    assert {(r["id"], r["component"]) for r in graph.connected_components(edges).collect()} == {(i, 0) for i in ids} | {(50, 50), (51, 50)}


@pytest.mark.parametrize("frequent", [(16, 64), (2, 4)])
def test_substring_spans_match_brute_force(docs, monkeypatch, frequent):
    monkeypatch.setattr(substring, "ONE_IN", frequent[0])
    monkeypatch.setattr(substring, "LEAST", frequent[1])
    rows = {r["doc_id"]: words(r["text"]) for r in docs.collect()}
    places = {}
    for d in sorted(rows):
        for i in range(len(rows[d]) - 49):
            places.setdefault(tuple(rows[d][i : i + 50]), []).append((d, i))
    covered = {}
    for p in places.values():
        if len(p) > 1:
            for d, i in p:
                covered.setdefault(d, set()).update(range(i, i + 50))
    got = {}
    for r in substring.repeated_spans(docs).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
        assert r["n_words"] == r["end_word"] - r["start_word"] >= 50 and r["longest"] <= r["n_words"]
        first = places[tuple(rows[r["doc_id"]][r["start_word"] : r["start_word"] + 50])][0][0]
        assert r["first_doc_id"] == first
        w, longest = rows[r["doc_id"]], r["longest"]
        if longest > 50:
            assert longest % 50 == 0 and (longest // 50) & (longest // 50 - 1) == 0
    assert got == covered


def test_longest_repeats_match_brute_force(spark, docs):
    rnd = random.Random(19)
    texts = [["p%dx%d" % (i, k) for k in range(rnd.randrange(40))] for i in range(40)]
    for k in range(20):
        # Just one window of 100 or 200 words repeats.
        both = ["r%dx%d" % (k, i) for i in range(100 * (1 + k % 2))]
        texts[2 * k] += both
        texts[2 * k + 1] += [*both, "end%d" % k]
    df = spark.createDataFrame([(1000 + i, " ".join(x)) for i, x in enumerate(texts)], "doc_id bigint, text string").unionByName(docs.select("doc_id", "text"))
    rows, places = {r["doc_id"]: words(r["text"]) for r in df.collect()}, {}
    for d, w in rows.items():
        for length in (100, 200, 400, 800):
            for i in range(len(w) - length + 1 if d != 504 else 0):
                places.setdefault(tuple(w[i : i + length]), []).append((d, i))
    most = {}
    for window, at in places.items():
        for p in at if len(at) > 1 else []:
            most[p] = max(most.get(p, 0), len(window))
    got = [r for r in substring.repeated_spans(df).collect() if r["doc_id"] != 504]
    assert {r["longest"] for r in got} >= {50, 100, 200}
    for r in got:
        assert r["longest"] == max([50, *(most.get((r["doc_id"], i), 0) for i in range(r["start_word"], r["end_word"]))])


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_line_dedup(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "BROADCAST_LIMIT", limit)
    rows = [(i, f"Only here is text {i}\n  Everywhere \nin few" if i < 3 else f"Only here is text {i}\nEverywhere", "en", f"s{i}", 9) for i in range(12)]
    rows += [(20, None, "en", "s1", None), (21, "", "en", "s1", 0), (22, "Everywhere\nx", "en", None, 12), (5, rows[5][1], "en", "s5", 9), (23, "\n\n", "en", "s9", 2), (24, "Everywhere", "en", "s9", 2), (None, "Everywhere", "en", "s9", 2), (25, "Everywhere\ny", "en", "s9", 2), (26, "Everywhere\ny", "en", None, 2)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("h", F.lit(1)).withColumn("site", F.lit(2)).withColumn("owner", F.lit(2))
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert got[0]["text"] == rows[0][1] and got[0]["n_removed"] == 0
    assert got[1]["text"] == "Only here is text 1\nin few" and (got[1]["n_lines"], got[1]["n_removed"]) == (3, 1)
    assert got[20]["text"] is None and got[20]["n_lines"] == 0 and got[21]["text"] == "" and got[23]["text"] == "\n\n"
    assert got[22]["text"] == "x" and got[22]["n_removed"] == 1
    kept = {r["doc_id"]: r for r in line_dedup.apply(docs).collect()}
    assert set(kept) == {r[0] for r in rows} and kept[4]["text"] == "Only here is text 4" and kept[4]["n_chars"] == 19 and kept[0]["n_chars"] == 9
    assert line_dedup.apply(docs).count() == len(rows) and line_dedup.apply(docs).columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert got[24]["text"] == "" and got[None]["text"] == "Everywhere" and got[25]["text"] == got[26]["text"] == "y"
    whole = {r["doc_id"]: r["text"] for r in line_dedup.apply(docs, keep_copies=True).collect()}
    assert whole[25] == whole[26] == "Everywhere\ny" and whole[24] == "Everywhere" and whole[22] == "x" and whole[1] == "Only here is text 1\nin few"
    nine = spark.createDataFrame([r for r in rows if r[0] is not None and r[0] < 9], SCHEMA)
    assert sum(r["n_removed"] for r in line_dedup.dedup_lines(nine).collect()) == 0


def test_line_dedup_counts_exactly_near_the_threshold(spark):
    rows = [(100 * n + i, f"Own words of this one {n} {i}\nline {n}", "en", f"s{i}", 9) for n in range(7, 14) for i in range(n)]
    got = line_dedup.spread_lines(spark.createDataFrame(rows, SCHEMA), 10, 0.5).collect()
    assert sorted(r["owner"] for r in got) == [1000, 1100, 1200, 1300]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert jaccard.near_duplicates(none).count() == jaccard.jaccard_join(none).count() == 0
    assert substring.repeated_spans(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == line_dedup.apply(none).count() == 0

"""Secrets, quality rules, HTML, languages, decontamination, chats and BPE against planted cases, brute force and round trips."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lorgnette.llm import bpe, chat, decontaminate, html, langid, quality, secrets

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [(900, None, None, None, None), (901, "", "en", None, 0), (902, "x" * 50000, "en", "s0", 50000), (902, "x" * 50000, "en", "s0", 50000)]


def prose(rnd, n, vocab="the of and to a in is that for it tower river stone garden window winter summer walked under bright small green house people water letter morning".split()):
    return " ".join(rnd.choice(vocab) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(4)
    rows = [(i, "\n".join(prose(rnd, rnd.randrange(5, 60)) for _ in range(rnd.randrange(1, 8))), "en", f"s{i % 2}", 1) for i in range(260)]
    return spark.createDataFrame(rows + ODD, SCHEMA).withColumn("w", F.lit("clash")).withColumn("mu", F.lit(1)).withColumn("g", F.lit(1)).withColumn("n_tokens", F.lit(1))


def test_secrets_held_out(spark):
    rnd = random.Random(9)
    held_out = secrets.labelled_examples(12, seed=77)
    rows, want = [], set()
    for k, (name, examples) in enumerate(sorted(held_out.items())):
        for j, e in enumerate(examples):
            i = 100 * k + j
            rows.append((i, f"{prose(rnd, 20)} key={e}, {prose(rnd, 5)} see /usr/share/documentation/index.html 4199391714317852 incomprehensibilities {e}"))
            if name != "secret_access_key":
                want.add(i)
    rows += [(5000, None), (5001, ""), (5002, "ab" * 30000), (5003, "é" + held_out["hex_token"][0])]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit(1))).collect()
    found = {r["doc_id"] for r in got}
    assert len(want & found) >= 0.98 * len(want) and 5003 in found and not {5000, 5001, 5002} & found
    texts = {i: (t or "").encode() for i, t in rows}
    for r in got:
        secret = texts[r["doc_id"]][r["start_byte"] : r["start_byte"] + r["n_chars"]].decode()
        assert r["masked"][:4] == secret[:4] and not set(r["masked"][4:]) - {"*"}
        assert "html" not in secret and "incompre" not in secret and secret != "4199391714317852"


@pytest.mark.parametrize("glue", ["key=%s", "export SOME_SERVICE_API_KEY=%s", "https://maps.example.org/api/v2/json?key=%s&q=1", "path/to/%s/index.html", "client.auth.token.%s", "A=%s,"])
def test_secrets_glued_to_names(spark, glue):
    held_out = [e for k, x in secrets.labelled_examples(12, seed=78).items() if k != "secret_access_key" for e in x]
    rnd = random.Random(10)
    rows = [(i, f"{prose(rnd, 20)} {glue % e} {prose(rnd, 20)}") for i, e in enumerate(held_out)] + [(999, glue % "a.plain/name-of_things=without.any/secret")]
    found = {}
    for r in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        found.setdefault(r["doc_id"], []).append(rows[min(r["doc_id"], len(held_out))][1].encode()[r["start_byte"] :][: r["n_chars"]].decode())
    assert 999 not in found and all(len(x) == 1 for x in found.values())
    # Of a signed web token the first parts may be reported alone.
    right = [x == e or e.startswith("eyJ") and e.startswith(x) for e, (x,) in ((e, found.get(i, ["none"])) for i, e in enumerate(held_out))]
    assert sum(right) >= 0.95 * len(held_out)


def test_stretches_and_the_best_of_them():
    text = "ab=cde.fg/hi==_j kl"
    data = np.frombuffer(text.encode(), np.uint8)
    a, b = secrets.stretches(data, np.array([0, 17]), np.array([16, 19]), 2, 9)
    got = [text[x:y] for x, y in zip(a, b, strict=True)]
    assert got[:2] == ["ab=cde.fg/hi==_j", "kl"] and len(got) == len(set(got)) and {"ab", "cde", "cde.fg", "hi==_j", "=_j", "_j", "fg/hi"} <= set(got) and all(2 <= len(x) <= 9 for x in got[2:])
    best = secrets.apart(np.array([0, 3, 7, 3]), np.array([9, 6, 9, 5]), np.array([5.0, 20.0, 12.0, 20.0]), np.zeros(4, bool))
    assert best.tolist() == [1, 2]
    assert secrets.apart(np.array([0, 0]), np.array([9, 6]), np.array([5.0, 20.0]), np.array([True, False])).tolist() == [0]


def test_automaton_merges_compatible_states():
    a = secrets.Automaton(secrets.labelled_examples(150)["cloud_access_key"])
    before = len(a.next)
    a.merge()
    assert before > 1000 and len(a.states) < 12
    f = secrets.Formats({"k": ["ab" * n for n in (4, 5, 6)] * 50})
    sym = np.array([secrets.ALPHABET.index(c) for c in "ababababaaaaaaaa"], np.uint8)
    good, bad = f(sym, np.array([0, 8]), np.array([8, 8]))[0]
    assert good > bad + 5


def test_quality_matches_brute_force_and_rejects_junk(spark, docs):
    junk = [(i, " | ".join("xyz%%% ***" for _ in range(60)), "en", "s0", 1) for i in range(1000, 1010)]
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(junk, SCHEMA))
    kept = {r["doc_id"] for r in quality.accepted(docs).collect()}
    assert not kept & set(range(1000, 1010)) and len(kept & set(range(260))) >= 0.99 * 260 and {900, 901} <= kept
    applied = quality.apply(docs)
    assert applied.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r["doc_id"] for r in applied.collect()} == kept

    got = {r["doc_id"]: r["distance"] for r in quality.distances(docs).where("source = 's0'").collect()}
    rows = docs.where("source = 's0'").collect()
    want = plain_distances(plain_statistics([r["text"] or "" for r in rows]))
    for r, d in zip(rows, want, strict=True):
        assert abs(got[r["doc_id"]] - d) <= 1e-3 + 1e-2 * d


def plain_statistics(texts):
    """The statistics sign by sign."""
    rows = []
    for t in texts:
        words = re.findall(rb"[0-9a-z_\x80-\xff]+", "".join(c.lower() if c.isascii() else c for c in t).encode())
        data = "".join(c.lower() if c.isascii() else c for c in t).encode()
        space, letters = len(re.findall("[ \t\n\r]", t)), len(re.findall("[A-Za-z]|[^\x00-\x7f]", t))
        n, lines = len(words), t.count("\n") + 1
        rows.append([
            (n, 1), (len(set(words)), 1), (sum(map(len, words)) / max(n, 1), n), (sum(len(w) ** 2 for w in words) / max(n, 1), n), ((len(t) - space - letters) / max(len(t), 1), len(t)),
            (len(re.findall("[A-ZÀ-Þ]", t)) / max(letters, 1), letters), (-sum(data.count(b) / len(data) * math.log(data.count(b) / len(data)) for b in set(data)), len(data)), (n / lines, lines),
        ])
    drawn = lambda k, weight: [(r[k][0] * r[k][1] + np.median([math.floor(x[k][0] * 1e4 + 0.5) / 1e4 for x in rows]) * weight) / (r[k][1] + weight) for r in rows]
    length, square, marks, capitals, entropy, in_line = (drawn(k, w) for k, w in ((2, 100), (3, 100), (4, 600), (5, 600), (6, 600), (7, 3)))
    return np.array([
        [math.log(r[0][0] + 100) for r in rows], np.log(length), [math.log(max(q - m * m, 0.1)) / 2 for m, q in zip(length, square, strict=True)], np.log(np.add(marks, 0.002)),
        np.log(np.add(capitals, 0.002)), [math.log((r[1][0] + 100) / (r[0][0] + 100)) for r in rows], entropy, np.log(np.add(in_line, 1)),
    ]).T


def plain_distances(x):
    """The robust distances of one group in memory."""
    p = x.shape[1]
    q = np.quantile(np.sign(x) * np.floor(np.abs(x) * 1000 + 0.5) / 1000, [0.25, 0.5, 0.75], axis=0)
    x = (x - q[1]) / np.where(q[2] > q[0], (q[2] - q[0]) / 1.349, np.where(x.std(0) > 1e-9, x.std(0), 1))
    bins = lambda d: np.floor(np.log(d + 1e-9) * 40)
    nth = lambda b, share: np.sort(b)[int(np.ceil(share * len(b) - 1e-9)) - 1]

    def far(mu, cov):
        return np.einsum("ni,ij,nj->n", x - mu, np.linalg.inv(cov + 0.05 * np.eye(p)), x - mu)

    def step(mu, cov):
        b = bins(far(mu, cov))
        near = x[b <= nth(b, 0.75)]
        cov = np.cov(near.T, bias=True)
        return near.mean(0), cov, np.linalg.slogdet(cov + 0.05 * np.eye(p))[1]

    u = x / np.sqrt((x**2).sum(1, keepdims=True) + 1e-12)
    found = []
    for cov in (np.eye(p), np.corrcoef(np.tanh(x).T), u.T @ u / len(x) * p):
        now = (np.zeros(p), cov)
        for _ in range(2):
            *now, det = step(*now)
        found.append((det, now))
    det, (mu, cov) = min(found, key=lambda f: f[0])
    while True:
        *new, new_det = step(mu, cov)
        if new_det >= det - 1e-3:
            break
        (mu, cov), det = new, new_det

    def scaled(mu, cov):
        d = far(mu, cov)
        return d / (np.exp((nth(bins(d), 0.5) + 0.5) / 40) / quality.chi_square(p, 0.5))

    near = x[scaled(mu, cov) <= quality.chi_square(p, 0.025)]
    return scaled(near.mean(0), np.cov(near.T, bias=True))


def test_quality_takes_the_correlations_that_most_rows_have(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, quality.P)) @ rng.standard_normal((quality.P, quality.P))
    x[:60] = x[:60] * 0.1 + 30 * rng.standard_normal(quality.P)  # a distant clump that would draw the classical estimate
    rows = spark.createDataFrame([(i, "en", "s", *map(float, r)) for i, r in enumerate(x.round(6))], "doc_id bigint, lang string, source string, " + ", ".join(f"f{k} double" for k in range(quality.P)))
    hint = lambda df: df
    z = quality.scaled_statistics(rows.withColumn("g", F.lit("g")), hint)
    mu = np.array(quality.least_determinant(z, hint, 0.75).first()["mu"])
    zs = {r["doc_id"]: np.array([r[f"z{k}"] for k in range(quality.P)]) for r in z.collect()}
    inner = np.array([zs[i] for i in range(60, 400)])
    assert np.abs(mu - inner.mean(0)).max() < 0.4
    cov = np.cov(inner.T)
    clump = np.array([zs[i] for i in range(60)])
    assert np.median(np.einsum("ni,ij,nj->n", clump - mu, np.linalg.inv(cov), clump - mu)) > 100


def test_quality_small_groups(spark):
    few = spark.createDataFrame([(1, "a b c", "en", "x", 5), (2, None, None, None, None)], SCHEMA)
    assert {r["doc_id"]: r["distance"] for r in quality.distances(few).collect()} == {1: None, 2: None}
    assert quality.apply(few).count() == 2


def page(rnd, wild):
    text = lambda n: prose(rnd, n)
    links = "".join(f'<li><a href="/{k}">{text(2)}</a></li>' for k in range(6))
    body = "".join(f"<p>{text(40)}</p>" for _ in range(rnd.randrange(2, 6)))
    box, nav = ("div", "div") if wild else ("article", "nav")
    return f'<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body><{nav} class="menu"><ul>{links}</ul></{nav}><!-- x --><{box} class="story"><h1>{text(5)}</h1><p>{text(30)}<p>Caf&eacute; &amp; {text(30)}{body}</{box}><footer class="foot">&copy; <a href="/">{text(3)}</a></footer></body></html>'


def test_html_held_out_pages_without_regions(spark):
    rnd = random.Random(2)
    pages = [(i, page(rnd, False)) for i in range(120)] + [(i, page(rnd, True)) for i in range(200, 220)] + [(500, None), (501, ""), (502, "plain < text"), (503, "<p>" * 3000 + "deep"), (504, "</div><b>x")]
    df = spark.createDataFrame(pages, "page_id bigint, html string").withColumn("n_nodes", F.lit(1))
    got = {r["page_id"]: r for r in html.extract(df).collect()}
    assert len(got) == len(pages) and got[500]["text"] == got[501]["text"] == ""
    right = wrong = missed = 0
    for i, h in pages[120:140]:
        story = re.search(r'<div class="story">(.*?)</div><footer', h, re.S)[1]
        want = set(re.sub(r"<[^>]*>", " ", story).replace("&eacute;", "é").replace("&amp;", "&").split())
        have = set(got[i]["text"].split())
        right, wrong, missed = right + len(want & have), wrong + len(have - want), missed + len(want - have)
    assert right >= 0.95 * (right + wrong) and right >= 0.95 * (right + missed)
    assert html.extract(df.where("false")).count() == 0


def test_html_decode_is_consistent_and_best():
    rng = np.random.default_rng(1)
    nodes = html.parse("<div><p>a<b>b</b></p><ul><li>c<li>d</ul></div><p>e")
    index = {id(n): k for k, n in enumerate(nodes)}
    for _ in range(50):
        p = rng.random(len(nodes))
        kept = html.decode(nodes, p)
        best = -np.inf

        def options(k):
            below = [index[id(c)] for c in nodes[k].children]
            whole = [k, *(x for c in below for x in subtree(c))]
            yield {x: True for x in whole}, 0.0
            yield {x: False for x in whole}, 0.0
            parts = [({k: bool(p[k] >= 0.5)}, html.PRICE)]
            for c in below:
                parts = [({**a, **b}, x + y) for a, x in parts for b, y in options(c)]
            yield from parts

        def subtree(k):
            return [k, *(x for c in nodes[k].children for x in subtree(index[id(c)]))]

        value = lambda chosen: sum(np.log(p[k] if v else 1 - p[k]) for k, v in chosen.items())
        all_options = [(value(c) - price, c) for c, price in options(0)]
        best = max(v for v, _ in all_options)
        assert any(abs(v - best) < 1e-9 and all(c[k] == kept[k] for k in c) for v, c in all_options)


def test_boosting_learns():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    m = html.Boosted(x[:1500], y[:1500])
    assert ((m(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_languages_held_out(spark):
    rnd = random.Random(1)
    vocab = {"en": "the and that with from this water".split(), "de": "der und das mit von dieser wasser über".split(), "fr": "le et que avec pour cette été".split()}
    rows = [(i, prose(rnd, rnd.randrange(3, 80), vocab[k]), k if i % 4 else None, "s", 1) for i, k in ((i, rnd.choice(sorted(vocab))) for i in range(400))]
    truth = {r[0]: k for r in rows for k in vocab if set(r[1].lower().rstrip(".").split()) <= set(vocab[k])}
    got = langid.identify(spark.createDataFrame(rows + ODD, SCHEMA).withColumn("margin", F.lit(0))).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) + len(ODD) and by[900]["predicted"] is None and by[901]["predicted"] is None and by[901]["n_grams"] == 0
    held = [i for i in truth if i % 4 == 0]
    assert sum(by[i]["predicted"] == truth[i] for i in held) >= 0.98 * len(held)
    assert by[902]["n_grams"] == 3 * 50000 - 3
    nothing = langid.identify(spark.createDataFrame([(1, "abc", None, None, 3)], SCHEMA)).collect()
    assert nothing[0]["predicted"] is None
    assert langid.identify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_language_counts_match_brute_force():
    row, bucket, n = langid.gram_counts(["abca", "", "éé"], (1, 2), 1 << 16)
    totals = {k: n[row == k].tolist() for k in range(3)}
    assert sorted(totals[0]) == [1, 1, 1, 1, 1, 2] and totals[1] == [] and sorted(totals[2]) == [1, 2]


@pytest.fixture(scope="module")
def leaking(spark):
    rnd = random.Random(6)
    vocab = ["w%d" % k for k in range(3000)] + ["the", "of"] * 400
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(18, 45))) + ". " + " ".join(rnd.choice(vocab) for _ in range(4)) + ".") for i in range(40)]
    rows, want = [], set()
    for i in range(300):
        ws = [rnd.choice(vocab) for _ in range(rnd.choice([10, 200, 900]))]
        if i % 5 == 0:
            item = items[rnd.randrange(40)]
            planted = [w if rnd.random() > (0.15 if i % 10 else 0) else rnd.choice(vocab) for w in item[1].split()]
            at = rnd.randrange(len(ws))
            ws[at:at] = planted
            want.add((i, item[0]))
        rows.append((i, " ".join(ws), "en", "s", 1))
    bench = spark.createDataFrame(items + [(98, None), (99, "")], "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    return spark.createDataFrame(rows + ODD, SCHEMA).withColumn("item_id", F.lit(2)).withColumn("pos", F.lit(2)), bench, want


def test_decontamination_finds_planted_paraphrases(leaking):
    docs, bench, want = leaking
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 1
    kept = decontaminate.apply(docs, bench)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r["doc_id"] for r in kept.collect()} == {r[0] for r in docs.select("doc_id").collect()} - {d for d, _ in got}


def test_decontamination_finds_long_items(spark):
    rnd = random.Random(8)
    vocab = ["w%d" % k for k in range(6000)]
    draw = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(draw(n - 5)) + ". " + " ".join(draw(5)) + ".") for i, n in enumerate([40, 64, 65, 100, 180, 230, 320, 700, 1500])]
    rows, want = [], set()
    for k, (i, text) in enumerate(items * 4):
        ws, planted = draw(rnd.randrange(100, 900)), text.split()
        if k >= len(items):
            planted = [w if rnd.random() > 0.15 else rnd.choice(vocab) for w in planted]
        at = rnd.randrange(len(ws))
        ws[at:at] = planted
        rows.append((k, " ".join(ws)))
        want.add((k, i))
    # A third of an item is no leak of it.
    rows += [(100 + i, " ".join(draw(200) + t.split()[: len(t.split()) // 3] + draw(200))) for i, t in items]
    rows += [(200 + k, " ".join(draw(300))) for k in range(60)]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == want


def test_decontamination_counts_terms_that_an_item_repeats(spark):
    rnd = random.Random(3)
    own = ["t%d" % k for k in range(12)]
    item = ["again"] * 20 + own
    rows = [(1, " ".join(["again"] * 20 + own[:2] + ["x%d" % k for k in range(9)] + own[-1:]))] + [(k, " ".join("v%d" % rnd.randrange(500) for _ in range(80))) for k in range(2, 80)]
    bench = spark.createDataFrame([(7, " ".join(item[:-1]) + ". " + item[-1])], "item_id bigint, text string")
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()
    assert [(r["doc_id"], r["item_id"], r["common"]) for r in got] == [(1, 7, round(23 / 32, 4))]


def test_decontamination_empty(leaking):
    docs, bench, _ = leaking
    assert decontaminate.leaks(docs.where("false"), bench).count() == 0
    assert decontaminate.leaks(docs, bench.where("false")).count() == 0 == decontaminate.leaks(docs, bench.where("item_id > 90")).count()


def test_common_subsequence_and_svd():
    rnd = random.Random(3)
    for _ in range(100):
        a, b = [rnd.randrange(5) for _ in range(rnd.randrange(1, 12))], [rnd.randrange(5) for _ in range(rnd.randrange(15))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.common_subsequence(decontaminate.bits(a), len(a), b) == t[-1][-1]


def test_latent_space_matches_svd(spark):
    rng = np.random.default_rng(5)
    topics = rng.random((6, 60)) ** 6
    rows = [(d, [int(x) for x in range(0, 320, 2)], [int(rng.choice(60, p=topics[d % 6] / topics[d % 6].sum())) for _ in range(160)]) for d in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, pos array<int>, term array<int>")
    idf = np.ones(60)
    space = decontaminate.latent_space(df, idf, 5, 20)
    m = []
    for _, pos, term in rows:
        p, t = decontaminate.passages(np.array(pos), np.array(term))
        for k in sorted(set(p.tolist())):
            r, tt, w = decontaminate.weighted(np.zeros((p == k).sum(), int), t[p == k], idf, 60)
            v = np.zeros(60)
            v[tt] = w
            m.append(v)
    m = np.array(m)
    s = np.linalg.svd(m, compute_uv=False)
    assert np.allclose(space.T @ space, np.eye(5), atol=1e-6)
    assert np.linalg.norm(m @ space) ** 2 >= 0.99 * (s[:5] ** 2).sum()


def test_chats_round_trip(spark):
    rows = [
        (1, 0, "user", "plain"), (1, 1, "assistant", "has <|im_end|>\n in it"), (1, 2, "user", "ends <|im_end|>"), (1, 2, "user", "ends <|im_end|>"),
        (2, 0, "sys\ntem\\", "<|im_start|>user\nhi<|im_end|>\n"), (2, 1, None, None), (2, 2, "a<|b", "<\\|x <\\\\| <|y|>"), (3, None, "user", ""), (None, 0, "user", "x" * 50000), (4, 0, "user", "<|im_start|>"), (4, 1, "<|im_end|>", "<"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1))
    got = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert len(got) == 5 and all(r["round_trip"] for r in got.values()) and got[1]["n_turns"] == 4 and got[1]["n_escaped"] == 1 and got[3]["text"] == "<|im_start|>user\n<|im_end|>\n"
    for k, r in got.items():
        want = sorted((t, role or "", text or "") for c, t, role, text in rows if c == k) if k != 3 else [(None, "user", "")]
        assert chat.parse(r["text"]) == [(a, b) for _, a, b in want]
    assert chat.format_chats(df.where("false")).count() == 0
    assert chat.parse("junk") is None and chat.parse("<|im_start|>user") is None


def test_chat_sql_matches_on_conflicts(spark):
    import duckdb

    rnd = random.Random(8)
    bits = ["<|im_start|>", "<|im_end|>", "\n", "<", "|", "\\", "a", "<\\|", " "]
    rows = [(i // 4, i % 4, rnd.choice(["user", "a\nb", "c\\", "<|"]), "".join(rnd.choice(bits) for _ in range(rnd.randrange(8)))) for i in range(800)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    conversations = df.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("conversations", conversations)
    cols = ["conv_id", "n_turns", "n_escaped", "text", "round_trip"]
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({chat.CHAT_SQL})").fetchall())
    assert sorted(tuple(r) for r in chat.format_chats(df).select(*cols).collect()) == want


def test_bpe_matches_public_encoder_and_round_trips(spark):
    import tiktoken

    v = bpe.Vocabulary.read(bpe.VOCABULARY)
    enc = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    rnd = random.Random(2)
    texts = ["", "a" * 3000, "日本語 🙂🙂 naïve", "  \n\n x  \t", "don't we'll", "aaaa aaaaa aaa", "<|endoftext|>", None] + ["".join(rnd.choice("ab cdé\n.1") for _ in range(rnd.randrange(1, 200))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, "")], "doc_id bigint, text string").withColumn("tokens", F.lit(1))
    got = bpe.encode_documents(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        t = texts[r["doc_id"]]
        assert (r["tokens"] is None and not r["round_trip"] and r["n_tokens"] == 0) if t is None else (r["tokens"] == enc.encode_ordinary(t) and r["round_trip"] and r["n_tokens"] == len(r["tokens"]))
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(spark.createDataFrame(got)).collect()}
    assert back == dict(enumerate(texts))
    assert bpe.encode_documents(df.where("false")).count() == 0


def test_secrets_empty(spark):
    assert secrets.scan(spark.createDataFrame([], SCHEMA)).count() == 0

"""The pipeline on a small corpus with planted cases, against the stages done by brute force."""

import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from lorgnette.llm import bpe, jaccard, line_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
FOOTER = "Printed with the kind leave of the owners of this site."


def words(text):
    return re.findall(rb"[0-9a-z_\x80-\xff]+", (text or "").lower().encode())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(12)
    vocab = ["w" + "".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randrange(2, 7))) for _ in range(4000)]
    line = lambda n: " ".join(rnd.choice(vocab) for _ in range(n)).capitalize() + "."
    rows = [(i, "\n".join(line(rnd.randrange(8, 30)) for _ in range(rnd.randrange(3, 9))), "en", f"s{i % 14}", 1) for i in range(280)]
    rows = [(i, t + "\n" + FOOTER if i % 3 == 0 else t, *r) for i, t, *r in rows]
    items = [(k, line(30) + " " + line(6)) for k in range(12)]
    leaks = {i: items[i % 12][1] for i in range(3, 120, 13)}
    rows = [(i, t + "\n" + leaks[i] if i in leaks else t, *r) for i, t, *r in rows]
    junk = [(1000 + i, " | ".join("zz%%% ***" for _ in range(80)), "en", "s1", 1) for i in range(6)]
    near = []
    for k, i in enumerate(range(121, 181, 6)):
        ws = rows[i][1].split(" ")
        ws[len(ws) // 2] = "changed"
        near.append((2000 + k, " ".join(ws) if k % 2 else rows[i][1], "en", "s2", 1))
    odd = [(3000, None, None, None, None), (3001, "", "en", None, 0), (3002, "w " * 20000, "de", "s0", 1), (3000, None, None, None, None)]
    docs = rows + junk + near + odd
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, leaks, {r[0] for r in junk}


def test_stages_and_run(spark, folder):
    path, docs, leaks, junk = folder
    read, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        read = stage(spark, read.withColumn("extra", F.lit(1)), path)
        if name != "bpe_encoding":
            assert read.columns == COLUMNS
        read.write.parquet(f"{path}/{name}")
        read = spark.read.parquet(f"{path}/{name}")
        kept[name] = [r.asDict() for r in read.collect()]

    # Quality: the junk goes and all but a few of the clean ones stay.
    after = {r["doc_id"] for r in kept["quality_rules"]}
    clean = {d[0] for d in docs} - junk
    assert not after & junk and len(after & clean) >= 0.97 * len(clean)

    # Lines on many sites stay in the lowest document, or in documents of which there are copies.
    before = kept["quality_rules"]
    sites, owner = {}, {}
    for r in before:
        for x in set((r["text"] or "").split("\n")):
            if x.strip(" "):
                sites.setdefault(x.strip(" "), set()).add(r["source"])
                owner[x.strip(" ")] = min(owner.get(x.strip(" "), 1 << 60), r["doc_id"])
    want, same = [], {}
    for r in before:
        same.setdefault(r["text"], set()).add(r["doc_id"])
    for r in before:
        t = r["text"]
        if t is not None and len(same[t]) == 1:
            ls = [x for x in t.split("\n") if not (x.strip(" ") and len(sites[x.strip(" ")] - {None}) >= line_dedup.MIN_SITES and r["doc_id"] > owner[x.strip(" ")])]
            t = "\n".join(ls)
        want.append((r["doc_id"], t or ""))
    got = kept["line_dedup"]
    assert sorted(want) == sorted((r["doc_id"], r["text"] or "") for r in got) and sum(FOOTER in (r["text"] or "") for r in got) == 1

    # Near duplicates: one of each connected group stays, that with the lowest id.
    sets = {r["doc_id"]: {tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} for r in got if (w := words(r["text"]))}
    gone = set()
    for a in sorted(sets):
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b]):
                gone.add(b)
    assert {r["doc_id"] for r in kept["ngram_jaccard_join"]} == {r["doc_id"] for r in got} - gone

    # Leaks: the documents with planted items go, and no other.
    held = kept["ngram_jaccard_join"]
    assert {r["doc_id"] for r in kept["benchmark_decontamination"]} == {r["doc_id"] for r in held} - set(leaks)

    enc = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.Vocabulary.read(bpe.VOCABULARY).ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in kept["benchmark_decontamination"]}
    for r in kept["bpe_encoding"]:
        t = texts[r["doc_id"]]
        assert r["tokens"] == (None if t is None else enc.encode_ordinary(t))

    whole = corpus_pipeline.run(spark, path).toPandas().sort_values("doc_id").reset_index(drop=True)
    parts = pd.DataFrame(kept["bpe_encoding"]).sort_values("doc_id").reset_index(drop=True)
    assert whole["doc_id"].tolist() == parts["doc_id"].tolist() and whole["n_tokens"].tolist() == parts["n_tokens"].tolist()


def test_near_duplicates_go_that_share_nothing_in_some_parts(spark):
    reader, rows = jaccard.Words(), []
    part = lambda ws: int(jaccard.gram_sets(reader, pa.array([" ".join(ws)]), 3)[0][0] >> np.uint64(40)) % 32
    for k in range(10):
        # Of 300 n-grams each, 200 are shared.
        both = ["s%d" % k, "t%d" % k]
        while len(both) < 202:
            both.append(next(w for i in range(99) if part([*both[-2:], w := "w%dx%dx%d" % (k, len(both), i)]) >= 4))
        rows += [(2 * k + j, " ".join(both + ["o%dx%dx%d" % (k, j, i) for i in range(100)]), "en", "s", 1) for j in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(0, 20, 2))


def test_stages_on_an_empty_table(spark, folder, tmp_path):
    path = folder[0]
    docs = spark.read.parquet(f"{path}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        assert out.count() == 0, name
        docs = docs if name == "bpe_encoding" else out

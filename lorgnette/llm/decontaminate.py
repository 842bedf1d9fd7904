"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of ``2 * STRIDE`` words that overlap by half. Passages and benchmark items are TF-IDF vectors
over the benchmark's own terms (no other term can be shared), without terms found in over ``STOP`` of all passages. A
randomised SVD of all passages' vectors, by two distributed products with their Gram matrix and a Nystrom step, gives the
latent space. Items longer than a passage are cut into parts of up to ``PART`` words. Every passage is compared with
every part there; a cosine over ``threshold`` makes a candidate, which is a leak if the longest common subsequence of the
whole item's terms and the passage with its surroundings, as far as the item reaches from the part to either side and a
quarter more, holds ``VERBATIM`` of the item, or ``PARAPHRASE`` of it and half of the terms of the item's answer, which is
its last sentence. The threshold is set so that of mock paraphrases, parts with words changed in the midst of other items'
words, 98 % would be candidates.

The benchmark is a stated set of queries, taken in blocks of about ``BENCHMARK_BYTES`` of text: a block's terms, its SVD's
factors and its items are held by the driver and broadcast. Whatever grows with the corpus stays distributed.

Defined results: null and empty texts have no passages; an item with no terms, null or empty, has no leaks; an empty
benchmark or corpus gives no rows; items of equal text are all reported; rows that share a ``doc_id`` are reported once, with the greatest of each figure;
texts and items of any length are compared whole. Only ``doc_id`` and ``text`` (and ``item_id`` and ``text`` of the benchmark) are read.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorgnette.llm.common import Words, chunks, cut, held, small

STRIDE, STOP, MIN_TERMS, PART = 32, 0.05, 6, 48
RANK, OVERSAMPLE = 96, 16
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.5
BLOCK = 512
#: Passages that are worked on at once, and bytes of benchmark text whose model a task holds.
PASSAGES, BENCHMARK_BYTES = 8192, 4 << 20


class Items:
    """The benchmark's items as sequences of term numbers."""

    def __init__(self, rows: list[tuple[int, str]]):
        words = Words()
        low = [(t or "").lower() for _, t in rows]
        h, off = words(pa.array(low, pa.string()))
        self.ids = [i for i, _ in rows]
        self.vocabulary = np.unique(h)
        self.terms = [np.searchsorted(self.vocabulary, h[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
        last = [next((s for s in reversed(re.split(r"[.!?\n]+", t)) if s.strip()), "") for t in low]
        h, off = words(pa.array(last, pa.string()))
        self.answers = [np.searchsorted(self.vocabulary, h[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def numbered(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words in the vocabulary, and their terms."""
        at = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.vocabulary, h[at]), len(self.vocabulary) - 1)
        known = self.vocabulary[term] == h[at]
        return at[known], term[known]


def weighted(row: np.ndarray, term: np.ndarray, idf: np.ndarray, n_terms: int):
    """Sparse TF-IDF rows of unit length: (row, term, weight), sorted by row."""
    key, tf = np.unique(row.astype(np.int64) * n_terms + term, return_counts=True)
    row, term = key // n_terms, key % n_terms
    w = (1 + np.log(tf)) * idf[term]
    norm = np.sqrt(np.bincount(row, w * w))
    return row, term, w / np.maximum(norm[row], 1e-12)


def passages(pos: np.ndarray, term: np.ndarray):
    """(passage, term) of a text's terms: passage p has the words from ``p * STRIDE``, two strides long."""
    p = pos // STRIDE
    return np.concatenate([p, p[p > 0] - 1]), np.concatenate([term, term[p > 0]])


def batch_passages(batch: pa.RecordBatch):
    """(row, term, first, document) of all passages of a batch of (doc_id, pos, term) lists; rows are numbered from 0."""
    pos, term = batch.column("pos"), batch.column("term")
    n = np.diff(pos.offsets.to_numpy())
    doc = np.repeat(np.arange(len(n)), n)
    p = pos.flatten().to_numpy().astype(np.int64) // STRIDE
    t = term.flatten().to_numpy().astype(np.int64)
    key = np.concatenate([doc << 32 | p, (doc << 32 | p)[p > 0] - 1])
    names, row = np.unique(key, return_inverse=True)
    return row, np.concatenate([t, t[p > 0]]), names & 0xFFFFFFFF, names >> 32


def summed(at: np.ndarray, source: np.ndarray, take: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of the sorted ``at``, and for each the sum of its ``source[take] * w``."""
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(first, len(at)))
    # Layer by layer, the k-th of every group at once, with the groups in falling order of size.
    order = np.argsort(-count, kind="stable")
    begin, w = first[order], w.astype(source.dtype)[:, None]
    alive = np.searchsorted(-count[order], -np.arange(int(count.max())), "left")
    out = source[take[begin]] * w[begin]
    for k, m in enumerate(alive.tolist()):
        if k:
            i = begin[:m] + k
            out[:m] += source[take[i]] * w[i]
    return at[begin], out


def projected(row, term, w, matrix: np.ndarray, n_rows: int) -> np.ndarray:
    """Sparse rows, in order, times ``matrix``."""
    out = np.zeros((n_rows, matrix.shape[1]), np.float32)
    if len(row):
        at, values = summed(row, matrix, term, w)
        out[at] = values
    return out


def cuts(n_words: int) -> list[int]:
    """Where the parts of an item begin, and its end: one part of what fits in a passage, else equal ones."""
    n = 1 if n_words <= 2 * STRIDE else -(-n_words // PART)
    return [n_words * k // n for k in range(n + 1)]


def reach(n_words: int, at: int) -> tuple[int, int]:
    """How many words before and after its first one a passage is searched for an item, of which the part from ``at`` is in it."""
    if n_words <= 2 * STRIDE:
        return STRIDE, 3 * STRIDE
    slack = n_words // 4 + STRIDE
    return at + slack, n_words - at + STRIDE + slack


def surroundings(batch: pa.RecordBatch, first: np.ndarray, doc: np.ndarray, n_terms: int) -> np.ndarray:
    """A table of which terms stand in each of some passages, in order, or a stride before or after it; one column more is empty."""
    pos, term = batch.column("pos"), batch.column("term")
    own = np.repeat(np.arange(batch.num_rows), np.diff(pos.offsets.to_numpy()))
    block, term = pos.flatten().to_numpy() // STRIDE, term.flatten().to_numpy()
    names, out = doc << 32 | first, np.zeros((len(first), n_terms + 1), np.uint8)
    for shift in (1, 0, -1, -2):
        ok = block + shift >= 0
        key = own[ok] << 32 | (block[ok] + shift)
        row = np.minimum(np.searchsorted(names, key), len(names) - 1)
        there = names[row] == key
        out[row[there], term[ok][there]] = 1
    return out


def slices(batches, rows: int = 200):
    """Slices of up to ``rows`` documents and ``PASSAGES`` passages, one document at least."""
    for b in batches:
        pos = b.column("pos")
        off = pos.offsets.to_numpy() - pos.offsets[0].as_py()
        last = pos.flatten().to_numpy()[np.maximum(off[1:] - 1, 0)] if off[-1] else np.zeros(b.num_rows, np.int64)
        up = np.concatenate([[0], np.cumsum(last.astype(np.int64) // STRIDE + 1)])
        at = 0
        while at < b.num_rows:
            to = min(at + rows, max(at + 1, int(np.searchsorted(up, up[at] + PASSAGES, "right")) - 1))
            yield b.slice(at, to - at)
            at = to


def gram_product(compact: DataFrame, idf: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """A'A times ``matrix``, A the rows of all passages: partial sums in tasks, added up by blocks of rows."""
    sc = compact.sparkSession.sparkContext
    shared = sc.broadcast((idf, matrix.astype(np.float32)))

    def partial(batches):
        idf, m = shared.value
        total = np.zeros((len(idf), m.shape[1]))
        for batch in slices(batches):
            row, term, first, _ = batch_passages(batch)
            if len(row):
                row, term, w = weighted(row, term, idf, len(idf))
                y = projected(row, term, w, m, len(first))
                order = np.argsort(term, kind="stable")
                at, values = summed(term[order], y, row[order], w[order])
                total[at] += values
        for b in range(0, len(idf), BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([b // BLOCK], pa.int32()), pa.array([total[b : b + BLOCK].tobytes()])], ["block", "part"])

    def added(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, part in zip(batch.column("block").to_pylist(), batch.column("part"), strict=True):
                x = np.frombuffer(part.as_buffer(), np.float64)
                sums[b] = sums[b] + x if b in sums else x.copy()
        for b, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([x.tobytes()])], ["block", "part"])

    parts = compact.mapInArrow(partial, "block int, part binary").repartition("block").mapInArrow(added, "block int, part binary").collect()
    parts.sort(key=lambda r: r["block"])
    return np.concatenate([np.frombuffer(r["part"], np.float64) for r in parts]).reshape(-1, matrix.shape[1]) if parts else np.zeros((len(idf), matrix.shape[1]))


def latent_space(compact: DataFrame, idf: np.ndarray, rank: int = RANK, oversample: int = OVERSAMPLE) -> np.ndarray:
    """The leading right singular vectors of the passages' matrix, a column for each, by randomised SVD."""
    k = min(rank + oversample, len(idf))
    start = np.random.default_rng(7).standard_normal((len(idf), k))
    q, _ = np.linalg.qr(gram_product(compact, idf, start))
    z = gram_product(compact, idf, q)
    core = q.T @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max(initial=0) * 1e-9
    if not good.any():
        return np.zeros((len(idf), 1))
    u, _, _ = np.linalg.svd(z @ vectors[:, good] / np.sqrt(values[good]), full_matrices=False)
    return u[:, :rank]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def common_subsequence(masks: dict[int, int], n: int, sequence) -> int:
    """Length of the longest common subsequence of an item of ``n`` terms, given by their places' bits, and a sequence."""
    full = (1 << n) - 1
    v = full
    for t in sequence:
        u = v & masks.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def bits(item) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, t in enumerate(item):
        out[int(t)] = out.get(int(t), 0) | 1 << k
    return out


def calibrated(items: list[np.ndarray], idf: np.ndarray, space: np.ndarray, latent: np.ndarray, recall: float = 0.98) -> float:
    """The cosine that ``recall`` of mock paraphrases reach: a quarter of the terms changed, a passage's worth around."""
    rng = np.random.default_rng(11)
    pool = np.concatenate([i for i in items if len(i)])
    scores = []
    for k, item in enumerate(items):
        for _ in range(4 if len(item) else 0):
            kept = item[rng.random(len(item)) > 0.25]
            noise = rng.choice(pool, max(len(item) - len(kept), 0) + STRIDE // 2)
            t = np.concatenate([kept, noise])
            row, term, w = weighted(np.zeros(len(t), np.int64), t, idf, len(idf))
            scores.append(float(unit(projected(row, term, w, space.astype(np.float32), 1))[0] @ latent[k]))
    return float(np.quantile(scores, 1 - recall)) if scores else 1.0


def leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer) of every benchmark item found in a document."""
    items = benchmark.select("item_id", "text")
    n = math.ceil((items.agg(F.sum(F.length("text"))).first()[0] or 0) / BENCHMARK_BYTES)
    found = [leaks_of(docs, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items, rank) for k in range(max(n, 1))]
    best = [F.round(F.max(c), 4).alias(c) for c in ("cosine", "common", "answer")]
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(*best)


def leaks_of(docs: DataFrame, benchmark: DataFrame, rank: int) -> DataFrame:
    """What is found of a benchmark of about ``BENCHMARK_BYTES``, by passages."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    schema = "doc_id bigint, item_id bigint, cosine double, common double, answer double"
    # Bounded by BENCHMARK_BYTES.
    items = Items([(r["item_id"], r["text"]) for r in benchmark.select("item_id", "text").orderBy("item_id", "text").collect()])
    n_terms = len(items.vocabulary)
    if not n_terms:
        return spark.createDataFrame([], schema)
    shared = held(sc, items)

    def frequencies(batches):
        words, it = Words(), shared()
        df, total = np.zeros(n_terms, np.int64), 0
        for batch in chunks(batches, "text"):
            h, off = words(batch.column("text"))
            at, term = it.numbered(h)
            doc = np.searchsorted(off, at, "right") - 1
            block = (at - off[doc]) // (2 * STRIDE)
            pairs = np.unique(((doc << 24 | block) * n_terms) + term)
            df += np.bincount(pairs % n_terms, minlength=n_terms)
            total += int((-(-np.diff(off) // (2 * STRIDE))).sum())
        keep = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(keep, -1).astype(np.int32)), pa.array(np.append(df[keep], total))], ["term", "n"])

    # One row for each term of the benchmark.
    counts = {r["term"]: r["n"] for r in texts.select("text").mapInArrow(frequencies, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    total = counts.pop(-1, 0)
    df = np.zeros(n_terms)
    df[list(counts)] = list(counts.values())
    informative = df <= STOP * total
    for t in items.terms:
        rare = np.unique(t)[np.argsort(df[np.unique(t)], kind="stable")]
        if informative[rare].sum() < MIN_TERMS:
            informative[rare[:MIN_TERMS]] = True
    number = np.cumsum(informative) - 1
    idf = np.log((total + 1) / (df[informative] + 1)) + 0.01
    item_terms = [number[t[informative[t]]] for t in items.terms]
    parts = [(k, a, b, len(t)) for k, t in enumerate(items.terms) for a, b in zip(cuts(len(t))[:-1], cuts(len(t))[1:], strict=True)]
    part_terms = [number[t[informative[t]]] for t in (items.terms[k][a:b] for k, a, b, _ in parts)]
    part_item, part_reach = np.array([k for k, *_ in parts]), [reach(n, a) for _, a, _, n in parts]
    answers = [np.unique(number[t[informative[t]]]) for t in items.answers]
    chosen = sc.broadcast((informative, number.astype(np.int32)))

    def compacted(batches):
        words, it = Words(), shared()
        informative, number = chosen.value
        for batch in chunks(batches, "text"):
            h, off = words(batch.column("text"))
            at, term = it.numbered(h)
            at, term = at[informative[term]], term[informative[term]]
            doc = np.searchsorted(off, at, "right") - 1
            ends = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32))
            pos, term = pa.array((at - off[doc]).astype(np.int32)), pa.array(number[term])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(ends, pos), pa.ListArray.from_arrays(ends, term)], ["doc_id", "pos", "term"])

    compact = cut(texts.mapInArrow(compacted, "doc_id bigint, pos array<int>, term array<int>").where(F.size("pos") > 0))
    space = latent_space(compact, idf, rank)
    rows, terms, w = weighted(np.repeat(np.arange(len(part_terms)), [len(t) for t in part_terms]), np.concatenate(part_terms), idf, len(idf))
    latent = unit(projected(rows, terms, w, space.astype(np.float32), len(part_terms)))
    threshold = calibrated(part_terms, idf, space, latent)
    is_long = np.array([len(t) > 2 * STRIDE for t in items.terms])
    short = [t[:0] if x else t for t, x in zip(item_terms, is_long, strict=True)]
    padded = np.full((len(short), max(1, *map(len, short))), len(idf))  # the last column of a table of terms is empty
    for k, t in enumerate(short):
        padded[k, : len(t)] = t
    least = np.array([max(1, math.ceil(PARAPHRASE * len(t) - 1e-9)) for t in item_terms])
    model = sc.broadcast((idf, space.astype(np.float32), latent, [bits(t) for t in item_terms], [len(t) for t in item_terms], [set(a.tolist()) for a in answers], items.ids, threshold, padded, least, is_long, part_item, part_reach))

    def search(batches):
        idf, space, latent, masks, sizes, answers, ids, threshold, padded, least, is_long, part_item, part_reach = model.value
        out = []
        for batch in slices(batches):
            row, term, first, doc = batch_passages(batch)
            if not len(row):
                continue
            r, t, w = weighted(row, term, idf, len(idf))
            y, where, part, cos = unit(projected(r, t, w, space, len(first))), [], [], []
            for at in range(0, len(first), PASSAGES):
                block = y[at : at + PASSAGES] @ latent.T
                a, b = np.nonzero(block >= threshold)
                where.append(a + at)
                part.append(b)
                cos.append(block[a, b])
            where, part, cos = np.concatenate(where), np.concatenate(part), np.concatenate(cos)
            # A common subsequence is no longer than the item's terms that are there, which are counted first.
            some, at = np.unique(where, return_inverse=True)
            enough = is_long[part_item[part]]
            brief = np.flatnonzero(~enough)
            if len(brief):
                here = surroundings(batch, first[some], doc[some], len(idf))
                enough[brief] = here[at[brief, None], padded[part_item[part[brief]]]].sum(1) >= least[part_item[part[brief]]]
            where, part, cos = where[enough], part[enough], cos[enough]
            pos, terms = batch.column("pos"), batch.column("term")
            off, pos, terms = pos.offsets.to_numpy(), pos.flatten().to_numpy(), terms.flatten().to_numpy()
            off = off - off[0]
            last, sequence, found_here = None, [], set()
            for p, k, near in zip(where.tolist(), part.tolist(), cos.tolist(), strict=True):
                i, (before, after) = int(part_item[k]), part_reach[k]
                d, begin = int(doc[p]), int(first[p]) * STRIDE
                if last != (d, begin - before, begin + after):
                    last = (d, begin - before, begin + after)
                    a, b = np.searchsorted(pos[off[d] : off[d + 1]], last[1:])
                    sequence = terms[off[d] + a : off[d] + b].tolist()
                    found_here = set(sequence)
                n = sizes[i]
                if is_long[i] and sum(masks[i][t].bit_count() for t in found_here if t in masks[i]) < least[i]:
                    continue
                share = common_subsequence(masks[i], n, sequence) / n
                answer = sum(1 for x in answers[i] if x in found_here) / len(answers[i]) if answers[i] else 1.0
                if share >= VERBATIM or share >= PARAPHRASE and answer >= ANSWER:
                    out.append({"doc_id": batch.column("doc_id")[d].as_py(), "item_id": ids[i], "cosine": near, "common": share, "answer": answer})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), *((c, pa.float64()) for c in ("cosine", "common", "answer"))]))

    return compact.mapInArrow(search, schema)


def apply(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with their columns, without those that hold a benchmark item."""
    gone = cut(leaks(docs, benchmark).select(F.col("doc_id").alias("id")).distinct())
    kept = docs.join(small(gone, gone.count(), 16), docs["doc_id"] == gone["id"], "left_anti")
    return kept.select("doc_id", "text", "lang", "source", "n_chars")

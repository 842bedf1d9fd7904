"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded sample of labelled rows (``rows_per_lang``, chosen by a hash of ``doc_id``). The
log-probability matrix is broadcast, and each batch of texts is scored as a sparse matrix of n-gram counts in numpy.
Every text is read whole.

Defined results: a null or empty text has no n-grams and null ``predicted`` and ``margin``, and so has every row if no
label has rows; an empty table gives no rows; a tie goes to the language first in the alphabet; repeated rows give repeated results; rows with a null
label aren't trained on but are scored. Only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorgnette.llm.common import chunks, mix

ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
ROWS_PER_LANG = 2000
#: Texts that are counted at once.
ROWS = 256


def gram_counts(texts: list[str], orders=ORDERS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A sparse matrix: (row, bucket, count) of the hashed character n-grams of each lower-cased text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    keys = []
    for n in orders:
        if len(codes) < n:
            break
        gram = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            gram = (gram << np.uint64(21)) ^ codes[k : len(codes) - n + 1 + k] ^ (gram >> np.uint64(43))
        inside = row[: len(gram)] == row[n - 1 :]
        bucket = (mix(gram) % np.uint64(buckets)).astype(np.int64)
        keys.append((row[: len(gram)] * buckets + bucket)[inside])
    if not keys:
        return (np.zeros(0, np.int64),) * 3
    keys = np.concatenate(keys)
    if len(texts) * buckets > 8 * len(keys):  # mostly empty: a table of all cells would be far larger than the texts
        at, counts = np.unique(keys, return_counts=True)
        return at // buckets, at % buckets, counts
    counts = np.bincount(keys)
    at = np.flatnonzero(counts)
    return at // buckets, at % buckets, counts[at]


def train(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG, orders=ORDERS, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """The languages and their log-probability matrix, prior in the last column, from about ``rows_per_lang`` rows each."""
    labelled = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & (F.coalesce(F.col("text"), F.lit("")) != ""))
    # The label alone decides how many rows there are; the texts aren't read for this.
    totals = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(totals)
    if not langs:
        return [], np.zeros((0, buckets + 1))
    rate = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, rows_per_lang / n))) for k, n in totals.items()])
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20))

    def count(batches):
        total = np.zeros((len(langs), buckets), np.int64)
        for batch in chunks(batches, "text", rows=ROWS):
            which = np.array([langs.index(x) for x in batch.column("lang").to_pylist()])
            row, bucket, n = gram_counts([t.lower() for t in batch.column("text").to_pylist()], orders, buckets)
            total += np.bincount(which[row] * buckets + bucket, n, total.size).astype(np.int64).reshape(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["counts"])

    # The sample is bounded, so a few partial matrices hold its counts.
    parts = chosen.select("lang", "text").repartition(6).mapInArrow(count, "counts binary").collect()
    counts = sum(np.frombuffer(p["counts"], np.int64).reshape(len(langs), buckets) for p in parts)
    logp = np.log((counts + 0.1) / (counts.sum(1, keepdims=True) + 0.1 * buckets))
    prior = np.log(np.array([[totals[k]] for k in langs]) / sum(totals.values()))
    return langs, np.hstack([logp, prior])


def identify(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG, orders=ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, lang, predicted, margin, n_grams): margin is the log-odds per n-gram over the next likeliest language."""
    langs, matrix = train(docs, rows_per_lang, orders, buckets)
    model = docs.sparkSession.sparkContext.broadcast(matrix)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches):
        logp = model.value
        for batch in chunks(batches, "text", rows=ROWS):
            texts = [(t or "").lower() for t in batch.column("text").to_pylist()]
            row, bucket, n = gram_counts(texts, orders, buckets)
            grams = np.bincount(row, n, len(texts))
            predicted, margin = [None] * len(texts), [None] * len(texts)
            if langs:
                scores = np.stack([np.bincount(row, n * logp[k][bucket], len(texts)) + logp[k, -1] for k in range(len(langs))])
                best = scores.argmax(0)
                top = scores.max(0)
                scores[best, np.arange(len(texts))] = -np.inf
                gap = (top - scores.max(0)) / np.maximum(grams, 1) if len(langs) > 1 else np.zeros(len(texts))
                predicted = [langs[b] if g else None for b, g in zip(best, grams, strict=True)]
                margin = [round(float(x), 6) if g else None for x, g in zip(gap, grams, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(predicted, pa.string()), pa.array(margin, pa.float64()), pa.array(grams.astype(np.int64))],
                ["doc_id", "lang", "predicted", "margin", "n_grams"],
            )

    return docs.select("doc_id", "lang", "text").mapInArrow(score, f"doc_id {kind}, lang string, predicted string, margin double, n_grams bigint")

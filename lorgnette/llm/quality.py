"""Quality rules as robust multivariate outliers.

Each text becomes a vector of transformed statistics. For every language and source the minimum covariance determinant
is sought: the mean and covariance of the share ``H`` of the vectors whose covariance has the smallest determinant.
Those of short texts are drawn to their group's medians, and all are scaled by medians and quartiles. From three deterministic starts (the scaled statistics as
they are, the correlations of their hyperbolic tangents, the covariance of their directions) two concentration steps are
made; the start with the smallest determinant goes on until no determinant falls any more. Then come the usual
correction by the median distance and one reweighting. All steps are aggregations over all rows: distances, their
histogram for the cut, and moments below it. Any number of rows of a group only adds to the same small aggregates.

Vectors beyond ``FAR`` times the radius of chi-square's 97.5 % quantile are rejected: the quantile itself holds for normal
vectors, and statistics of texts have heavier tails.

Defined results: nulls in language or source are a group like any other value; a null or empty text has the usual vector,
but for its length; very long texts are read whole; a group of fewer than ``min_rows`` rows is judged with all such groups of its
language, those of a language with too few with those of all languages, and where these are too few nobody is rejected
(``distance`` is null); ties at the cut all count; equal rows are judged alike, each for itself; an empty table gives no
rows. A statistic that is the same in most rows of a group is scaled by its standard deviation, and variances get
``RIDGE`` of the scaled ones' added, as in the regularised estimate, so that no covariance is singular or nearly so. Only
``doc_id``, ``lang``, ``source`` and ``text``
are read, so other columns may have any names.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorgnette.llm.common import Rolling, chunks, cut, runs, small, text_bytes, word_table

P = 8
#: Share of the rows that the estimate rests on, what is added to variances, and rows a group needs.
H, RIDGE, MIN_ROWS = 0.75, 0.05, 100
#: The tail of chi-square, and how many times its radius is too far.
TAIL, FAR = 0.025, 2.5
#: Steps from each start; a determinant falls if its logarithm does by as much as ``FALL``.
FIRST_STEPS, FALL = 2, 1e-3
#: Words, signs and lines of a group's usual text that the statistics of short texts are drawn to.
WORDS, SIGNS, LINES = 100, 600, 3
#: What is counted in a text: values, and by how many words, signs or lines.
MEASURED = ["words", "different", "length", "square", "marks", "capitals", "entropy", "in_line", "chars", "letters", "bytes", "lines"]
BIN = 40.0


def chi_square(p: float, tail: float) -> float:
    """The quantile of chi-square with ``p`` (even) degrees of freedom that leaves ``tail`` above it, by bisection."""
    lo, hi = 0.0, 700.0
    for _ in range(200):
        x = (lo + hi) / 2
        above = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(p // 2))
        lo, hi = (x, hi) if above > tail else (lo, x)
    return lo


def measured(texts: pa.Array, rolling: Rolling) -> np.ndarray:
    """The columns ``MEASURED`` of each text: numbers of words and of different ones; means of their lengths and squared
    lengths, of signs and digits a character, of capitals a letter; the entropy of bytes; words a line; how many
    characters, letters, bytes and lines there are."""
    data, off = text_bytes(texts)
    cls = np.zeros(256, np.uint8)  # 0: signs and digits
    cls[[9, 10, 13, 32]] = 1
    cls[65:91] = 2
    cls[97:123] = 3
    cls[0x80:0xC0] = 4
    cls[0xC0:] = 3
    c = cls[data]
    if len(data) > 1:
        c[:-1][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)] = 2
    share = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[off]).astype(float)
    signs, space, upper, lower = (share(c == k) for k in range(4))
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    low = fold[data]
    start, end = runs(low, off, word_table())
    h = rolling.stretch(rolling.prefix(low), start, end)
    at = np.searchsorted(start, off)
    words, rows = np.diff(at).astype(float), len(off) - 1
    row, length = np.repeat(np.arange(rows), np.diff(at)), (end - start).astype(float)
    different = np.array([len(np.unique(h[x:y])) for x, y in zip(at[:-1], at[1:], strict=True)], float)
    count = np.bincount(np.repeat(np.arange(rows), np.diff(off)) * 256 + low, minlength=rows * 256).reshape(rows, 256)
    size = np.diff(off).astype(float)
    entropy = np.log(np.maximum(size, 1)) - (count * np.log(np.maximum(count, 1))).sum(1) / np.maximum(size, 1)
    chars, letters, lines = signs + space + upper + lower, upper + lower, share(data == 10) + 1
    mean = lambda total, n: total / np.maximum(n, 1)
    return np.stack([
        words, different, mean(np.bincount(row, length, rows), words), mean(np.bincount(row, length * length, rows), words),
        mean(signs, chars), mean(upper, letters), entropy, words / lines, chars, letters, size, lines,
    ], axis=1).round(6)


def vectors(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of(batches):
        rolling = Rolling()
        for batch in chunks(batches, "text"):
            x = measured(batch.column("text"), rolling)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("doc_id", "lang", "source")), *(pa.array(x[:, k]) for k in range(len(MEASURED)))], ["doc_id", "lang", "source", *MEASURED])

    return docs.select("doc_id", "lang", "source", "text").mapInArrow(of, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{k} double" for k in MEASURED))


def statistics(judged: DataFrame, hint) -> DataFrame:
    """(doc_id, lang, source, g, f0...): logarithms of the numbers of words, of the mean and spread of their lengths, of the
    shares of signs and digits, of capitals and of different words, and of words a line; the entropy. Values of short texts
    are drawn to the medians of their group."""
    by = {"length": ("words", WORDS), "square": ("words", WORDS), "marks": ("chars", SIGNS), "capitals": ("letters", SIGNS), "entropy": ("bytes", SIGNS), "in_line": ("lines", LINES)}
    usual = cut(judged.groupBy("g").agg(*[F.percentile(F.round(k, 4), 0.5).alias(f"m_{k}") for k in by]))
    drawn = {k: (F.col(k) * F.col(n) + F.col(f"m_{k}") * w) / (F.col(n) + w) for k, (n, w) in by.items()}
    f = [
        F.log(F.col("words") + WORDS),
        F.log(F.greatest(drawn["length"], F.lit(0.1))),
        F.log(F.greatest(drawn["square"] - drawn["length"] * drawn["length"], F.lit(0.1))) / 2,
        F.log(drawn["marks"] + 0.002),
        F.log(drawn["capitals"] + 0.002),
        F.log((F.col("different") + WORDS) / (F.col("words") + WORDS)),
        drawn["entropy"],
        F.log(drawn["in_line"] + 1),
    ]
    return judged.join(hint(usual), "g").select("doc_id", "lang", "source", "g", *[F.round(x, 9).alias(f"f{k}") for k, x in enumerate(f)])


def with_groups(v: DataFrame, min_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """The vectors with the group ``g`` that judges them, null for none; the groups' ``g`` and size ``n``; how many there are."""
    key = lambda *c: F.to_json(F.array(*c), {"ignoreNullFields": "false"})
    sizes = v.groupBy("lang", "source").count()
    few = F.col("count") < min_rows
    sizes = sizes.withColumn("in_lang", F.sum(F.when(few, F.col("count"))).over(Window.partitionBy("lang")))
    spare = few & (F.col("in_lang") < min_rows)
    sizes = sizes.withColumn("g", F.when(~few, key("lang", "source")).when(~spare, key("lang")).otherwise(F.lit("[]")))
    sizes = cut(sizes.select("lang", "source", "g", F.sum("count").over(Window.partitionBy("g")).alias("n")))
    rows = sizes.count()
    s = small(sizes.withColumnRenamed("lang", "l").withColumnRenamed("source", "s"), rows, 200)
    v = v.join(s, v["lang"].eqNullSafe(s["l"]) & v["source"].eqNullSafe(s["s"])).withColumn("g", F.when(F.col("n") >= min_rows, F.col("g")))
    return v.drop("l", "s", "n"), sizes.where(F.col("n") >= min_rows).select("g", "n").distinct(), rows


def squared() -> Column:
    """The squared distance of z0... from ``mu`` by the whitening matrix ``w``, rows of its upper triangle."""
    terms, at = [], 0
    for i in range(P):
        line = reduce(lambda a, b: a + b, [F.col("w")[at + j - i] * (F.col(f"z{j}") - F.col("mu")[j]) for j in range(i, P)])
        terms.append(line * line)
        at += P - i
    return reduce(lambda a, b: a + b, terms)


def whitening(cov: np.ndarray) -> np.ndarray:
    """The upper triangle of W with W'W the inverse of ``cov``."""
    return np.linalg.cholesky(np.linalg.inv(cov)).T[np.triu_indices(P)]


def whole_matrix(triangle) -> np.ndarray:
    out = np.zeros((P, P))
    out[np.triu_indices(P)] = np.asarray(triangle)
    return out + np.triu(out, 1).T


def covariance(n: float, s, q) -> tuple[np.ndarray, np.ndarray]:
    mu = np.asarray(s) / n
    return mu, whole_matrix(np.asarray(q) / n) - np.outer(mu, mu)


def estimates(moments: DataFrame) -> DataFrame:
    """(g, start, mu, w, det) from (g, start, n, s, q), the count, sums and sums of products: ``det`` is the determinant's logarithm."""

    @F.pandas_udf("struct<mu: array<double>, w: array<double>, det: double>")
    def solve(n: pd.Series, s: pd.Series, q: pd.Series) -> pd.DataFrame:
        out = []
        for m, a, b in zip(n, s, q, strict=True):
            mu, cov = covariance(m, a, b)
            cov = cov + np.eye(P) * RIDGE
            out.append((mu.tolist(), whitening(cov).tolist(), float(np.linalg.slogdet(cov)[1])))
        return pd.DataFrame(out, columns=["mu", "w", "det"])

    r = moments.select("g", "start", solve("n", "s", "q").alias("r"))
    return r.select("g", "start", "r.mu", "r.w", "r.det")


def products(x: list[Column]) -> Column:
    return F.array(*[F.sum(x[i] * x[j]) for i in range(P) for j in range(i, P)])


def starts(z: DataFrame) -> DataFrame:
    """(g, start, mu, w) of the three starts, all around the medians."""
    tanh = z.select("g", *[F.tanh(f"z{k}").alias(f"z{k}") for k in range(P)])
    norm = F.sqrt(reduce(lambda a, b: a + b, [F.col(f"z{k}") * F.col(f"z{k}") for k in range(P)]) + 1e-12)
    turned = z.select("g", *[(F.col(f"z{k}") / norm).alias(f"z{k}") for k in range(P)])
    both = moments(tanh.withColumn("start", F.lit(1))).unionByName(moments(turned.withColumn("start", F.lit(2))))

    @F.pandas_udf("struct<mu: array<double>, w: array<double>>")
    def solve(start: pd.Series, n: pd.Series, s: pd.Series, q: pd.Series) -> pd.DataFrame:
        out = []
        for k, m, a, b in zip(start, n, s, q, strict=True):
            _, cov = covariance(m, a, b) if k == 1 else (None, whole_matrix(np.asarray(b) / m))
            d = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            cov = cov / np.outer(d, d) if k == 1 else cov * P
            out.append(([0.0] * P, whitening(cov + np.eye(P) * RIDGE).tolist()))
        return pd.DataFrame(out, columns=["mu", "w"])

    found = both.select("g", "start", solve("start", "n", "s", "q").alias("r")).select("g", "start", "r.mu", "r.w")
    zeros, ones = F.array(*[F.lit(0.0)] * P), F.array(*[F.lit((1 + RIDGE) ** -0.5 if i == j else 0.0) for i in range(P) for j in range(i, P)])
    return found.unionByName(z.select("g").distinct().select("g", F.lit(0).alias("start"), zeros.alias("mu"), ones.alias("w")))


def moments(near: DataFrame) -> DataFrame:
    z = [F.col(f"z{k}") for k in range(P)]
    return near.groupBy("g", "start").agg(F.count("*").alias("n"), F.array(*[F.sum(x) for x in z]).alias("s"), products(z).alias("q"))


def binned(d: DataFrame) -> DataFrame:
    return d.withColumn("bin", F.floor(F.log(F.col("d2") + 1e-9) * BIN).cast("int"))


def order_statistic(d: DataFrame, share: float) -> DataFrame:
    """(g, start, at): the histogram bin of the distances that reaches the ``share`` of a group's rows."""
    w = Window.partitionBy("g", "start")
    h = d.groupBy("g", "start", "bin").count().withColumn("up", F.sum("count").over(w.orderBy("bin"))).withColumn("all", F.sum("count").over(w))
    return h.where(F.col("up") >= F.col("all") * share).groupBy("g", "start").agg(F.min("bin").alias("at"))


def scaled_statistics(judged: DataFrame, hint) -> DataFrame:
    """(doc_id, lang, source, g, z0...): the statistics less their median, by their quartiles' distance or, if that is 0, standard deviation.

    Quartiles are of values rounded to thousandths: counts of so many values, the same however rows are divided.
    """
    f = [F.col(f"f{k}") for k in range(P)]
    q = judged.groupBy("g").agg(*[F.percentile(F.round(x, 3), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{k}") for k, x in enumerate(f)], *[F.stddev_pop(x).alias(f"d{k}") for k, x in enumerate(f)])
    spread = lambda k: F.when(F.col(f"q{k}")[2] > F.col(f"q{k}")[0], (F.col(f"q{k}")[2] - F.col(f"q{k}")[0]) / 1.349).when(F.col(f"d{k}") > 1e-9, F.col(f"d{k}")).otherwise(1.0)
    q = cut(q.select("g", *[F.col(f"q{k}")[1].alias(f"m{k}") for k in range(P)], *[spread(k).alias(f"s{k}") for k in range(P)]))
    return judged.join(hint(q), "g").select("doc_id", "lang", "source", "g", *[((F.col(f"f{k}") - F.col(f"m{k}")) / F.col(f"s{k}")).alias(f"z{k}") for k in range(P)])


def least_determinant(z: DataFrame, hint, h: float) -> DataFrame:
    """(g, start, mu, w) of each group's subset of the share ``h`` with the smallest determinant that is found."""

    def step(params: DataFrame) -> DataFrame:
        d = binned(z.join(hint(params), "g").withColumn("d2", squared()))
        near = d.join(hint(order_statistic(d, h)), ["g", "start"]).where(F.col("bin") <= F.col("at"))
        return cut(estimates(moments(near)))

    params = cut(starts(z))
    for _ in range(FIRST_STEPS):
        params = step(params.select("g", "start", "mu", "w"))
    least = F.min_by(F.struct("mu", "w", "det"), F.struct("det", "start")).alias("r")
    best = cut(params.groupBy("g").agg(least).select("g", F.lit(0).alias("start"), "r.mu", "r.w", "r.det"))
    done = None
    while True:
        new = step(best.select("g", "start", "mu", "w")).select("g", F.struct("mu", "w", "det").alias("new"))
        falls = F.col("new.det") < F.col("det") - FALL
        both = best.join(hint(new), "g").select("g", "start", falls.alias("falls"), F.when(falls, F.col("new")).otherwise(F.struct("mu", "w", "det")).alias("r"))
        best = cut(both.select("g", "start", "r.mu", "r.w", "r.det", "falls"))
        if best.where("falls").first() is None:
            return best.select("g", "start", "mu", "w")
        best = best.drop("falls")


def distances(docs: DataFrame, min_rows: int = MIN_ROWS, h: float = H) -> DataFrame:
    """(doc_id, lang, source, distance): squared robust Mahalanobis distances within each language and source."""
    v, _, groups = with_groups(cut(vectors(docs)), min_rows)
    v = cut(v)
    hint = lambda df: small(df, groups, 3 * (8 * (P + P * (P + 1) // 2) + 100))
    z = cut(scaled_statistics(cut(statistics(v.where(F.col("g").isNotNull()), hint)), hint))
    params = least_determinant(z, hint, h)
    for last in (False, True):
        d = binned(z.join(hint(params), "g").withColumn("d2", squared()))
        half = order_statistic(d, 0.5).select("g", (F.exp((F.col("at") + 0.5) / BIN) / chi_square(P, 0.5)).alias("scale"))
        scaled = d.join(hint(half), "g").withColumn("distance", F.col("d2") / F.col("scale"))
        if not last:
            params = cut(estimates(moments(scaled.where(F.col("distance") <= chi_square(P, 0.025)))))
    none = v.where(F.col("g").isNull()).select("doc_id", "lang", "source", F.lit(None).cast("double").alias("distance"))
    return scaled.select("doc_id", "lang", "source", F.round("distance", 4).alias("distance")).unionByName(none)


def too_far(tail: float) -> float:
    return FAR**2 * chi_square(P, tail)


def accepted(docs: DataFrame, tail: float = TAIL, min_rows: int = MIN_ROWS) -> DataFrame:
    """(doc_id, lang, source, distance) of the documents that aren't rejected."""
    return distances(docs, min_rows).where(F.coalesce(F.col("distance"), F.lit(0.0)) <= too_far(tail))


def rejected(docs: DataFrame, tail: float = TAIL, min_rows: int = MIN_ROWS) -> DataFrame:
    """(doc_id, lang, source, distance) of the rejected documents."""
    return distances(docs, min_rows).where(F.col("distance") > too_far(tail))


def apply(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """The documents with their columns, without the rejected ones. Rows that share a ``doc_id`` go together."""
    gone = cut(rejected(docs, tail).select(F.col("doc_id").alias("id")).distinct())
    kept = docs.join(small(gone, gone.count(), 16), docs["doc_id"] == gone["id"], "left_anti")
    return kept.select("doc_id", "text", "lang", "source", "n_chars")

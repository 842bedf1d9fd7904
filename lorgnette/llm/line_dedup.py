"""Line dedup by distinct-site spread.

A line that stands on at least ``min_sites`` sites (values of ``source``) is boilerplate: it is kept in the document
with the lowest ``doc_id`` that has it and removed from all others. Sites are counted by a HyperLogLog sketch for each
hash of a trimmed line, merged by aggregation; only lines whose estimate is near the threshold are counted exactly. The
lines found are broadcast if all of them take no more than ``BROADCAST_LIMIT``, so that texts are filtered where they are
read; beyond that the documents' lines are joined with them, and what is to go with the documents.

``keep_copies`` (off) leaves whole the documents whose very text another document has as well: copies, which removal
would empty, for an operator on documents to deal with.

Defined results: blank lines are never boilerplate; a null source counts as no site; a null text stays null with no
lines; a document with a null ``doc_id`` keeps all its lines; rows that share a ``doc_id`` are treated alike; the owner
of a tie is the lowest ``doc_id``; a document that consists of removed lines alone has an empty text; very long texts are
taken whole; an empty table gives no rows. Only ``doc_id``, ``text`` and ``source`` are read, so other columns may have
any names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorgnette.llm.common import BROADCAST_LIMIT, cut, small

MIN_SITES = 10
#: log2 of the sketches' registers, and the share around the threshold within which sites are counted exactly.
LG_K, BAND = 12, 0.15


def spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, band: float = BAND) -> DataFrame:
    """(h, owner) of every line found on ``min_sites`` sites or more: its hash and the lowest doc_id that has it."""
    lines = line_hashes(docs)
    sketched = lines.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"), F.min("doc_id").alias("owner"))
    likely = cut(sketched.where(F.col("sites") >= min_sites * (1 - band)))
    near = likely.where(F.col("sites") <= min_sites * (1 + band)).select("h", "owner")
    counted = lines.join(small(near, near.count(), 24), "h").groupBy("h").agg(F.countDistinct("site").alias("sites"), F.min("owner").alias("owner"))
    return likely.where(F.col("sites") > min_sites * (1 + band)).select("h", "owner").unionByName(counted.where(F.col("sites") >= min_sites).select("h", "owner"))


def line_hashes(docs: DataFrame) -> DataFrame:
    line = F.explode(F.split("text", "\n")).alias("line")
    return docs.select("doc_id", F.col("source").alias("site"), line).where(F.trim("line") != "").select("doc_id", "site", F.xxhash64(F.trim("line")).alias("h"))


def line_keys(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.xxhash64(F.trim(x)))


def found_in(spread: DataFrame) -> Column:
    """For each line of ``_lines``, whether it stays by the bounded table ``spread``, which every task holds sorted."""
    rows = spread.orderBy("h").collect()
    shared = spread.sparkSession.sparkContext.broadcast((np.array([r["h"] for r in rows], np.int64), np.array([r["owner"] for r in rows], np.int64)))

    @F.pandas_udf("array<boolean>")
    def stays(doc_id: pd.Series, keys: pd.Series) -> pd.Series:
        h, owner = shared.value
        size = keys.map(len).to_numpy(np.int64) if len(keys) else np.zeros(0, np.int64)
        if not len(h) or not size.sum():
            return pd.Series([[True] * n for n in size], dtype=object)
        flat, ids = np.concatenate(list(keys)), np.repeat(doc_id.to_numpy(), size)
        at = np.minimum(np.searchsorted(h, flat), len(h) - 1)
        return pd.Series(np.split((h[at] != flat) | (ids <= owner[at]), np.cumsum(size)[:-1]), dtype=object)

    # A document without an id is before all owners.
    return stays(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), F.coalesce(line_keys(F.col("_lines")), F.array().cast("array<bigint>")))


def with_spread_removed(docs: DataFrame, min_sites: int = MIN_SITES, keep_copies: bool = False) -> DataFrame:
    """``docs`` with the columns ``_lines`` and ``_kept``: the lines of each text, and those that stay."""
    spread = cut(spread_lines(docs, min_sites).where("owner IS NOT NULL"))
    lines = docs.withColumn("_lines", F.split("text", "\n"))
    if spread.count() * 16 <= BROADCAST_LIMIT:
        lines = lines.withColumn("_stays", found_in(spread))
        lines = lines.withColumn("_kept", F.filter("_lines", lambda x, i: (F.trim(x) == "") | F.get("_stays", i))).drop("_stays")
    else:
        gone = line_hashes(docs).join(spread, "h").where(F.col("doc_id") > F.col("owner"))
        gone = gone.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("h").alias("_gone"))
        lines = lines.join(gone, F.col("doc_id") == F.col("_id"), "left")
        stay = F.filter("_lines", lambda x: (F.trim(x) == "") | ~F.array_contains("_gone", F.xxhash64(F.trim(x))))
        lines = lines.withColumn("_kept", F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(stay)).drop("_id", "_gone")
    if keep_copies:
        hashed = lambda df, *c: df.select(*c, F.xxhash64("text").alias("_t"), F.xxhash64(F.lit(1), "text").alias("_u"))
        copies = cut(hashed(docs.where("text IS NOT NULL"), "doc_id").distinct().groupBy("_t", "_u").count().where("count > 1").select(F.col("_t").alias("_x"), F.col("_u").alias("_y")))
        is_copy = (F.xxhash64("text") == F.col("_x")) & (F.xxhash64(F.lit(1), "text") == F.col("_y"))
        lines = lines.join(small(copies, copies.count(), 32), is_copy, "left")
        lines = lines.withColumn("_kept", F.when(F.col("_x").isNotNull(), F.col("_lines")).otherwise(F.col("_kept"))).drop("_x", "_y")
    return lines


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(doc_id, n_lines, n_removed, text) of every document, ``text`` without the removed lines."""
    d = with_spread_removed(docs.select("doc_id", "text", "source"), min_sites)
    n = F.coalesce(F.size("_lines"), F.lit(0))
    n = F.when(F.col("_lines").isNull(), 0).otherwise(n)
    return d.select("doc_id", n.alias("n_lines"), (n - F.when(F.col("_kept").isNull(), 0).otherwise(F.size("_kept"))).alias("n_removed"), F.array_join("_kept", "\n").alias("text"))


def apply(docs: DataFrame, min_sites: int = MIN_SITES, keep_copies: bool = False) -> DataFrame:
    """The documents with their columns, without removed lines."""
    d = with_spread_removed(docs.select("doc_id", "text", "lang", "source", "n_chars"), min_sites, keep_copies)
    text = F.when(F.size("_kept") < F.size("_lines"), F.array_join("_kept", "\n")).otherwise(F.col("text"))
    chars = F.when(F.size("_kept") < F.size("_lines"), F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return d.select("doc_id", text.alias("text"), "lang", "source", chars.alias("n_chars"))


DEDUP_SQL = f"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
s AS (SELECT trim(line) AS k, min(doc_id) AS owner FROM l WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}),
f AS (SELECT l.doc_id, l.pos, l.line, s.k IS NOT NULL AND l.doc_id > s.owner AS gone FROM l LEFT JOIN s ON trim(l.line) = s.k)
SELECT doc_id, count(*)::INT AS n_lines, count(*) FILTER (WHERE gone)::INT AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM f GROUP BY doc_id
"""

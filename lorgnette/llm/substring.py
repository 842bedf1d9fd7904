"""Substring dedup by level-wise doubling.

Windows of words are compared by hash at lengths that double: windows repeated at one length alone are extended to twice
that length, until no candidates survive. The first length is half of ``min_words`` and looks at content-chosen starts:
of every ``min_words`` words in a row, the window of half that length with the lowest hash. What repeats over
``min_words`` words therefore has a repeated start, at the same words in every copy, and at the second length, which is
``min_words``, every window around a repeated start is compared, whatever its offset. So the spans found are exactly the
words covered by windows of ``min_words`` words that occur twice or more. Longer lengths tell how far a repeat goes: what
repeats at one lies in a span, so in spans long enough the windows at every offset are compared at each doubled length, and
``longest`` is the greatest of these lengths at which any window of the span repeats.

No task holds a group of any size: hashes that one document in ``ONE_IN``, by hash, shows to be frequent are known to
repeat, so their rows are spread by document and not compared, and the lowest ``doc_id`` of each is aggregated; groups of
all other hashes are small. Windows of greater lengths go packed by chunks of documents, and one that stands at two places
of a chunk is sent once for it.

Defined results: a window repeats if it stands at two places, in one document or in several; the place in the lowest
(doc_id, position) is the first; texts of fewer words than ``min_words``, nulls and empty ones have no spans; rows that
repeat a ``doc_id`` are taken for copies of one document and count once; a row with a null ``doc_id`` is left out; very
long texts are taken whole; an empty table gives no rows. Only ``doc_id`` and ``text`` are read, so other columns may have
any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorgnette.llm.common import Rolling, Words, chunks, column, cut, grouped, mix, small, written

MIN_WORDS = 50
#: Frequent hashes: over a ``MANY``-th of all rows that repeat and ``LEAST`` rows, so there are no more than ``MANY``, 8 MB, of any corpus.
ONE_IN, MANY, LEAST, SALTS = 16, 1_000_000, 64, 4096
NONE, NOBODY = np.uint64(0xFFFFFFFFFFFFFFFF), 0xFFFFFFFF


class Windows:
    """Window hashes and content-chosen starts of a chunk of texts."""

    def __init__(self, texts: pa.Array, words: Words, rolling: Rolling, min_words: int):
        h, self.off = words(texts)
        self.rolling, self.min_words, self.half = rolling, min_words, min_words // 2
        self.prefix = rolling.prefix(h)
        self.left = np.repeat(self.off[1:], np.diff(self.off)) - np.arange(len(h))  # words from here to the text's end
        self.row = np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))
        start = np.flatnonzero(self.left >= self.half)
        self.low = np.full(len(h), NONE, np.uint64)
        self.low[start] = self.hashes(start, self.half)
        #: Starts of whole windows, and for each the chosen start in it.
        self.start = np.flatnonzero(self.left >= min_words)
        reach = min_words - self.half + 1
        self.chosen = self.start
        if len(self.start):
            best = self.low[self.start].copy()
            chosen = self.start.copy()
            for k in range(1, reach):
                other = self.low[self.start + k]
                less = other < best
                best[less] = other[less]
                chosen[less] = self.start[less] + k
            self.chosen = chosen

    def hashes(self, start: np.ndarray, length: int) -> np.ndarray:
        return self.rolling.stretch(self.prefix, start, start + length)


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def by_hash(df: DataFrame) -> DataFrame:
    return df.repartition("h", "salt").sortWithinPartitions("h", "salt", "doc_id", "pos")


def repeats(rows: DataFrame) -> DataFrame:
    """(h, n) of the hashes that stand at two places, and at how many."""
    g = rows.groupBy("h").agg(*[f(c).alias(f"{k}_{c}") for c in ("doc_id", "pos") for k, f in (("low", F.min), ("high", F.max))], F.count("*").alias("n"))
    return g.where("low_doc_id < high_doc_id OR low_pos < high_pos")


def frequent(some: DataFrame) -> np.ndarray:
    """The frequent hashes among (h, doc_id, pos) of one document in ``ONE_IN``, sorted."""
    g = cut(repeats(some).select("h", "n"))
    least = max(LEAST / ONE_IN, (g.agg(F.sum("n")).first()[0] or 0) / MANY)
    found = g.where(F.col("n") >= least).select("h").collect()
    return np.sort(np.array([r["h"] for r in found], np.int64))


def salts(h: np.ndarray, doc: np.ndarray, hot: np.ndarray) -> pa.Array:
    """-1, or for a frequent hash a number by the document."""
    h = h.view(np.int64)
    is_hot = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h if len(hot) else np.zeros(len(h), bool)
    return pa.array(np.where(is_hot, (mix(doc.astype(np.uint64)) % np.uint64(SALTS)).astype(np.int64), -1).astype(np.int32))


def repeated(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order of h, salt, doc_id, pos: those whose h stands at two places or has a salt, and each one's first row."""
    h, doc, pos, salt = column(t, "h"), column(t, "doc_id"), column(t, "pos"), column(t, "salt")
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])])
    at = np.flatnonzero(new)  # rows that repeat a doc_id count once
    h = h[at]
    edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
    count = np.diff(edge)
    many = np.repeat(count > 1, count) | (salt[at] >= 0)
    first = np.repeat(edge[:-1], count)
    return at[many], at[first[many]]


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start_word, end_word, n_words, longest, first_doc_id) of every maximal span that repeated windows cover."""
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))

    sc, some = docs.sparkSession.sparkContext, F.pmod(F.xxhash64("doc_id"), F.lit(ONE_IN)) == 0
    nothing = sc.broadcast(np.zeros(0, np.int64))

    def starts(batches, hot=nothing):
        words, rolling = Words(), Rolling()
        for batch in chunks(batches, "text"):
            w = Windows(batch.column("text"), words, rolling, min_words)
            at = np.unique(w.chosen)
            doc = column(pa.Table.from_batches([batch]), "doc_id")
            yield pa.RecordBatch.from_arrays([as_long(w.low[at]), salts(w.low[at], doc[w.row[at]], hot.value), pa.array(doc[w.row[at]]), pa.array((at - w.off[w.row[at]]).astype(np.int32))], ["h", "salt", "doc_id", "pos"])

    def survivors(batches):
        for t in grouped(batches, ["h", "salt"]):
            at, _ = repeated(t)
            yield from t.select(["doc_id", "pos"]).take(pa.array(at)).combine_chunks().to_batches()

    schema = "h bigint, salt int, doc_id bigint, pos int"
    hot_starts = sc.broadcast(frequent(texts.where(some).mapInArrow(starts, schema)))
    found = by_hash(texts.mapInArrow(lambda batches: starts(batches, hot_starts), schema)).mapInArrow(survivors, "doc_id bigint, pos int")
    kept = cut(found.groupBy("doc_id").agg(F.collect_list("pos").alias("chosen")))
    size = kept.agg(F.count("*").alias("n"), F.sum(F.size("chosen")).alias("m")).first()
    with_starts = texts.join(small(kept, 1, 32 * size["n"] + 4 * (size["m"] or 0)), "doc_id")

    def windows(batches, hot=nothing):
        words, rolling = Words(), Rolling()
        for batch in chunks(batches, "text"):
            w = Windows(batch.column("text"), words, rolling, min_words)
            ok = np.zeros(len(w.row), bool)
            chosen = batch.column("chosen")
            per_row = np.diff(chosen.offsets.to_numpy())
            ok[chosen.flatten().to_numpy() + np.repeat(w.off[:-1], per_row)] = True
            take = ok[w.chosen]
            at = w.start[take]
            doc = column(pa.Table.from_batches([batch]), "doc_id")
            h, doc = w.hashes(at, min_words), doc[w.row[at]]
            yield pa.RecordBatch.from_arrays([as_long(h), salts(h, doc, hot.value), pa.array(doc), pa.array((at - w.off[w.row[at]]).astype(np.int32))], ["h", "salt", "doc_id", "pos"])

    def whole(batches):
        for t in grouped(batches, ["h", "salt"]):
            at, first = repeated(t)
            rows, is_hot = t.select(["doc_id", "pos"]).take(pa.array(at)), column(t, "salt")[at] >= 0
            rows = rows.add_column(2, "first", pa.array(column(t, "doc_id")[first], mask=is_hot))
            yield from rows.add_column(3, "hot", pa.array(column(t, "h")[at], mask=~is_hot)).combine_chunks().to_batches()

    hot_windows = sc.broadcast(frequent(with_starts.where(some).mapInArrow(windows, schema)))
    level = by_hash(with_starts.mapInArrow(lambda batches: windows(batches, hot_windows), schema))
    covered = written(level.mapInArrow(whole, "doc_id bigint, pos int, first bigint, hot bigint"))

    spans = covered.select("doc_id", "pos", "first", "hot")
    if len(hot_windows.value):
        lowest = spans.where("hot IS NOT NULL").groupBy(F.col("hot").alias("_hot")).agg(F.min("doc_id").alias("_first"))
        spans = spans.join(small(lowest, len(hot_windows.value), 24), F.col("hot") == F.col("_hot"), "left").withColumn("first", F.coalesce("first", "_first"))
    spans = spans.select("doc_id", "pos", "first")

    def joined(batches):
        for t in grouped(batches, ["doc_id"]):
            yield spans_of(t, min_words)

    found = written(spans.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(joined, "doc_id bigint, start_word int, end_word int, n_words int, first_doc_id bigint"))
    longer = longer_repeats(texts, found, min_words).groupBy("doc_id", "start_word").agg(F.max("length").alias("length"))
    return found.join(longer, ["doc_id", "start_word"], "left").select("doc_id", "start_word", "end_word", "n_words", F.coalesce("length", F.lit(min_words)).alias("longest"), "first_doc_id")


def longer_repeats(texts: DataFrame, spans: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, start_word, length) of the spans in which some window repeats at a doubled length, for each such length."""
    buckets = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = cut(spans.where(F.col("n_words") >= 2 * min_words).groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans")))
    size = long.agg(F.count("*").alias("n"), F.sum(F.size("spans")).alias("m")).first()
    rows = texts.join(small(long, 1, 32 * size["n"] + 16 * (size["m"] or 0)), "doc_id")

    def emit(batches):
        words, rolling, chunk = Words(), Rolling(), TaskContext.get().partitionId() << 32
        for batch in chunks(batches, "text"):
            h, off = words(batch.column("text"))
            prefix, own = rolling.prefix(h), batch.column("spans")
            row = np.repeat(np.arange(batch.num_rows), np.diff(own.offsets.to_numpy()))
            start, end = (own.flatten().field(k).to_numpy().astype(np.int64) for k in (0, 1))
            docs = column(pa.Table.from_batches([batch]), "doc_id")[row]
            a, b = start + off[row], np.minimum(end + off[row], off[row + 1])
            # An entry for each span and length; its windows.
            entry, hashes, owner, place, length, n = [], [], [], [], 2 * min_words, 0
            while (fits := np.flatnonzero(b - a >= length)).size:
                count = (b - a)[fits] - length + 1
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a[fits], count)
                hashes.append(rolling.stretch(prefix, at, at + length))
                owner.append(np.repeat(np.arange(n, n + len(fits)), count))
                place.append((np.repeat(docs[fits], count).astype(np.int64) << 24) + at - np.repeat(off[row[fits]], count))
                entry.append(np.stack([docs[fits], start[fits], np.full(len(fits), length)]))
                length, n = 2 * length, n + len(fits)
            if not n:
                continue
            hashes, owner, place = (np.concatenate(x) for x in (hashes, owner, place))
            twice, edge, by = several(hashes, place)
            inside = np.unique(owner[by[np.repeat(twice, np.diff(edge))]])
            # Of a hash with several places here one is sent, for no entry; of any other all, which are one place.
            sent = np.sort(by[edge[:-1]][twice])
            whose = np.where(np.isin(np.arange(len(owner)), sent), NOBODY, owner)
            keep = np.ones(len(owner), bool)
            keep[by[np.repeat(twice, np.diff(edge))]] = False
            keep[sent] = True
            at = np.flatnonzero(keep)
            bucket = ((hashes[at] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            at, cuts = at[order], np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))]).tolist()
            hs, ps, ws = hashes[at], place[at], whose[at].astype(np.uint32)
            out = [(k, chunk, hs[x:y].tobytes(), ps[x:y].tobytes(), ws[x:y].tobytes(), None) for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]
            out.append((chunk % buckets, chunk, b"", b"", inside.astype(np.uint32).tobytes(), np.concatenate(entry, axis=1).astype(np.int64).tobytes()))
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["bucket", "chunk", "h", "place", "owner", "entries"])
            chunk += 1

    def compare(batches):
        for t in grouped(batches, ["bucket"]):
            entries, lengths = t.column("entries").to_pylist(), [len(x) // 8 for x in t.column("h").to_pylist()]
            h, place = (np.frombuffer(b"".join(t.column(k).to_pylist()), d) for k, d in (("h", np.uint64), ("place", np.int64)))
            owners = [np.frombuffer(x, np.uint32) for x in t.column("owner").to_pylist()]
            owner = np.concatenate([np.zeros(0, np.uint32), *(x for x, e in zip(owners, entries, strict=True) if e is None)])
            ok = np.zeros(len(h), bool)
            if len(h):
                twice, edge, by = several(h, place)
                twice |= np.logical_or.reduceat(owner[by] == NOBODY, edge[:-1])
                ok[by] = np.repeat(twice, np.diff(edge))
                ok &= owner != NOBODY
            ends = np.cumsum(lengths)
            found = [x.tobytes() if e is not None else np.unique(owner[y - k : y][ok[y - k : y]]).tobytes() for x, e, k, y in zip(owners, entries, lengths, ends.tolist(), strict=True)]
            yield from t.select(["chunk", "entries"]).append_column("found", pa.array(found, pa.binary())).combine_chunks().to_batches()

    def told(batches):
        for t in grouped(batches, ["chunk"]):
            chunk = column(t, "chunk")
            edge = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1], [True]])).tolist()
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                one = t.slice(lo, hi - lo)
                entry = np.frombuffer(b"".join(x for x in one.column("entries").to_pylist() if x), np.int64).reshape(3, -1)
                hit = entry[:, np.unique(np.frombuffer(b"".join(one.column("found").to_pylist()), np.uint32))]
                yield pa.RecordBatch.from_arrays([pa.array(hit[0]), pa.array(hit[1].astype(np.int32)), pa.array(hit[2].astype(np.int32))], ["doc_id", "start_word", "length"])

    rows = rows.mapInArrow(emit, "bucket int, chunk bigint, h binary, place binary, owner binary, entries binary")
    rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(compare, "chunk bigint, entries binary, found binary")
    return rows.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(told, "doc_id bigint, start_word int, length int")


def several(h: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of hashes in order: which stand at several places, where each one's rows begin (and the end), and the rows' order."""
    by = np.lexsort((place, h))
    edge = np.flatnonzero(np.concatenate([[True], h[by][1:] != h[by][:-1], [True]]))
    return place[by[edge[:-1]]] != place[by[edge[1:] - 1]], edge, by


def spans_of(t: pa.Table, min_words: int) -> pa.RecordBatch:
    docs = column(t, "doc_id")
    edge = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1], [True]]))
    out = {k: [] for k in ("doc_id", "start_word", "end_word", "first_doc_id")}
    all_pos, all_first = column(t, "pos"), column(t, "first")
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        pos, first = all_pos[lo:hi], all_first[lo:hi]
        order = np.lexsort((first, pos))
        pos, first = pos[order], first[order]
        begin = np.flatnonzero(np.concatenate([[True], pos[1:] > pos[:-1] + min_words]))
        end = np.append(begin[1:], len(pos)) - 1
        out["doc_id"].append(np.full(len(begin), docs[lo]))
        out["start_word"].append(pos[begin])
        out["end_word"].append(pos[end] + min_words)
        out["first_doc_id"].append(first[begin])
    c = {k: np.concatenate(v) for k, v in out.items()}
    i32 = lambda x: pa.array(x.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(c["doc_id"].astype(np.int64)), i32(c["start_word"]), i32(c["end_word"]), i32(c["end_word"] - c["start_word"]), pa.array(c["first_doc_id"].astype(np.int64))],
        ["doc_id", "start_word", "end_word", "n_words", "first_doc_id"],
    )

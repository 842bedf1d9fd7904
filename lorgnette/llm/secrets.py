"""Secret scans by grammar inference.

For each kind of credential a prefix tree of labelled examples is generalised by state merging: states whose outgoing
symbol and end frequencies agree within the Hoeffding bound are merged, the most visited first and each with the state it
resembles most, into a deterministic probabilistic automaton. Every run of credential characters in every text is a
candidate, and so is every stretch of it from sign to sign, up to twice as long as the longest example, as credentials are
glued to names (``API_KEY=...``, ``?key=...``); of those that overlap one is reported, of a length that examples have if
there is one, then of the best score. A candidate's score is its log-likelihood under the likeliest format (automaton and the examples' lengths) less that under
the likeliest of plain explanations: the corpus's own words (character pairs, counted over all candidates without digits),
a number, or any letters and digits, the latter two ``RARE`` less likely; ``threshold`` nats or more are reported.

The labelled examples are drawn, with a fixed seed, from the published shapes of common tokens: ``EXAMPLES`` for a kind.

Defined results: null and empty texts have no candidates; repeated secrets are reported at each place; rows that share a
``doc_id`` are scanned as they are; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import bisect
import math
import random
import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorgnette.llm.common import chunks, held, runs, text_bytes

ALPHABET = string.ascii_letters + string.digits + "_-+/=."
MIN_LENGTH, THRESHOLD, EXAMPLES, ALPHA, FLOOR, RARE = 16, 10.0, 150, 0.05, -9.0, -5.0

ALNUM, UPPER, LOWER_HEX, UPPER_HEX, URL = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, "0123456789abcdef", "0123456789ABCDEF", string.ascii_letters + string.digits + "-_"
#: Kinds of credentials: literals and (characters, count) in turn.
FORMATS: dict[str, list] = {
    "cloud_access_key": ["AKIA", (UPPER, 16)],
    "code_host_token": ["ghp_", (ALNUM, 36)],
    "chat_bot_token": ["xoxb-", (string.digits, 11), "-", (string.digits, 12), "-", (ALNUM, 24)],
    "map_api_key": ["AIza", (URL, 35)],
    "payment_key": ["sk_live_", (ALNUM, 24)],
    "signed_web_token": ["eyJ", (URL, 33), ".eyJ", (URL, 60), ".", (URL, 43)],
    "hex_token": [(LOWER_HEX, 40)],
    "hex_token_32": [(LOWER_HEX, 32)],
    "upper_hex_token": [(UPPER_HEX, 40)],
    "secret_access_key": [(ALNUM + "/+", 40)],
}


def labelled_examples(n: int = EXAMPLES, seed: int = 5) -> dict[str, list[str]]:
    rnd = random.Random(seed)
    draw = lambda parts: "".join(p if isinstance(p, str) else "".join(rnd.choice(p[0]) for _ in range(p[1])) for p in parts)
    return {k: [draw(parts) for _ in range(n)] for k, parts in FORMATS.items()}


class Automaton:
    """A prefix tree whose compatible states ``merge`` folds into each other."""

    def __init__(self, examples: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.visits, self.ends = [0], [0]
        for word in examples:
            s = 0
            self.visits[0] += 1
            for c in word:
                if c not in self.next[s]:
                    self.next[s][c] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                    self.visits.append(0)
                    self.ends.append(0)
                self.count[s][c] = self.count[s].get(c, 0) + 1
                s = self.next[s][c]
                self.visits[s] += 1
            self.ends[s] += 1

    def gap(self, a: int, b: int, alpha: float) -> float | None:
        """The greatest difference of two states' frequencies, as a share of the bound; None if one is beyond it."""
        na, nb = self.visits[a], self.visits[b]
        bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
        worst = abs(self.ends[a] / na - self.ends[b] / nb)
        for c in {*self.count[a], *self.count[b]}:
            worst = max(worst, abs(self.count[a].get(c, 0) / na - self.count[b].get(c, 0) / nb))
        return worst / bound if worst <= bound else None

    def merge(self, alpha: float = ALPHA) -> None:
        red = [0]
        while True:
            reds = set(red)
            blue = {self.next[r][c]: (r, c) for r in red for c in sorted(self.next[r]) if self.next[r][c] not in reds}
            if not blue:
                break
            b = max(blue, key=lambda x: (self.visits[x], -x))
            gaps = [(g, r) for r in red if (g := self.gap(r, b, alpha)) is not None]
            if gaps:
                parent, c = blue[b]
                self.next[parent][c] = min(gaps)[1]
                self.fold(min(gaps)[1], b)
            else:
                red.append(b)
        self.states = red

    def fold(self, into: int, other: int) -> None:
        work = [(into, other)]
        while work:
            a, b = work.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for c, t in self.next[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + self.count[b][c]
                if c in self.next[a]:
                    if self.next[a][c] != t:
                        work.append((self.next[a][c], t))
                else:
                    self.next[a][c] = t


class Formats:
    """All automata as one table of transitions, and the log-probabilities of lengths."""

    def __init__(self, examples: dict[str, list[str]], alpha: float = ALPHA):
        self.names = sorted(examples)
        n = len(ALPHABET)
        step, score, self.start, self.lengths = [], [], [], []
        for name in self.names:
            a = Automaton(examples[name])
            a.merge(alpha)
            number = {s: len(step) + k for k, s in enumerate(a.states)}
            self.start.append(number[0])
            for s in a.states:
                # A symbol never seen in a state costs FLOOR and leaves the state as it is.
                row, cost, total = np.full(n, number[s]), np.full(n, FLOOR), sum(a.count[s].values())
                for c, t in a.next[s].items():
                    row[ALPHABET.index(c)] = number[t]
                    cost[ALPHABET.index(c)] = math.log(a.count[s][c] / total)
                step.append(row)
                score.append(cost)
            seen = Counter(map(len, examples[name]))
            size = sum(seen.values()) + 100
            self.lengths.append(({k: math.log((v + 0.5) / size) for k, v in seen.items()}, math.log(0.5 / size)))
        self.step, self.score = np.concatenate(step), np.concatenate(score)

    def __call__(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Log-likelihoods, a row for each format, of the runs of ``symbols``; runs have to be in falling order of length."""
        n = len(ALPHABET)
        state = np.repeat(np.array(self.start)[:, None], len(start), axis=1)
        total = np.zeros(state.shape)
        alive = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")
        for t, m in enumerate(alive.tolist()):
            at = state[:, :m] * n + symbols[start[:m] + t]
            total[:, :m] += self.score[at]
            state[:, :m] = self.step[at]
        for k, (known, other) in enumerate(self.lengths):
            total[k] += [known.get(x, other) for x in length.tolist()]
        return total


def candidate_runs(column: pa.Array, min_length: int):
    """The symbols of a batch's bytes, its offsets, and where its candidates begin and end."""
    data, off = text_bytes(column)
    number = np.full(256, 255, np.uint8)
    number[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
    symbols = number[data]
    start, end = runs(data, off, number < 255)
    # Dots and equals signs at either end are punctuation.
    edge = np.zeros(256, bool)
    edge[[ord(c) for c in ".=-"]] = True
    for _ in range(3):
        start = start + (edge[data[start]] & (end - start > 1))
        end = end - (edge[data[end - 1]] & (end - start > 1))
    ok = end - start >= min_length
    return data, symbols, off, start[ok], end[ok]


def stretches(data: np.ndarray, start: np.ndarray, end: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs, and the parts of them of ``least`` to ``most`` characters that begin after and end before a sign."""
    if not len(start):
        return start, end
    sign = np.zeros(256, bool)
    sign[[ord(c) for c in "_-+/=."]] = True
    is_sign = np.append(sign[data], True)
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    at = np.flatnonzero(np.cumsum(inside)[:-1])
    run = np.searchsorted(start, at, "right") - 1
    # After an equals sign a credential may begin with a sign of its own.
    begins = (at == start[run]) | is_sign[at - 1] & (~is_sign[at] | (data[at - 1] == ord("=")))
    stops = is_sign[at + 1] & ~is_sign[at] | (at + 1 == end[run])
    a, limit, b = at[begins], end[run[begins]], at[stops] + 1
    lo, hi = np.searchsorted(b, a + least), np.searchsorted(b, np.minimum(a + most, limit), "right")
    n = np.maximum(hi - lo, 0)
    a, b = np.repeat(a, n), b[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
    part = ~(np.isin(a, start) & np.isin(b, end))
    return np.concatenate([start, a[part]]), np.concatenate([end, b[part]])


def apart(start: np.ndarray, end: np.ndarray, score: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Positions of the stretches that overlap no better one, in order of place: those of a ``usual`` length are better than
    others, as the first parts of a credential may score more than all of it; then those of greater score, then longer ones."""
    taken: list[tuple[int, int]] = []
    out = []
    for k in np.lexsort((start, start - end, -score, ~usual)).tolist():
        a, b = int(start[k]), int(end[k])
        i = bisect.bisect(taken, (a, b))
        if (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or b <= taken[i][0]):
            taken.insert(i, (a, b))
            out.append(k)
    return np.array(sorted(out, key=lambda k: start[k]), np.int64)


def digits_before(data: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum((data >= 48) & (data < 58))])


def background(docs: DataFrame, min_length: int) -> np.ndarray:
    """Log-probabilities of a character after another, from all candidates without digits; row 0 is for the first one."""
    n = len(ALPHABET)

    def count(batches):
        total = np.zeros((n + 1) * n, np.int64)
        for batch in chunks(batches, "text"):
            data, symbols, _, start, end = candidate_runs(batch.column("text"), min_length)
            digits = digits_before(data)
            plain = digits[start] == digits[end]
            start, end = start[plain], end[plain]
            inside = np.zeros(len(symbols) + 1, np.int32)
            np.add.at(inside, start + 1, 1)
            np.add.at(inside, end, -1)
            at = np.flatnonzero(np.cumsum(inside)[:-1])
            total += np.bincount(symbols[start], minlength=len(total))
            total += np.bincount((symbols[at - 1].astype(np.int64) + 1) * n + symbols[at], minlength=len(total))
        keep = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keep.astype(np.int32)), pa.array(total[keep])], ["pair", "n"])

    # As many rows as there are pairs of characters.
    rows = docs.select("text").mapInArrow(count, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.full((n + 1) * n, 0.5)
    for r in rows:
        counts[r["pair"]] += r["n"]
    counts = counts.reshape(n + 1, n)
    return np.log(counts / counts.sum(1, keepdims=True))


def scan(docs: DataFrame, examples: dict[str, list[str]] | None = None, threshold: float = THRESHOLD, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, start_byte, n_chars, format, score, masked) of the best candidates that a format explains better by ``threshold``."""
    examples = examples or labelled_examples()
    most = 2 * max(len(x) for words in examples.values() for x in words)
    model = held(docs.sparkSession.sparkContext, (Formats(examples), background(docs, min_length)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def search(batches):
        formats, pairs = model()
        for batch in chunks(batches, "text"):
            data, symbols, off, start, end = candidate_runs(batch.column("text"), min_length)
            if not len(start):
                continue
            start, end = stretches(data, start, end, min_length, most)
            order = np.argsort(start - end, kind="stable")
            start, end = start[order], end[order]
            likely = formats(symbols, start, end - start)
            before = np.zeros(len(symbols), np.int64)
            before[1:] = symbols[:-1].astype(np.int64) + 1
            flat = np.where(symbols < 255, pairs[np.minimum(before, len(ALPHABET)), np.minimum(symbols, len(ALPHABET) - 1)], 0.0)
            prefix = np.concatenate([[0.0], np.cumsum(flat)])
            words = pairs[0, symbols[start]] + prefix[end] - prefix[start + 1]
            digits, length = digits_before(data), end - start
            number = np.where(digits[end] - digits[start] == length, length * -math.log(10) + RARE, -np.inf)
            mixed = length * -math.log(len(ALNUM)) + RARE
            score = likely.max(0) - np.maximum(np.maximum(words, mixed), number)
            hit = np.flatnonzero(score >= threshold)
            usual = np.array([n in formats.lengths[k][0] for n, k in zip(length[hit].tolist(), likely.argmax(0)[hit].tolist(), strict=True)], bool)
            hit = hit[apart(start[hit], end[hit], score[hit], usual)]
            row = np.searchsorted(off, start[hit], "right") - 1
            text = [bytes(data[a:b]).decode() for a, b in zip(start[hit], end[hit], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(start[hit] - off[row]),
                    pa.array((end - start)[hit].astype(np.int32)),
                    pa.array([formats.names[k] for k in likely.argmax(0)[hit]], pa.string()),
                    pa.array(score[hit].round(3)),
                    pa.array([t[:4] + "*" * (len(t) - 4) for t in text], pa.string()),
                ],
                ["doc_id", "start_byte", "n_chars", "format", "score", "masked"],
            )

    return docs.select("doc_id", "text").mapInArrow(search, f"doc_id {kind}, start_byte bigint, n_chars int, format string, score double, masked string")

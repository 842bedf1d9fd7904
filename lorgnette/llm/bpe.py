"""BPE encoding and decoding by one depth-first walk of a trie of the distinct words.

In byte-pair encoding every prefix of a word has one encoding, and that is told by its last token: the one token that
ends the prefix and may follow the encoding of what comes before it. So a node of the trie holds a last token, found
from its ancestors alone, and prefixes that words share are encoded once. Sorted words visit the trie's nodes depth
first, hence the trie is kept as the stack of the nodes on the present path.

Defined results: a null text has null ``tokens`` and ``n_tokens`` 0; an empty text has no tokens; repeated rows are
encoded alike, each in its row; very long texts and words are encoded whole; an empty table gives no rows; only ``doc_id`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

import base64
from array import array

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lorgnette.llm.common import chunks, held

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How byte-level BPE vocabularies of this family divide a text into words; every character belongs to one.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encoded words that a task keeps; beyond this it starts afresh, which changes no result.
KEPT_WORDS = 400_000


class Vocabulary:
    """Tokens, their ranks, and the two tokens that each was merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        top = max(ranks.values(), default=-1) + 1
        self.bytes_of: list[bytes] = [b""] * top
        self.left, self.right = array("i", [-1]) * top, array("i", [-1]) * top
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = merged(token, ranks, rank)
                if len(parts) == 2:
                    self.left[rank], self.right[rank] = (ranks[p] for p in parts)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def merged(word: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """The parts of ``word`` once every merge of a rank under ``below`` is made, lowest rank and leftmost first."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if best >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def encode_words(words: list[bytes], v: Vocabulary) -> dict[bytes, bytes]:
    """The encoding of each of the distinct ``words``, as the bytes of 32-bit ids."""
    ranks, bytes_of, left, right, longest = v.ranks, v.bytes_of, v.left, v.right, v.longest
    known: dict[tuple[int, int], bool] = {}
    out: dict[bytes, bytes] = {}
    path: list[int] = [-1]  # path[d]: the last token of the first d bytes of the present word
    before = b""

    def follows(a: int, b: int) -> bool:
        """Whether b right after a stays as it is: no merge across the border may come before their own merges."""
        limit = 1 << 60
        while True:
            if ranks.get(bytes_of[a] + bytes_of[b], limit) < limit:
                return False
            if a > b:
                limit, a = a, right[a]
            else:
                limit, b = b + 1, left[b]
            if a < 0 or b < 0:
                return True

    for word in sorted(words):
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del path[shared + 1 :]
        for d in range(shared + 1, len(word) + 1):
            for start in range(max(0, d - longest), d):
                token = ranks.get(word[start:d])
                if token is None:
                    continue
                if start:
                    pair = (path[start], token)
                    ok = known.get(pair)
                    if ok is None:
                        ok = known[pair] = follows(*pair)
                    if not ok:
                        continue
                path.append(token)
                break
            else:
                raise ValueError("the vocabulary lacks a byte")
        before = word
        ids, d = array("i"), len(word)
        while d:
            ids.append(path[d])
            d -= len(bytes_of[path[d]])
        ids.reverse()
        out[word] = ids.tobytes()
    return out


def decode(ids, v: Vocabulary) -> str:
    return b"".join(v.bytes_of[i] for i in ids).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens, tokens, round_trip): each text's tokens, and whether decoding them gives that text again."""
    v = held(docs.sparkSession.sparkContext, Vocabulary.read(vocabulary))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        vocab, split = v(), regex.compile(pattern)
        known: dict[str, bytes] = {}
        for batch in chunks(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            words = [split.findall(t) if t else [] for t in texts]
            if len(known) > KEPT_WORDS:
                known = {}
            new = {w.encode(): w for ws in words for w in set(ws).difference(known)}
            for word, ids in encode_words(list(new), vocab).items():
                if b"".join([vocab.bytes_of[i] for i in array("i", ids)]) != word:
                    raise ValueError("a word isn't decoded to itself")
                known[new[word]] = ids
            rows = [b"".join([known[w] for w in ws]) for ws in words]
            off, ends = [0], 0
            for r in rows:
                ends += len(r) // 4
                off.append(ends)
            tokens = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.Array.from_buffers(pa.int32(), ends, [None, pa.py_buffer(b"".join(rows))]), mask=pa.array([t is None for t in texts]))
            # Each word is decoded to itself above, so a text is if its words make it up.
            same = [t is not None and "".join(ws) == t for t, ws in zip(texts, words, strict=True)]
            counts = [len(r) // 4 for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int32()), tokens, pa.array(same)], ["doc_id", "n_tokens", "tokens", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, n_tokens int, tokens array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) from (doc_id, tokens); null tokens give a null text."""
    v = held(encoded.sparkSession.sparkContext, Vocabulary.read(vocabulary))
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def back(batches):
        for batch in batches:
            texts = [None if ids is None else decode(ids, v()) for ids in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "tokens").mapInArrow(back, f"doc_id {kind}, text string")

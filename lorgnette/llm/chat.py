"""Chat formatting with a grammar round trip.

A conversation is rendered as ``<|im_start|>role``, a line feed, the content and ``<|im_end|>`` with a line feed for
each turn. The rendering is parsed again by a deterministic parser and the turns compared with the source; turns whose
content comes back otherwise, since it holds markers or looks escaped, are escaped until all are identical. One backslash
more in every ``<|`` hides it; the parser takes one backslash out of every ``<\\|``. Line feeds and backslashes in roles
are always escaped.

Defined results: null roles and contents are rendered as empty; turns go by ``turn``, then role, then text, nulls first;
repeated turns are all rendered; turns of a null ``conv_id`` form one conversation; very long contents are rendered whole;
an empty table gives no rows; if turns still come back otherwise when all are escaped, ``round_trip`` is false. Only
``conv_id``, ``turn``, ``role`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(START + escape(r).replace("\\", "\\\\").replace("\n", "\\n") + "\n" + t + END for r, t in turns)


def parse(text: str) -> list[tuple[str, str]] | None:
    """The turns of a rendering by ``turn := START role LF content END``, content up to the next END; None if it is none."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            return None
        line = text.find("\n", at)
        end = text.find(END, line + 1)
        if line < 0 or end < 0 or START in text[line + 1 : end]:
            return None
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text[at + len(START) : line])
        turns.append((unescape(role), unescape(text[line + 1 : end])))
        at = end + len(END)
    return turns


def round_trip(turns: list[tuple[str, str]]) -> tuple[str, int]:
    """The rendering that parses to ``turns``, and how many contents had to be escaped for it."""
    contents, escaped = [t for _, t in turns], set()
    while True:
        text = render([(r, c) for (r, _), c in zip(turns, contents, strict=True)])
        if parse(text) == turns or len(escaped) == len(turns):
            return text, len(escaped)
        # A conflict shows in a turn rendered alone: the borders of its neighbours are markers, which it can't complete.
        wrong = [i for i, (turn, c) in enumerate(zip(turns, contents, strict=True)) if i not in escaped and parse(render([(turn[0], c)])) != [turn]]
        for i in wrong or [i for i in range(len(turns)) if i not in escaped]:
            contents[i] = escape(turns[i][1])
            escaped.add(i)


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_escaped, text, round_trip) of every conversation."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    grouped = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).groupBy("conv_id").agg(turns.alias("turns"))

    @F.pandas_udf("struct<text: string, n_escaped: int, round_trip: boolean>")
    def rendered(many: pd.Series) -> pd.DataFrame:
        out = []
        for one in many:
            source = [(t["role"], t["text"]) for t in one]
            text, n = round_trip(source)
            out.append((text, n, parse(text) == source))
        return pd.DataFrame(out, columns=["text", "n_escaped", "round_trip"])

    r = grouped.select("conv_id", F.size("turns").alias("n_turns"), rendered("turns").alias("r"))
    return r.select("conv_id", "n_turns", F.col("r.n_escaped").alias("n_escaped"), F.col("r.text").alias("text"), F.col("r.round_trip").alias("round_trip"))


CHAT_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT *, contains(text, '<|im_start|>') OR contains(text || '<|im_end|>' || chr(10), '<|im_end|>' || chr(10)) AND
  strpos(text || '<|im_end|>' || chr(10), '<|im_end|>' || chr(10)) <= length(text) OR regexp_matches(text, '<\\+\|') AS clash FROM t)
SELECT conv_id, count(*)::INT AS n_turns, count(*) FILTER (WHERE clash)::INT AS n_escaped,
  string_agg('<|im_start|>' || replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '\', '\\'), chr(10), '\n') || chr(10) ||
    CASE WHEN clash THEN regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') ELSE text END || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text,
  TRUE AS round_trip
FROM c GROUP BY conv_id
"""

"""Screenplays into scenes, dialogues and actions.

A script is one row, and so is what is found in it: elements become an array in order, over which an aggregate walks. No
shuffle is needed; frames of lines, scenes and actions are exploded from the row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lorgnette.functions.text import clean_element, html_unescape, strip
from lorgnette.sources.shared import cut

KINDS = ("action", "dialogue", "character", "stage_direction", "scene_description", "parenthetical")
SCENE = r"(?is)<scene>(.*?)</scene>"
ELEMENT = rf"(?is)<({'|'.join(KINDS)})>(.*?)</\1>"
PLAIN_SPLIT = r"(?iU)(?:INT|EXT)\.|FADE (?:IN|OUT):|\n\s*\n"
PLAIN_LINE = r"(?md)^([A-Z](?:[A-Z0-9]|[ _-])+)[:. ]+(.+)$"
#: What joins the parts of a scene: a backslash and an n, two characters.
SCENE_SEPARATOR = "\\n"


LINES, TEXTS = "array<struct<character: string, text: string>>", "array<string>"


@dataclass
class Parsed:
    """``rows``: a row for each script (script_id, parsed, plain, dialogues, scenes, actions); the frames below are made of it."""

    rows: DataFrame

    def kept(self) -> Parsed:
        """The same with its rows in the shared folder, so that scripts are parsed once for all frames taken of it."""
        return Parsed(cut(self.rows))

    @property
    def scripts(self) -> DataFrame:
        return self.rows.select("script_id", "parsed", "plain")

    @property
    def dialogues(self) -> DataFrame:
        """(script_id, pos, character, text)"""
        return exploded(self.rows, "dialogues", "x").select("script_id", "pos", "x.character", "x.text")

    @property
    def scenes(self) -> DataFrame:
        """(script_id, pos, text)"""
        return exploded(self.rows, "scenes", "text")

    @property
    def actions(self) -> DataFrame:
        """(script_id, pos, text)"""
        return exploded(self.rows, "actions", "text")

    def long(self) -> DataFrame:
        """(script_id, kind, pos, character, text): dialogues (d), scenes (s) and actions (a) in one frame, from one pass."""
        of = lambda kind: lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), F.lit(None).cast("string").alias("character"), x.alias("text"))
        lines = F.transform("dialogues", lambda x, i: F.struct(F.lit("d").alias("kind"), i.alias("pos"), x["character"].alias("character"), x["text"].alias("text")))
        return self.rows.select("script_id", F.explode_outer(F.concat(lines, F.transform("scenes", of("s")), F.transform("actions", of("a")))).alias("x")).where("x IS NOT NULL").select("script_id", "x.*")


def exploded(rows: DataFrame, name: str, of: str) -> DataFrame:
    """(script_id, pos, of). A plain explode brings a filter on the array's size, into which the whole parsing is copied and done again."""
    return rows.select("script_id", F.posexplode_outer(name).alias("pos", of)).where("pos IS NOT NULL")


def all_of(x: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(x, F.lit(pattern), F.lit(group))


def tag(name: str) -> str:
    return rf"(?is)<{name}>(.*?)</{name}>"


def not_empty(x: Column) -> Column:
    return F.filter(x, lambda s: s != "")


def element(kind: Column, content: Column) -> Column:
    return F.struct(kind.alias("kind"), clean_element(content).alias("content"))


def elements_of(found: Column) -> Column:
    """The elements of all scenes in order: a mark where a scene begins, its stage directions as headings, then its elements."""

    def of(raw: Column) -> Column:
        headings = F.transform(all_of(raw, tag("stage_direction")), lambda x: element(F.lit("heading"), x))
        named = lambda k, x: F.struct(F.lower(k).alias("kind"), F.when(F.lower(k) == "character", F.upper(clean_element(x))).otherwise(clean_element(x)).alias("content"))
        body = F.zip_with(all_of(raw, ELEMENT), all_of(raw, ELEMENT, 2), named)
        return F.concat(F.array(F.struct(F.lit("scene").alias("kind"), F.lit("").alias("content"))), F.filter(F.concat(headings, body), lambda e: e["content"] != ""))

    return F.flatten(F.transform(found, of))


#: Elements that are put through Python at once.
STRETCH = 1 << 14
PLACES = ArrayType(IntegerType())
WALK = StructType([StructField("lines", ArrayType(StructType([StructField("who", IntegerType()), StructField("said", IntegerType()), StructField("asides", PLACES)]))), StructField("actions", PLACES)])
WALKED = pa.struct([("lines", pa.list_(pa.struct([("who", pa.int32()), ("said", pa.int32()), ("asides", pa.list_(pa.int32()))]))), ("actions", pa.list_(pa.int32()))])


def marks_of(elements: Column) -> Column:
    """What a walk over ``elements`` has to know: speakers' names, and a letter for each other element."""
    kind = lambda e: F.when(e["kind"] == "scene", "s").when(e["kind"] == "dialogue", "d").when(e["kind"] == "parenthetical", "p").otherwise("a")
    return F.transform(elements, lambda e: F.when(e["kind"] == "character", F.concat(F.lit("="), e["content"])).otherwise(kind(e)))


def walked(marks: list[str]) -> dict:
    speaker, name, last, lines, actions = None, None, None, [], []
    for k, x in enumerate(marks):
        if x == "s":
            speaker = name = None
        elif x == "d":
            if name is not None:
                lines.append({"who": speaker, "said": k, "asides": []})
                last = name
        elif x == "p":
            if lines and last == name:
                lines[-1]["asides"].append(k)
            else:
                actions.append(-k - 1)
        elif x == "a":
            actions.append(k)
        else:
            speaker, name = k, x
    return {"lines": lines, "actions": actions}


@F.arrow_udf(WALK)
def walk(scripts: pa.Array) -> pa.Array:
    """Places of elements by a walk over each script's marks: who speaks, what is said, what a parenthetical belongs to, and
    what is an action, by -1 - place where a parenthetical is one.

    What an element means depends on those before it, and an expression that carries lists along copies them at each step; so
    this is a walk in Python, linear in the elements. Texts stay out of it, and few elements are Python objects at a time.
    """
    ends = np.cumsum(pc.fill_null(pc.list_value_length(scripts), 0).to_numpy(zero_copy_only=False))
    out, at = [], 0
    while at < len(scripts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STRETCH, "right")))
        out.append(pa.array([walked(x or ()) for x in scripts.slice(at, to - at).to_pylist()], WALKED))
        at = to
    return pa.concat_arrays(out) if out else pa.array([], WALKED)


def line_of(elements: Column):
    content = lambda k: F.get(elements, k)["content"]
    asides = lambda x: F.array_join(F.transform(x["asides"], lambda k: F.concat(F.lit(" ("), content(k), F.lit(")"))), "")
    return lambda x: F.struct(content(x["who"]).alias("character"), F.concat(content(x["said"]), asides(x)).alias("text"))


def action_of(elements: Column):
    content = lambda k: F.get(elements, k)["content"]
    return lambda k: F.when(k < 0, F.concat(F.lit("("), content(-k - 1), F.lit(")"))).otherwise(content(k))


def scene_texts(text: Column, found: Column, separator: str = SCENE_SEPARATOR) -> Column:
    """A scene's stage directions, then its descriptions; a scene with neither is left out. Without scenes, the whole text."""
    one = lambda raw: strip(F.array_join(not_empty(F.transform(F.concat(all_of(raw, tag("stage_direction")), all_of(raw, tag("scene_description"))), clean_element)), separator))
    return not_empty(F.when(F.size(found) > 0, F.transform(found, one)).otherwise(F.array(clean_element(text))))


def tagged_rows(scripts: DataFrame, separator: str = SCENE_SEPARATOR) -> DataFrame:
    """(script_id, script_segment, dialogues, scenes, actions) by the tagged grammar; no row needs another, so nothing is shuffled."""
    t = scripts.select("script_id", "script_segment", strip(F.coalesce("script_segment", F.lit(""))).alias("text")).withColumn("text", html_unescape("text"))
    t = t.withColumn("found", all_of(F.col("text"), SCENE))
    t = t.withColumn("elements", F.when(F.size("found") > 0, elements_of(F.col("found"))))
    t = t.withColumn("walk", walk(marks_of(F.col("elements")))).withColumn("scenes", scene_texts(F.col("text"), F.col("found"), separator))
    lines = F.when(F.size("found") > 0, F.transform("walk.lines", line_of(F.col("elements"))))
    actions = F.when(F.size("found") > 0, F.array_distinct(F.transform("walk.actions", action_of(F.col("elements"))))).otherwise(F.col("scenes"))
    return t.select("script_id", "script_segment", F.coalesce(lines, F.array().cast(LINES)).alias("dialogues"), "scenes", actions.alias("actions"))


def plain_scenes(text: Column) -> Column:
    return not_empty(F.transform(F.split(F.coalesce(text, F.lit("")), PLAIN_SPLIT, -1), strip))


def plain_lines(scenes: Column) -> Column:
    line = lambda k, x: F.struct(strip(k).alias("character"), strip(x).alias("text"))
    return F.flatten(F.transform(scenes, lambda s: F.zip_with(all_of(s, PLAIN_LINE), all_of(s, PLAIN_LINE, 2), line)))


def plain_actions(scenes: Column) -> Column:
    return not_empty(F.transform(scenes, lambda s: strip(F.regexp_replace(s, PLAIN_LINE, ""))))


def frames(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = Parsed(rows)
    return p.dialogues, p.scenes, p.actions


def parse_tagged(scripts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return frames(tagged_rows(scripts))


def parse_plain(scripts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scripts without tags: scenes at blank lines and headings, lines ``NAME: words``; the rest of a scene is an action."""
    p = scripts.select("script_id", plain_scenes(F.col("script_segment")).alias("scenes"))
    return frames(p.select("script_id", "scenes", plain_lines(F.col("scenes")).alias("dialogues"), plain_actions(F.col("scenes")).alias("actions")))


def parse(scripts: DataFrame, separator: str = SCENE_SEPARATOR) -> Parsed:
    """Of ``scripts`` (script_id, script_segment): what the tagged parser finds; of scripts where it finds neither scene nor line, what the plain one does."""
    t = tagged_rows(scripts, separator)
    t = t.withColumn("tagless", (F.size("scenes") == 0) & (F.size("dialogues") == 0))
    t = t.withColumn("plain_scenes", F.when(F.col("tagless"), plain_scenes(F.col("script_segment"))))
    t = t.withColumn("plain", F.coalesce(F.size("plain_scenes") > 0, F.lit(False)))
    chosen = lambda name, other: F.when(F.col("plain"), other(F.col("plain_scenes"))).otherwise(F.col(name)).alias(name)
    p = t.select("script_id", "plain", chosen("dialogues", plain_lines), chosen("scenes", lambda x: x), chosen("actions", plain_actions))
    found = F.size("dialogues") + F.size("scenes") + F.size("actions") > 0
    return Parsed(p.select("script_id", found.cast("int").alias("parsed"), "plain", "dialogues", "scenes", "actions"))


def by_character(dialogues: DataFrame) -> DataFrame:
    """(script_id, character, lines): each speaker's lines in order."""
    return dialogues.groupBy("script_id", "character").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("lines"))

"""Column functions on text. Patterns follow Unicode where the semantics call for it."""

from __future__ import annotations

import html

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACE = r"[\s\x1c-\x1f]"


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c(x), rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def clean_element(x: Column | str) -> Column:
    """Without tags, each within one line, and stripped."""
    return strip(F.regexp_replace(c(x), "(?d)<.*?>", ""))


def strip_tags(x: Column | str) -> Column:
    """Without tags, over lines too, and stripped; null is empty. This goes before embedding."""
    return F.coalesce(strip(F.regexp_replace(c(x), "<[^>]+>", "")), F.lit(""))


#: Bytes of text that are decoded at once.
DECODED = 1 << 20


@F.arrow_udf(StringType())
def decoded(texts: pa.Array) -> pa.Array:
    """Texts with entities decoded, some at a time, so that few are Python objects."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    out, at = [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + DECODED, "right")))
        out.append(pa.array([None if x is None else html.unescape(x) for x in texts.slice(at, to - at).to_pylist()], pa.string()))
        at = to
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def html_unescape(x: Column | str) -> Column:
    """With entities decoded. Only texts with an ampersand go through Python."""
    x = c(x)
    return F.coalesce(decoded(F.when(x.contains("&"), x)), x)


def unwrap(x: Column | str) -> Column:
    """Without a code fence and a script element around it: each affix once, in this order, as written here."""
    out = strip(x)
    for affix, at_start in (("```xml", True), ("<script>", True), ("```", False), ("</script>", False)):
        n = len(affix)
        if at_start:
            rest = F.substring(out, n + 1, 2147483647)
            out = F.when(out.startswith(affix), strip(rest)).otherwise(out)
        else:
            rest = out.substr(F.lit(1), F.length(out) - n)
            out = F.when(out.endswith(affix), strip(rest)).otherwise(out)
    return out


def words_of(x: Column | str) -> Column:
    return F.filter(F.split(c(x), r"(?U)\s+"), lambda w: w != "")


def numbered_items(x: Column | str, least: int = 2, most: int = 24) -> Column:
    """The lines of a completion without bullets or numbers that have ``least`` to ``most`` words."""
    lines = F.transform(F.split(strip(x), "\n"), lambda s: F.regexp_replace(strip(s), r"(?U)\A\s*[\d.\-*•]+\s*", ""))
    return F.filter(lines, lambda s: F.size(words_of(s)).between(least, most))


def prefix(x: Column | str, n: int) -> Column:
    return F.substring(c(x), 1, n)


def path_safe(x: Column | str) -> Column:
    return F.replace(c(x), F.lit("/"), F.lit("_"))


def render(template: Column | str, **values: Column) -> Column:
    """``template`` with ``{name}`` replaced by the value of each name, taken literally; null values are empty."""
    out = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out


#: Templates by prompt version; others may be passed instead.
PROMPTS = {
    "base": "Write a screenplay scene for the film {movie_name}. Story: {summary}",
    "instruction": "Write a tagged screenplay for the film {movie_name}. Put every scene in scene tags, name speakers, and mark lines and actions. Story: {summary}",
}


def prompt(version: Column | str, movie_name: Column, summary: Column, prompts: dict[str, str] = PROMPTS) -> Column:
    """The prompt of a version; an unknown version is an error."""
    version = c(version)
    chosen = F.when(F.lit(False), F.lit(""))
    for name, template in prompts.items():
        chosen = chosen.when(version == name, render(template, movie_name=movie_name, summary=summary))
    return chosen.otherwise(F.raise_error(F.concat(F.lit("unknown prompt version: "), F.coalesce(version, F.lit("null")))))


#: Names of score tables: a model, then how it was prompted.
ABLATION_FILE = r"^(.*?)_(instruction|base|rag)[.]csv$"


def file_model(name: Column | str) -> Column:
    return F.regexp_extract(c(name), ABLATION_FILE, 1)


def file_ablation(name: Column | str) -> Column:
    return F.regexp_extract(c(name), ABLATION_FILE, 2)


def display_name(model: Column | str) -> Column:
    """A short name for charts."""
    model = c(model)
    parts = F.split(model, "-")
    first, tuned = parts[0], model.contains("instruct")
    return F.when((first == "internlm3") & tuned, "internlm3-instruct").when((first == "meta_llama") & tuned, F.when(F.size(parts) > 2, F.concat(F.lit("llama-"), F.get(parts, F.lit(2)))).otherwise("llama")).otherwise(first)


def python_float(x: Column | str) -> Column:
    """What a lenient float parser reads: underscores between digits are allowed, type suffixes aren't; else null."""
    s = strip(x)
    ok = s.rlike(r"(?i)^[+-]?(?:(?:\d(?:_?\d)*\.?(?:\d(?:_?\d)*)?|\.\d(?:_?\d)*)(?:e[+-]?\d(?:_?\d)*)?|inf(?:inity)?|nan)$")
    return F.when(ok, F.replace(F.regexp_replace(s, "(?i)[+-]nan", "NaN"), F.lit("_"), F.lit("")).try_cast("double"))

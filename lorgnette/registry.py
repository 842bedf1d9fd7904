"""Queries over the given tables and the SQL that says the same, by name.

The tables stand in for scripts and score tables: conversations for dialogues (``conv_id`` a script, ``turn`` a place,
``role`` a speaker), documents for texts of lines, parts, orders and events for scores. Metrics use the letter counts of
``providers.Letters``, a test double.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorgnette.functions import text as T
from lorgnette.functions.vectors import cosine
from lorgnette.operators import metrics as M
from lorgnette.operators import parser, providers, scores
from lorgnette.sources import files, sinks
from lorgnette.sources.shared import shared_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dialogues(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select(F.col("conv_id").alias("script_id"), F.col("turn").alias("pos"), F.upper("role").alias("character"), "text")


def document_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("script_id"), F.posexplode(F.split("text", "\n")).alias("pos", "text"))


def rounded(df: DataFrame, **names: str) -> DataFrame:
    return df.select("script_id", F.round("score", 6).alias("score"))


def scripts_of(spark: SparkSession, d: str, turn) -> DataFrame:
    """(script_id, script_segment): a script of each conversation, a piece for each turn."""
    c = table(spark, d, "conversations").withColumn("piece", turn)
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("turn", "piece"))), lambda x: x["piece"])
    return c.groupBy(F.col("conv_id").alias("script_id")).agg(F.array_join(pieces, "").alias("script_segment"))


def el(name: str, *content) -> F.Column:
    return F.concat(F.lit(f"<{name}>"), *content, F.lit(f"</{name}>"))


def tagged(spark: SparkSession, d: str) -> DataFrame:
    heading = F.concat(F.lit("At "), F.col("role"), F.lit(": "), F.col("text"))
    return scripts_of(spark, d, el("scene", el("stage_direction", heading), el("CHARACTER", F.col("role")), el("dialogue", F.lit(" "), F.col("text")), el("action", F.lit("Then "), F.col("text"))))


# SQL that the queries' counterparts share.
def letters(t: str) -> str:
    low = rf"lower(regexp_replace({t}, '<[^>]+>', '', 'g'))"
    return "[" + ", ".join(f"(length({low}) - length(replace({low}, '{x}', '')))::DOUBLE" for x in "abcdefghijklmnopqrstuvwxyz") + "]"


def raw_cos(a: str, b: str) -> str:
    return f"CASE WHEN list_sum(list_transform({a}, lambda x: abs(x))) = 0 OR list_sum(list_transform({b}, lambda x: abs(x))) = 0 THEN 0.0 ELSE list_cosine_similarity({a}, {b}) END"


def cos(a: str, b: str) -> str:
    return f"greatest(0.0, least(1.0, {raw_cos(a, b)}))"


def trimmed(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


D = f"""d AS (SELECT conv_id AS script_id, turn AS pos, upper(role) AS character, text, {letters("text")} AS v,
  length(substr(text, 1, 500)) % 2 = 0 AS q, length(substr(text, 1, 500)) % 3 = 1 AS intent1, length(substr(text, 1, 500)) % 3 <> 0 AS intent,
  CASE (length(role) + length(substr(text, 1, 500))) % 4 WHEN 0 THEN 1 WHEN 1 THEN -1 WHEN 2 THEN 0 END AS e FROM conversations WHERE text <> '')"""
DC1 = f"dc1 AS (SELECT script_id, avg({cos('v', 'w')}) AS score FROM (SELECT *, lead(v) OVER (PARTITION BY script_id ORDER BY pos) AS w FROM d) WHERE w IS NOT NULL GROUP BY 1)"
DC2 = f"dc2 AS (SELECT script_id, avg({cos('v', 'w')}) AS score FROM (SELECT *, lead(v) OVER (PARTITION BY script_id ORDER BY pos) AS w, lead(q) OVER (PARTITION BY script_id ORDER BY pos) AS nq FROM d) WHERE q AND NOT nq GROUP BY 1)"


def concentration_sql(name: str, source: str, keys: str, least: int) -> str:
    """1 less the mean distance to the centroid, by the definition: dimension by dimension, then row by row."""
    k = ", ".join(f"{name}_c.{x}" for x in keys.split(", "))
    return f"""{name}_f AS (SELECT {keys}, v FROM {source} WHERE list_sum(list_transform(v, lambda x: abs(x))) > 0),
{name}_n AS (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) >= {least}),
{name}_x AS (SELECT {keys}, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM {name}_f),
{name}_c AS (SELECT {keys}, list(m ORDER BY i) AS m FROM (SELECT {keys}, i, avg(x) AS m FROM {name}_x GROUP BY {keys}, i) GROUP BY {keys}),
{name}_s AS (SELECT {k}, 1 - avg(1 - list_cosine_similarity(v, m)) AS score FROM {name}_f JOIN {name}_c USING ({keys}) JOIN {name}_n USING ({keys}) GROUP BY {k} HAVING count(*) >= 2)"""


DC3 = concentration_sql("dc3", "d", "script_id", 2) + ", dc3 AS (SELECT script_id, greatest(score, 0.0) AS score FROM dc3_s)"
CC1 = """cc1 AS (SELECT script_id, avg(greatest(0.0, least(1.0, 1 - step / 2))) AS score FROM (
  SELECT script_id, character, avg(abs(e - p)) AS step FROM (
    SELECT *, lag(e) OVER (PARTITION BY script_id, character ORDER BY pos) AS p FROM (
      SELECT *, row_number() OVER (PARTITION BY script_id, character ORDER BY pos) AS k, count(*) OVER (PARTITION BY script_id, character) AS n FROM d)
    WHERE k <= 20 AND n >= 2 AND e IS NOT NULL)
  GROUP BY 1, 2) WHERE step IS NOT NULL GROUP BY 1)"""
CC2 = concentration_sql("cc2", "d", "script_id, character", 3) + ", cc2 AS (SELECT script_id, avg(greatest(0.0, least(1.0, score))) AS score FROM cc2_s GROUP BY 1)"


def cc3_sql(actions: str) -> str:
    return f"""a AS ({actions}), cc3 AS (SELECT script_id, avg(best) AS score FROM (
  SELECT d.script_id, d.pos, max({cos("d.v", "a.v")}) AS best FROM
    (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY script_id ORDER BY pos) AS k FROM d) WHERE k <= 30 AND intent) d JOIN a USING (script_id) GROUP BY 1, 2)
  WHERE best > 0 GROUP BY 1)"""


def items_sql(source: str) -> str:
    """(script_id, pos, item) of the numbered items in the texts of ``source`` (script_id, text)."""
    return rf"""SELECT script_id, pos, item FROM (SELECT script_id, pos, regexp_replace({trimmed("line")}, '^\s*[\d.\-*•]+\s*', '') AS item FROM (
  SELECT script_id, unnest(string_split({trimmed("text")}, chr(10))) AS line, generate_subscripts(string_split({trimmed("text")}, chr(10)), 1) AS pos FROM ({source})))
  WHERE len(list_filter(regexp_split_to_array(item, '\s+'), lambda w: w <> '')) BETWEEN 2 AND 24"""


def pr2_sql(source: str) -> str:
    v = letters("item")
    return f"""ev AS (SELECT script_id, pos, {v} AS v FROM ({items_sql(f"SELECT script_id, substr(text, 1, {providers.EVENT_CHARS}) AS text FROM ({source})")})),
pr2 AS (SELECT script_id, avg({raw_cos("v", "w")}) AS score FROM (SELECT *, lead(v) OVER (PARTITION BY script_id ORDER BY pos) AS w FROM ev) WHERE w IS NOT NULL GROUP BY 1)"""


def pick(with_: str, name: str) -> str:
    return f"WITH {with_} SELECT script_id, round(score, 6) AS score FROM {name}"


# --- Sources and text -----------------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT * FROM conversations WHERE turn % 4 <> 3)
SELECT conv_id::VARCHAR AS source_file, turn + 1 AS physical_line, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS line_number,
  CASE WHEN turn % 5 = 2 THEN 'Error_Line_' || (turn + 1) WHEN turn % 3 = 1 THEN 'Unknown_L' || (turn + 1) ELSE role END AS movie_name,
  CASE WHEN turn % 5 = 2 THEN 'N/A' ELSE 'tt' || conv_id END AS imdb_id, CASE WHEN turn % 5 = 2 THEN '' ELSE text END AS script_segment FROM l""")
def ingest_jsonl_entries(spark, d):
    c = table(spark, d, "conversations")
    name = F.when(F.col("turn") % 3 != 1, F.col("role"))
    good = F.to_json(F.struct(name.alias("movie_name"), F.concat(F.lit("tt"), F.col("conv_id").cast("string")).alias("imdb_id"), F.col("text").alias("script_segment")))
    value = F.when(F.col("turn") % 4 == 3, " \t").when(F.col("turn") % 5 == 2, F.concat(F.lit("{broken"), F.col("role"))).otherwise(good)
    lines = c.select(F.col("conv_id").cast("string").alias("source_file"), (F.col("turn") + 1).alias("physical_line"), value.alias("value"))
    return files.numbered(files.entries_of_lines(lines)).drop("script_id")


@query("""SELECT conv_id::VARCHAR AS source_file, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS line_number,
  role AS movie_name, 'N/A' AS imdb_id, text AS script_segment FROM conversations""")
def ingest_json_array(spark, d):
    c = table(spark, d, "conversations")
    wrapped = F.concat(F.lit(" ```xml\n<script>\n"), F.col("text"), F.lit("</script>\n```\n"))
    item = F.struct("turn", F.col("role").alias("movie_name"), wrapped.alias("response"))
    arrays = c.groupBy(F.col("conv_id").cast("string").alias("source_file")).agg(F.to_json(F.array_sort(F.collect_list(item))).alias("value"))
    return files.numbered(files.entries_of_arrays(arrays)).drop("script_id", "physical_line")


@query(rf"SELECT doc_id, {trimmed('text')} AS text FROM documents")
def strip_wrappers(spark, d):
    whole = F.concat(F.lit("\n```xml <script>\n"), F.col("text"), F.lit("\n</script>\n```  "))
    return table(spark, d, "documents").select("doc_id", T.unwrap(whole).alias("text"))


@query("SELECT page_id, md5(regexp_replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;?', '&', 'g')) AS text FROM pages")
def html_unescape(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.html_unescape("html")).alias("text"))


@query(rf"SELECT page_id, md5({trimmed("regexp_replace(html, '<[^>]+>', '', 'g')")}) AS text FROM pages")
def strip_tags(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.strip_tags("html")).alias("text"))


@query(r"""SELECT page_id, regexp_extract_all(html, '(?is)<li>(.*?)</li>', 1) AS items, list_transform(regexp_extract_all(html, '(?is)<li>(.*?)</li>', 1), lambda x: trim(regexp_replace(x, '<.*?>', '', 'g'))) AS cleaned FROM pages""")
def extract_elements(spark, d):
    items = parser.all_of(F.col("html"), parser.tag("li"))
    return table(spark, d, "pages").select("page_id", items.alias("items"), F.transform(items, T.clean_element).alias("cleaned"))


@query(items_sql("SELECT doc_id AS script_id, text FROM documents").replace("script_id, pos, item", "script_id, item", 1))
def clean_numbered_list(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("script_id"), F.explode(T.numbered_items("text")).alias("item"))


@query("""SELECT doc_id, replace(CASE WHEN doc_id % 2 = 0 THEN 'Write a screenplay scene for the film ' ELSE 'Write a tagged screenplay for the film ' END || source
  || CASE WHEN doc_id % 2 = 0 THEN '. Story: ' ELSE '. Put every scene in scene tags, name speakers, and mark lines and actions. Story: ' END || text, '{', '{') AS prompt FROM documents""")
def render_prompt(spark, d):
    version = F.when(F.col("doc_id") % 2 == 0, "base").otherwise("instruction")
    return table(spark, d, "documents").select("doc_id", T.prompt(version, F.col("source"), F.col("text")).alias("prompt"))


@query("""SELECT DISTINCT c_nationkey, CASE c_nationkey % 6 WHEN 0 THEN 'internlm3-instruct' WHEN 1 THEN 'llama-scout' || c_nationkey WHEN 2 THEN 'o3' WHEN 3 THEN 'gemini' WHEN 4 THEN 'llama' ELSE 'internlm3' END AS shown,
  'a_b_' || c_nationkey AS path FROM customer""")
def display_names(spark, d):
    n = F.col("c_nationkey").cast("string")
    k = F.col("c_nationkey") % 6
    model = F.when(k == 0, "internlm3-8b-instruct").when(k == 1, F.concat(F.lit("meta_llama-4-scout"), n, F.lit("-17b-instruct"))).when(k == 2, "o3-mini").when(k == 3, "gemini-2.0-flash").when(k == 4, "meta_llama-instruct").otherwise("internlm3-8b")
    return table(spark, d, "customer").select("c_nationkey", T.display_name(model).alias("shown"), T.path_safe(F.concat(F.lit("a/b/"), n)).alias("path")).distinct()


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN o_totalprice WHEN 1 THEN -o_totalprice WHEN 2 THEN o_custkey * 10 WHEN 3 THEN o_custkey::DOUBLE WHEN 4 THEN NULL ELSE NULL END::DOUBLE AS value FROM orders""")
def lenient_floats(spark, d):
    k, price, cust = F.col("o_orderkey") % 6, F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.col("o_custkey").cast("string")
    s = F.when(k == 0, F.concat(F.lit(" "), price, F.lit("\n"))).when(k == 1, F.concat(F.lit("-"), price)).when(k == 2, F.concat(cust, F.lit("_0"))).when(k == 3, F.concat(cust, F.lit(".e0"))).when(k == 4, F.concat(cust, F.lit("d"))).otherwise(F.concat(cust, F.lit("_")))
    return table(spark, d, "orders").select("o_orderkey", T.python_float(s).alias("value"))


# --- Parsing --------------------------------------------------------------------------------------------------------


@query("SELECT conv_id AS script_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS pos, upper(role) AS character, text FROM conversations")
def parse_tagged_script(spark, d):
    return parser.parse(tagged(spark, d)).dialogues


@query("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
a AS (SELECT conv_id, 'At ' || role || ': ' || text AS text, 2 * k AS place FROM t UNION ALL SELECT conv_id, 'Then ' || text, 2 * k + 1 FROM t)
SELECT conv_id AS script_id, text, (row_number() OVER (PARTITION BY conv_id ORDER BY min(place)) - 1)::INT AS pos FROM a GROUP BY 1, 2""")
def parse_actions(spark, d):
    return parser.parse(tagged(spark, d)).actions


@query(r"SELECT conv_id AS script_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS pos, 'At ' || role || ': ' || text || '\nDusk.' AS text FROM conversations")
def parse_scenes(spark, d):
    heading = F.concat(F.lit("At "), F.col("role"), F.lit(": "), F.col("text"))
    return parser.parse(scripts_of(spark, d, el("Scene", el("scene_description", F.lit("Dusk.")), el("stage_direction", heading)))).scenes


@query("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM conversations)
SELECT conv_id AS script_id, (k - 1)::INT AS pos, upper(role) AS character, text || ' (aside)' || CASE WHEN after = role THEN ' (beat)' ELSE '' END AS text FROM t""")
def parse_parenthetical(spark, d):
    turn = el("scene", el("parenthetical", F.lit("lost")), el("character", F.col("role")), el("parenthetical", F.lit("beat")), el("dialogue", F.col("text")), el("parenthetical", F.lit("aside")))
    return parser.parse(scripts_of(spark, d, turn)).dialogues


PLAIN = r"""s AS (SELECT conv_id AS script_id, string_agg(upper(role) || ': ' || replace(text, chr(10), ' '), chr(10) || chr(10) ORDER BY turn) AS t FROM conversations GROUP BY 1),
p AS (SELECT script_id, regexp_split_to_array(t, '(?i)(?:INT|EXT)\.|FADE (?:IN|OUT):|\n\s*\n') AS parts FROM s),
n AS (SELECT script_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS i FROM p),
z AS (SELECT script_id, i, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS text FROM n WHERE regexp_replace(raw, '^\s+|\s+$', '', 'g') <> '')"""


@query(rf"""WITH {PLAIN}, x AS (SELECT script_id, i, unnest(regexp_extract_all(text, '(?m)^([A-Z](?:[A-Z0-9]|[ _-])+)[:. ]+(.+)$', 1)) AS c, unnest(regexp_extract_all(text, '(?m)^([A-Z](?:[A-Z0-9]|[ _-])+)[:. ]+(.+)$', 2)) AS t,
  generate_subscripts(regexp_extract_all(text, '(?m)^([A-Z](?:[A-Z0-9]|[ _-])+)[:. ]+(.+)$', 1), 1) AS j FROM z)
SELECT script_id, (row_number() OVER (PARTITION BY script_id ORDER BY i, j) - 1)::INT AS pos, {trimmed("c")} AS character, {trimmed("t")} AS text FROM x""")
def parse_plain_script(spark, d):
    return parser.parse_plain(plain(spark, d))[0]


@query(rf"""WITH {PLAIN}, r AS (SELECT script_id, i, {trimmed(r"regexp_replace(text, '(?m)^([A-Z](?:[A-Z0-9]|[ _-])+)[:. ]+(.+)$', '', 'g')")} AS text FROM z)
SELECT script_id, (row_number() OVER (PARTITION BY script_id ORDER BY i) - 1)::INT AS pos, text FROM r WHERE text <> ''""")
def parse_plain_actions(spark, d):
    return parser.parse_plain(plain(spark, d))[2]


def plain(spark, d):
    line = F.concat(F.when(F.col("turn") > 0, "\n\n").otherwise(""), F.upper("role"), F.lit(": "), F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))
    return scripts_of(spark, d, line)


@query(rf"SELECT doc_id AS script_id, 1 AS parsed, FALSE AS plain, 1::BIGINT AS n_scenes, 1::BIGINT AS n_actions, length({trimmed('text')}) AS n_chars FROM documents WHERE {trimmed('text')} <> ''")
def parse_fallback(spark, d):
    p = parser.parse(table(spark, d, "documents").select(F.col("doc_id").alias("script_id"), F.regexp_replace("text", "[<&]", "+").alias("script_segment"))).kept()
    n = p.scenes.groupBy("script_id").agg(F.count("*").alias("n_scenes"), F.sum(F.length("text")).alias("n_chars"))
    return p.scripts.join(n, "script_id").join(p.actions.groupBy("script_id").agg(F.count("*").alias("n_actions")), "script_id")


@query(rf"""WITH {PLAIN}, x AS (SELECT script_id, i, unnest(regexp_extract_all(text, '(?m)^([A-Z](?:[A-Z0-9]|[ _-])+)[:. ]+(.+)$', 1)) AS c, unnest(regexp_extract_all(text, '(?m)^([A-Z](?:[A-Z0-9]|[ _-])+)[:. ]+(.+)$', 2)) AS t,
  generate_subscripts(regexp_extract_all(text, '(?m)^([A-Z](?:[A-Z0-9]|[ _-])+)[:. ]+(.+)$', 1), 1) AS j FROM z)
SELECT script_id, TRUE AS plain, (row_number() OVER (PARTITION BY script_id ORDER BY i, j) - 1)::INT AS pos, {trimmed("c")} AS character, {trimmed("t")} AS text FROM x""")
def parse_plain_fallback(spark, d):
    """A scene without anything in it: the plain parser takes over."""
    s = plain(spark, d).withColumn("script_segment", F.concat(F.lit("<scene> </scene>\n\n"), F.col("script_segment")))
    p = parser.parse(s).kept()
    return p.dialogues.join(p.scripts.select("script_id", "plain"), "script_id")


@query("SELECT doc_id AS script_id, CASE WHEN doc_id % 4 < 2 THEN 0 ELSE 1 END AS parsed, doc_id % 4 = 2 AS plain FROM documents")
def parse_flags(spark, d):
    k = F.col("doc_id") % 4
    text = F.when(k == 1, "").when(k == 2, "<scene></scene>").when(k == 3, F.concat(F.lit("x"), F.regexp_replace("text", "[<&]", "+")))
    return parser.parse(table(spark, d, "documents").select(F.col("doc_id").alias("script_id"), text.alias("script_segment"))).scripts


@query("SELECT conv_id AS script_id, upper(role) AS character, list(text ORDER BY turn) AS lines FROM conversations GROUP BY 1, 2")
def dialogues_by_character(spark, d):
    return parser.by_character(dialogues(spark, d))


@query("SELECT script_id, line, min(pos)::INT AS pos FROM (SELECT doc_id AS script_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents) GROUP BY 1, 2")
def dedup_actions(spark, d):
    lines = table(spark, d, "documents").select(F.col("doc_id").alias("script_id"), F.split("text", "\n").alias("all"))
    once = lines.select("script_id", "all", F.explode(F.array_distinct("all")).alias("line"))
    return once.select("script_id", "line", (F.array_position("all", F.col("line")) - 1).cast("int").alias("pos"))


# --- Metrics --------------------------------------------------------------------------------------------------------


@query(pick(f"{D}, {DC1}", "dc1"))
def dc1(spark, d):
    return rounded(M.dc1(dialogues(spark, d)))


@query(pick(f"{D}, {DC2}", "dc2"))
def dc2(spark, d):
    return rounded(M.dc2(dialogues(spark, d)))


@query(pick(f"{D}, {DC3}", "dc3"))
def dc3(spark, d):
    return rounded(M.dc3(dialogues(spark, d)))


@query(pick(f"{D}, {CC1}", "cc1"))
def cc1(spark, d):
    return rounded(M.cc1(dialogues(spark, d)))


@query(pick(f"{D}, {CC2}", "cc2"))
def cc2(spark, d):
    return rounded(M.cc2(dialogues(spark, d)))


@query(pick(f"{D}, {cc3_sql('SELECT script_id, v FROM d WHERE character = ' + chr(39) + 'ASSISTANT' + chr(39))}", "cc3"))
def cc3(spark, d):
    c = dialogues(spark, d)
    return rounded(M.cc3(c, c.where("character = 'ASSISTANT'")))


@query(pick(f"d AS (SELECT script_id, pos, {letters('text')} AS v FROM (SELECT doc_id AS script_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) WHERE text <> ''), {DC1}", "dc1"))
def pr1(spark, d):
    return rounded(M.pr1(document_lines(spark, d)))


@query(pick(pr2_sql("SELECT doc_id AS script_id, text FROM documents WHERE text <> ''"), "pr2"))
def pr2(spark, d):
    scenes = table(spark, d, "documents").select(F.col("doc_id").alias("script_id"), F.lit(0).alias("pos"), "text")
    return rounded(M.pr2(scenes, scenes.where("false")))


SCENES = "SELECT conv_id AS script_id, string_agg('At ' || role || ': ' || text, chr(10) || '---' || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1"
ACTIONS = f"SELECT DISTINCT script_id, text, {letters('text')} AS v FROM (SELECT conv_id AS script_id, 'At ' || role || ': ' || text AS text FROM conversations UNION ALL SELECT conv_id, 'Then ' || text FROM conversations)"
PR1 = f"sc AS (SELECT conv_id AS script_id, turn AS pos, {letters("'At ' || role || ': ' || text")} AS v FROM conversations), pr1 AS (SELECT script_id, avg({cos('v', 'w')}) AS score FROM (SELECT *, lead(v) OVER (PARTITION BY script_id ORDER BY pos) AS w FROM sc) WHERE w IS NOT NULL GROUP BY 1)"


@query(
    f"WITH {D}, {DC1}, {DC2}, {DC3}, {CC1}, {CC2}, {cc3_sql(ACTIONS)}, {PR1}, {pr2_sql(SCENES)} SELECT s.script_id, 1 AS regex_parsing_successful, "
    + ", ".join(f"round(coalesce({m[:3]}.score, 0.0), 6) AS {m}" for m in M.METRICS)
    + " FROM (SELECT DISTINCT conv_id AS script_id FROM conversations) s "
    + " ".join(f"LEFT JOIN {m[:3]} USING (script_id)" for m in M.METRICS)
)
def score_scripts(spark, d):
    s = M.score(parser.parse(tagged(spark, d)))
    return s.select("script_id", "regex_parsing_successful", *[F.round(m, 6).alias(m) for m in M.METRICS])


@query("SELECT n_nationkey AS script_id, 0 AS regex_parsing_successful, " + ", ".join(f"0.0::DOUBLE AS {m}" for m in M.METRICS) + " FROM nation")
def score_empty_scripts(spark, d):
    text = F.when(F.col("n_nationkey") % 2 == 0, "").when(F.col("n_nationkey") % 3 == 0, " \n ")
    return M.score(parser.parse(table(spark, d, "nation").select(F.col("n_nationkey").alias("script_id"), text.alias("script_segment"))))


V = "SELECT label AS script_id, vec_id AS pos, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings"


def vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("label").alias("script_id"), F.col("vec_id").alias("pos"), F.col("embedding").cast("array<double>").alias("v"))


@query(pick(f"d AS ({V}), {DC1}", "dc1"))
def adjacent_similarity_vec(spark, d):
    return rounded(M.adjacent(vectors(spark, d), cosine))


@query(pick(f"d AS ({V}), {concentration_sql('c', 'd', 'script_id', 2)}", "c_s"))
def centroid_consistency_vec(spark, d):
    return rounded(M.concentration(["script_id"], vectors(spark, d), 2, 2))


@query(f"WITH d AS ({V}) SELECT a.script_id, a.pos, round(max({cos('a.v', 'b.v')}), 6) AS best FROM d a JOIN d b ON a.script_id = b.script_id AND a.pos % 2 = 0 AND b.pos % 2 = 1 GROUP BY 1, 2 HAVING max({cos('a.v', 'b.v')}) > 0")
def best_match_vec(spark, d):
    v = vectors(spark, d)
    return M.best_match(v.where("pos % 2 = 0"), v.where("pos % 2 = 1")).select("script_id", "pos", F.round("best", 6).alias("best"))


# --- Score tables ---------------------------------------------------------------------------------------------------


@query("SELECT source AS file, round(avg(n_chars), 6) AS n_chars, round(avg(quality), 6) AS quality, round(avg(toxic), 6) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def average_scores(spark, d):
    j = table(spark, d, "documents").select("doc_id", F.col("source").alias("file"), "n_chars").join(table(spark, d, "labels"), "doc_id").drop("doc_id")
    a = scores.averages(j)
    return a.select("file", *[F.round(k, 6).alias(k) for k in a.columns[1:]])


GENRES = "SELECT p_partkey AS imdb_id, p_size::DOUBLE AS p_size, p_retailprice, unnest(string_split(p_name, ' ')) AS genre FROM part"


def genre_rows(spark, d):
    p = table(spark, d, "part").withColumnRenamed("p_partkey", "imdb_id")
    genres = p.select("imdb_id", F.split("p_name", " ").alias("genres"), F.lit(0).alias("pos"))
    return scores.with_genres(p.select("imdb_id", F.col("p_size").cast("double").alias("p_size"), "p_retailprice"), genres)


@query(GENRES)
def genre_explode(spark, d):
    return genre_rows(spark, d)


LONG = f"WITH g AS ({GENRES}), l AS (SELECT genre, 'p_size' AS metric, p_size AS score FROM g UNION ALL SELECT genre, 'p_retailprice', p_retailprice FROM g)"


@query(f"{LONG} SELECT genre, metric, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS std, count(*) AS n FROM l GROUP BY 1, 2")
def genre_mean_std(spark, d):
    long = scores.long_scores(genre_rows(spark, d), ["genre"], ["p_size", "p_retailprice", "absent"])
    return scores.mean_and_std(long, ["genre", "metric"]).withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(f"{LONG} SELECT genre, 'ALL' AS family, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS std, count(*) AS n FROM l GROUP BY 1")
def family_mean_std(spark, d):
    long = scores.long_scores(genre_rows(spark, d), ["genre"], ["p_size", "p_retailprice"]).withColumn("family", scores.families({"ALL": ["p_size", "p_retailprice"]}))
    return scores.mean_and_std(long, ["genre", "family"]).withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("SELECT p_partkey, round(CASE WHEN p_size % 2 = 0 THEN p_retailprice ELSE (p_size + p_retailprice) / 2 END, 6) AS mean FROM part")
def row_family_mean(spark, d):
    p = table(spark, d, "part").withColumn("size", F.when(F.col("p_size") % 2 == 1, F.col("p_size").cast("double")))
    return p.select("p_partkey", F.round(scores.row_mean(["size", "p_retailprice"]), 6).alias("mean"))


@query("""WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3, avg(l_extendedprice) AS mean, count(*) AS n FROM lineitem GROUP BY 1),
j AS (SELECT q.*, l_extendedprice AS v, l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM q JOIN lineitem USING (l_returnflag))
SELECT l_returnflag, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, min(v) FILTER (WHERE ok) AS low, max(v) FILTER (WHERE ok) AS high, round(mean, 4) AS mean, n, count(*) FILTER (WHERE NOT ok) AS n_outliers FROM j GROUP BY ALL""")
def boxplot_stats(spark, d):
    b = scores.box(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return b.withColumns({k: F.round(k, 4) for k in ("q1", "median", "q3", "mean")})


@query("""WITH f AS (SELECT lower(p_brand) AS model, CASE p_type WHEN 'ECONOMY' THEN 'base' WHEN 'LARGE' THEN 'rag' WHEN 'MEDIUM' THEN 'instruction' END AS a, p_retailprice AS v, p_partkey AS k FROM part)
SELECT model, arg_max(v, k) FILTER (WHERE a = 'base') AS base, arg_max(v, k) FILTER (WHERE a = 'rag') AS rag, arg_max(v, k) FILTER (WHERE a = 'instruction') AS instruction FROM f WHERE a IS NOT NULL GROUP BY 1""")
def ablation_pivot(spark, d):
    kind = F.when(F.col("p_type") == "ECONOMY", "base").when(F.col("p_type") == "LARGE", "rag").when(F.col("p_type") == "MEDIUM", "instruction").otherwise("small")
    p = table(spark, d, "part").withColumn("file", F.concat(F.lower("p_brand"), F.lit("_"), kind, F.lit(".csv")))
    p = p.select(T.file_model("file").alias("model"), T.file_ablation("file").alias("ablation"), "p_retailprice", "p_partkey").where("model <> ''")
    return scores.ablation_pivot(p, "model", "ablation", "p_retailprice", "p_partkey", ["base", "rag", "instruction"])


@query("WITH r AS (SELECT min(least(p_size / 100, p_retailprice / 4000)) AS lo, max(greatest(p_size / 100, p_retailprice / 4000)) AS hi FROM part) SELECT round(greatest(0, lo - greatest((hi - lo) * 0.1, 0.02)), 6) AS lower, round(least(1.05, hi + greatest((hi - lo) * 0.1, 0.02)), 6) AS upper FROM r")
def axis_range(spark, d):
    p = table(spark, d, "part").select((F.col("p_size") / 100).alias("rag"), (F.col("p_retailprice") / 4000).alias("instruction"))
    return scores.axis_range(p, ["rag", "instruction"]).select(F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


@query("SELECT n_name, round((row_number() OVER (ORDER BY n_name) - 1) * 0.6 / (count(*) OVER () - 1) - 0.3, 6) AS \"offset\" FROM nation")
def layout_offsets(spark, d):
    return scores.offsets(table(spark, d, "nation"), "n_name").withColumn("offset", F.round("offset", 6))


CUSTOMERS = "c AS (SELECT o_custkey, count(*)::DOUBLE AS n, sum(o_totalprice) AS total, max(o_totalprice) AS most FROM orders GROUP BY 1)"


def customers(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").cast("double").alias("n"), F.round(F.sum("o_totalprice"), 4).alias("total"), F.max("o_totalprice").alias("most"))


def rank_sql(value: str) -> str:
    return f"rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / 2"


@query(f"WITH {CUSTOMERS} SELECT round(corr(a, b), 6) AS rho, count(*) AS n FROM (SELECT {rank_sql('n')} AS a, {rank_sql('round(total, 4)')} AS b FROM c)")
def spearman(spark, d):
    return scores.spearman(customers(spark, d), "n", "total").select(F.round("rho", 6).alias("rho"), "n")


@query(f"WITH {CUSTOMERS} SELECT round(corr(a, b), 6) AS rho, count(*) AS n FROM (SELECT {rank_sql('round((n + most) / 2, 4)')} AS a, {rank_sql('round((total + n) / 2, 4)')} AS b FROM c)")
def overall_correlation(spark, d):
    c = customers(spark, d).select(F.round((F.col("n") + F.col("most")) / 2, 4).alias("x"), F.round((F.col("total") + F.col("n")) / 2, 4).alias("y"))
    return scores.overall(c, ["x"], ["y"]).select(F.round("rho", 6).alias("rho"), "n")


# The two-sided p-value by the finite sum that the t-distribution has for odd degrees of freedom, of which there are 23.
@query(f"""WITH RECURSIVE c AS (SELECT c_nationkey, count(*)::DOUBLE AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1),
r AS (SELECT corr(a, b) AS rho, count(*) AS n FROM (SELECT {rank_sql('n')} AS a, {rank_sql('total')} AS b FROM c)),
a AS (SELECT rho, n, atan(abs(rho) * sqrt((n - 2) / (1 - rho * rho)) / sqrt(n - 2)) AS angle FROM r),
k AS (SELECT 1 AS k, 1.0::DOUBLE AS factor UNION ALL SELECT k + 1, factor * (2.0 * k) / (2 * k + 1) FROM k WHERE k < 11)
SELECT round(rho, 6) AS rho, n, round(1 - 2 / pi() * (angle + sin(angle) * sum(factor * pow(cos(angle), 2 * k - 1))), 6) AS p_value FROM a, k GROUP BY rho, n, angle""")
def correlation_p_value(spark, d):
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").cast("double").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))
    return scores.overall(c, ["n"], ["total"]).select(F.round("rho", 6).alias("rho"), "n", F.round("p_value", 6).alias("p_value"))


@query("SELECT user_id, round(avg(abs(value - p)), 6) AS mean_step FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) GROUP BY 1")
def emotion_diff(spark, d):
    return scores.sequence_diff(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value").withColumn("mean_step", F.round("mean_step", 6))


@query("SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations) WHERE k <= 2")
def first_n_per_group(spark, d):
    return scores.first_n(table(spark, d, "conversations"), ["conv_id", "role"], ["turn"], 2)


@query("SELECT count(*) AS processed, count(*) FILTER (WHERE n_chars <= 50) AS unparsed, count(*) FILTER (WHERE quality IS NULL) AS unreadable FROM documents LEFT JOIN labels USING (doc_id)")
def run_counters(spark, d):
    j = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    return scores.counters(j, F.col("n_chars") > 50, F.col("quality").isNull())


# --- Inference ------------------------------------------------------------------------------------------------------


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'google' WHEN 'view' THEN 'openai' WHEN 'error' THEN 'nvidia' WHEN 'signup' THEN 'intern' END AS provider FROM events")
def route_provider(spark, d):
    model = F.when(F.col("event_type") == "click", "x/Gemini-2").when(F.col("event_type") == "view", "GPT-4o").when(F.col("event_type") == "error", providers.ROUTES[3][1][0]).when(F.col("event_type") == "signup", "internlm3-8b-instruct").otherwise("unknown")
    return table(spark, d, "events").select("event_id", providers.route(model).alias("provider"))


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)")
def cache_anti(spark, d):
    cache = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "answer").otherwise("").alias("response"))
    return providers.unanswered(table(spark, d, "documents").select("doc_id", "source"), cache, ["doc_id"])


@query("SELECT doc_id, CASE WHEN length(text) % 2 = 0 THEN 1 WHEN length(text) % 3 = 0 THEN -1 WHEN length(text) % 5 = 0 THEN 0 ELSE 9 END AS emotion, length(text) % 2 = 0 AS yes FROM documents")
def labels_of_answers(spark, d):
    n = F.length("text")
    said = F.when(n % 2 == 0, "Neutral to POSITIVE").when(n % 3 == 0, "neutral, negative").when(n % 5 == 0, "Neutral.").otherwise("none")
    yes = F.when(n % 2 == 0, " Yes \n").otherwise("yes.")
    return table(spark, d, "documents").select("doc_id", F.coalesce(providers.emotion_of(said), F.lit(9)).alias("emotion"), providers.label_of(yes).alias("yes"))


class LetterModel:
    """What a loaded model has to offer; this one counts letters and words."""

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [[float(t.count(x)) for x in "aeiou"] for t in texts]

    def answer(self, prompts: list[str]) -> list[str]:
        return [{"Q": "Yes" if len(p) % 2 == 0 else "no", "I": " YES " if len(p) % 3 else "no", "E": "positive" if len(p) % 2 else "NEGATIVE", "L": "1. first event of it\n2. then another one\n3. short"}[p[0]] for p in prompts]


@query(f"""SELECT conv_id, turn, [{", ".join(f"(length(t) - length(replace(t, '{x}', '')))::DOUBLE" for x in "aeiou")}] AS v, (length(s) + 1) % 2 = 0 AS is_question, (length(s) + 1) % 3 <> 0 AS has_intent,
  CASE WHEN (length(s) + length(role) + 1) % 2 = 1 THEN 1 ELSE -1 END AS emotion, ['first event of it', 'then another one'] AS events
FROM (SELECT *, regexp_replace(text, '<[^>]+>', '', 'g') AS t, substr(text, 1, 500) AS s FROM conversations) WHERE text <> ''""")
def model_answers(spark, d):
    m = providers.Models(LetterModel, 5, "Q{text}", "I{text}", "E{char}{text}", "L{text}")
    c, text = table(spark, d, "conversations").where("text <> ''"), F.col("text")
    return c.select("conv_id", "turn", m.embed(text).alias("v"), m.is_question(text).alias("is_question"), m.has_intent(text).alias("has_intent"), m.emotion(F.col("role"), text).alias("emotion"), m.events(text).alias("events"))


# --- Files ----------------------------------------------------------------------------------------------------------


def folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def as_files(df: DataFrame, key: str, order: list[str], name: str) -> str:
    """A folder with a text file for each ``key``, of the column ``value``: its path with ``{key}`` put into ``name``."""
    spark, path = df.sparkSession, folder(df.sparkSession)
    df.repartition(key).sortWithinPartitions(key, *order).select("value", key).write.partitionBy(key).text(f"{path}-parts")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source = hadoop.Path(f"{path}-parts")
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in (s for k in fs.listStatus(source) if k.isDirectory() for s in fs.listStatus(k.getPath()) if s.getPath().getName().endswith(".txt")):
        to = hadoop.Path(path, name.replace("{key}", part.getPath().getParent().getName().split("=", 1)[1]))
        fs.mkdirs(to.getParent())
        fs.rename(part.getPath(), to)
    fs.delete(source, True)
    return path


@query("""WITH c AS (SELECT *, conv_id % 5 AS f, row_number() OVER (PARTITION BY conv_id % 5 ORDER BY conv_id, turn) AS p FROM conversations)
SELECT f::INT AS f, p AS physical_line, row_number() OVER (PARTITION BY f ORDER BY p)::INT AS line_number, CASE WHEN f <> 4 AND turn % 5 = 2 THEN 'Error_Line_' || p ELSE role END AS movie_name,
  CASE WHEN f = 4 OR turn % 5 = 2 THEN 'N/A' ELSE 'tt' || conv_id END AS imdb_id, CASE WHEN f <> 4 AND turn % 5 = 2 THEN '' ELSE text END AS script_segment
FROM c WHERE f = 4 OR turn % 4 <> 3""")
def files_scripts(spark, d):
    """Two roots, one of JSON lines with blank and broken ones, one of a JSON array."""
    c = table(spark, d, "conversations").withColumn("f", F.col("conv_id") % 5)
    good = F.to_json(F.struct(F.col("role").alias("movie_name"), F.concat(F.lit("tt"), F.col("conv_id").cast("string")).alias("imdb_id"), F.col("text").alias("script_segment")))
    value = F.when(F.col("turn") % 4 == 3, " \t").when(F.col("turn") % 5 == 2, F.concat(F.lit("{broken"), F.col("role"))).otherwise(good)
    lines = as_files(c.where("f <> 4").withColumn("value", value), "f", ["conv_id", "turn"], "deep/{key}/f{key}.jsonl")
    items = F.to_json(F.array_sort(F.collect_list(F.struct("conv_id", "turn", F.col("role").alias("movie_name"), F.col("text").alias("response")))))
    arrays = as_files(c.where("f = 4").groupBy("f").agg(items.alias("value")), "f", [], "f{key}.json")
    r = files.read_scripts(spark, f" {lines} , {arrays}")
    return r.select(F.regexp_extract("source_file", r"f(\d)\.jsonl?$", 1).cast("int").alias("f"), "physical_line", "line_number", "movie_name", "imdb_id", "script_segment")


@query("""SELECT 's' || conv_id % 7 || '.csv' AS file, role AS movie_name, 'tt' || conv_id AS imdb_id, turn::VARCHAR AS line_number, '1' AS regex_parsing_successful, (conv_id % 10)::DOUBLE / 8 AS dc1, 0.0::DOUBLE AS pr2 FROM conversations""")
def files_scores(spark, d):
    """Score tables at their sources' places below two folders, read as text."""
    place = F.concat(F.lit("/in/f"), (F.col("conv_id") % 7 % 2).cast("string"), F.lit("/s"), (F.col("conv_id") % 7).cast("string"), F.lit(".jsonl"))
    s = table(spark, d, "conversations").select(place.alias("source_file"), F.col("role").alias("movie_name"), F.concat(F.lit("tt"), F.col("conv_id").cast("string")).alias("imdb_id"), F.col("turn").alias("line_number"), F.lit(1).alias("regex_parsing_successful"), *[((F.col("conv_id") % 10) / 8 if k == 0 else F.lit(None).cast("double")).alias(m) for k, m in enumerate(M.METRICS)])
    path = folder(spark)
    sinks.write_scores(s, path, "/in")
    r = files.read_csv(spark, [f"{path}/f0", f"{path}/f1"])
    return r.select("file", "movie_name", "imdb_id", "line_number", "regex_parsing_successful", F.col(M.METRICS[0]).cast("double").alias("dc1"), F.col(M.METRICS[-1]).cast("double").alias("pr2"))


@query("SELECT source, round(avg(n_chars), 6) AS n_chars, round(avg(quality), 6) AS quality FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def files_averages(spark, d):
    j = table(spark, d, "documents").select("doc_id", F.col("source").alias("file"), "n_chars").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id").drop("doc_id")
    path = folder(spark)
    sinks.write_averages(scores.averages(j).withColumnRenamed("file", "source"), path, "source")
    r = files.read_csv(spark, path, "source string, n_chars double, quality double")
    return r.select("source", F.round("n_chars", 6).alias("n_chars"), F.round("quality", 6).alias("quality"))


@query(f"SELECT genre, count(*) AS n, round(sum(p_retailprice), 4) AS total FROM ({GENRES}) GROUP BY 1")
def files_by_genre(spark, d):
    path = folder(spark)
    sinks.write_by_genre(genre_rows(spark, d), path)
    r = spark.read.option("header", True).schema("imdb_id bigint, p_size double, p_retailprice double, genre string").csv(path)
    return r.groupBy("genre").agg(F.count("*").alias("n"), F.round(F.sum("p_retailprice"), 4).alias("total"))


@query("SELECT n_nationkey::VARCHAR AS imdb_id, string_split(n_name, ' ') AS genres, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos FROM nation")
def files_genres(spark, d):
    """One JSON object with all films."""
    path = folder(spark)
    films = F.array_sort(F.collect_list(F.struct("n_nationkey", F.col("n_nationkey").cast("string").alias("imdb_id"), F.split("n_name", " ").alias("genres"))))
    table(spark, d, "nation").agg(films.alias("individual_results")).write.json(path)
    return files.read_genres(spark, path).withColumn("pos", F.col("pos").cast("long"))


@query("SELECT role AS movie_name, 'tt' || conv_id AS imdb_id, turn, text AS response FROM conversations")
def files_responses(spark, d):
    """Answers as JSON lines, their prompts from a file of films."""
    c = table(spark, d, "conversations").select(F.col("role").alias("movie_name"), F.concat(F.lit("tt"), F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("imdb_id"), F.col("text").alias("summary"))
    films, answers = folder(spark), folder(spark)
    c.write.json(films)
    sinks.write_responses(files.read_movies(spark, films).withColumnRenamed("summary", "response"), answers)
    r = spark.read.schema("movie_name string, imdb_id string, response string").json(answers)
    both = F.split("imdb_id", ":")
    return r.select("movie_name", both[0].alias("imdb_id"), both[1].cast("long").alias("turn"), "response")


@query("SELECT n_nationkey::VARCHAR AS imdb_id, 'Answer of ' || n_name AS response FROM nation WHERE n_nationkey % 3 <> 0")
def files_cache(spark, d):
    """Answers as texts by their ids, and those of them that a cache table takes in."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 6 == 0, "ERROR: none").when(F.col("n_nationkey") % 3 == 0, "").otherwise(F.concat(F.lit("Answer of "), F.col("n_name"))).alias("value"))
    texts, path = as_files(n, "id", [], "a/{key}.txt"), folder(spark)
    sinks.add_to_cache(files.read_cache(spark, texts).withColumn("response", F.rtrim(F.col("response"), F.lit("\n"))), path)
    return spark.read.parquet(path)

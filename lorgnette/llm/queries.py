"""The queries of this subpackage: each operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from lorgnette.llm import bpe, chat, decontaminate, html, jaccard, langid, line_dedup, quality, secrets, substring
from lorgnette.llm.common import table

QUERIES = {
    "op1_secret_scan": lambda spark, d: secrets.scan(table(spark, d, "documents")),
    "op2_quality_rules": lambda spark, d: quality.accepted(table(spark, d, "documents")),
    "op3_html_extraction": lambda spark, d: html.extract(table(spark, d, "pages")),
    "op4_language_id": lambda spark, d: langid.identify(table(spark, d, "documents")),
    "op5_ngram_jaccard_join": lambda spark, d: jaccard.near_duplicates(table(spark, d, "documents")),
    "op6_benchmark_decontamination": lambda spark, d: decontaminate.leaks(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op7_line_dedup": lambda spark, d: line_dedup.dedup_lines(table(spark, d, "documents")),
    "op8_substring_dedup": lambda spark, d: substring.repeated_spans(table(spark, d, "documents")),
    "op9_chat_formatting": lambda spark, d: chat.format_chats(table(spark, d, "conversations")),
    "op10_bpe_encoding": lambda spark, d: bpe.encode_documents(table(spark, d, "documents")),
}
SQL = {"op7_line_dedup": line_dedup.DEDUP_SQL, "op9_chat_formatting": chat.CHAT_SQL}

"""Registered queries of the training-data operators and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from dayrisk.llm import alignment, chat, exact_dedup, html_extract, language_id, line_dedup, merkle, near_dedup, packing, pieces, quality, secret_scan, toxicity
from dayrisk.llm.common import read_table
from dayrisk.llm.merkle_sql import check_documents_sql
from dayrisk.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register ``fn`` under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    run.__doc__, run.__name__ = fn.__doc__, fn.__name__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every document, decoded again."""
    return pieces.encode_documents(read_table(spark, folder, "documents"))


@query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(read_table(spark, folder, "documents"))


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality.judge_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    return language_id.identify_documents(read_table(spark, folder, "documents"))


@query
def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract_pages(read_table(spark, folder, "pages"))


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every page without the lines that many pages of its host carry."""
    return line_dedup.drop_site_lines(read_table(spark, folder, "pages"))


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lines_sql() -> str:
    shown = "coalesce(html, '')"
    for pattern, new in ((line_dedup.HIDDEN, "''"), (line_dedup.BREAKS, "chr(10)"), ("<[^>]*>", "''")):
        shown = f"regexp_replace({shown}, {_sql(pattern)}, {new}, 'g')"
    for name, sign in line_dedup.REFERENCES:
        shown = f"replace({shown}, {_sql(name)}, {_sql(sign)})"
    neat = "trim(regexp_replace(x, '[ \\t\\r\\f\\x0B]+', ' ', 'g'), ' ')"
    return f"[y for y in [{neat} for x in string_split({shown}, chr(10))] if y <> '']"


SQL["op6_line_dedup"] = f"""
WITH p AS (SELECT page_id, url, nullif(lower(regexp_extract(url, {_sql(line_dedup.HOST)}, 1)), '') AS host, {_lines_sql()} AS lines FROM pages),
totals AS (SELECT host, count(*) AS pages FROM p WHERE host IS NOT NULL GROUP BY host),
seen AS (SELECT host, line, count(*) AS seen FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p WHERE host IS NOT NULL) GROUP BY host, line),
bad AS (SELECT host, list(line) AS boilerplate FROM seen JOIN totals USING (host) WHERE seen > {line_dedup.RATIO} * pages AND seen >= {line_dedup.LEAST_CARRIERS} GROUP BY host),
kept AS (SELECT page_id, url, p.host, lines, [x for x in lines if NOT list_contains(coalesce(boilerplate, []), x)] AS stay FROM p LEFT JOIN bad ON p.host = bad.host)
SELECT page_id, url, host, len(lines) AS n_lines, len(lines) - len(stay) AS n_dropped, array_to_string(stay, chr(10)) AS text FROM kept
"""


@query
def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """What every formatted conversation says when it is read back."""
    return chat.conversation_digests(chat.format_turns(chat.with_probe(spark, read_table(spark, folder, "conversations")))).drop("n_tokens")


def _formatted_chars_sql() -> str:
    """Characters of a turn's form: its brackets, its texts, and one more for each control string in them."""
    controls = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in chat.CONTROLS)
    said = lambda c: f"length({c}) + len(regexp_extract_all({c}, {_sql(controls)}))"
    frames = " ".join(f"WHEN {_sql(role)} THEN {len(a) + len(b)}" for role, (a, b) in chat.FORMS.items())
    return f"{said('text')} + CASE role {frames} ELSE {len('[ROLE][/ROLE][END]')} + {said('role')} END"


SQL["op7_chat_formatting"] = f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({_formatted_chars_sql()})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


@query
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The group of equal texts that every document belongs to."""
    return exact_dedup.exact_groups(read_table(spark, folder, "documents"))


SQL["op8_exact_dedup"] = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
g AS (SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""


@query
def op9_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near-duplicates that every document belongs to."""
    return near_dedup.near_groups(read_table(spark, folder, "documents")).drop("text_key")


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document."""
    return toxicity.score_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query
def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, by patterns and by the fitted field."""
    return secret_scan.scan_documents(read_table(spark, folder, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that its proof leads to after tampering."""
    return merkle.check_documents(read_table(spark, folder, "documents"))


SQL["op12_merkle_manifest"] = check_documents_sql()


@query
def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of two tokenizers lie over each other in every document, and how common their links are."""
    return alignment.align_documents(read_table(spark, folder, "documents"))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline, one after the other."""
    return corpus_pipeline.run(spark, folder)

"""Queries over whole documents: repeated lines, shards, licences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import decision_lists, licenses, line_runs, ring
from lodestrata.llm.license_texts import KNOWN, SPELLINGS
from lodestrata.llm.registry import query, table
from lodestrata.session import scratch_folder

LINE_SQL = r"""
WITH documents_ AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines_ AS (
  SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM documents_
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines_
), common AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 AND doc_id IS NOT NULL
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, coalesce(c.last <> k.doc_id, false) AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY rid
"""


@query(LINE_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that three or more of them hold."""
    cleaned = line_runs.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op7_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 40 shards whose row counts are at most one apart."""
    rows = ring.assign(table(spark, sf_dir, "documents"), shards=40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    form = f"coalesce({text}, '')"
    for pattern, by in ((licenses.NO_HOLDER, r"copyright\1\2"), (licenses.HOLDER, r"\1\2copyright 1999 \3")):
        form = f"regexp_replace({form}, {_quoted(pattern)}, '{by}', 'g')"
    form = f"translate({form}, '{licenses.UPPER}', '{licenses.LOWER}')"
    for pattern, by in ((licenses.COPYRIGHT_SENTENCE, r"\1\4"),) * 2 + ((licenses.COPYRIGHT_LINE, r"\1"), (licenses.SIGNS, " ")):
        form = f"regexp_replace({form}, {_quoted(pattern)}, '{by}', 'g')"
    form = f"trim(regexp_replace({form}, {_quoted(licenses.LINE_ENDS)}, chr(10), 'g'), ' ' || chr(10))"
    for word, same in SPELLINGS:
        form = f"regexp_replace({form}, '\\b{word}\\b', '{same}', 'g')"
    return form


LICENSE_SQL = f"""
WITH texts(license, text) AS (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in KNOWN)}),
known AS (
  SELECT DISTINCT license, sha256(replace({_canonical_sql("text")}, chr(10), ' ')) AS digest FROM texts
), forms AS (
  SELECT row_number() OVER () AS rid, doc_id, {_canonical_sql("text")} AS form FROM documents
), lines_ AS (
  SELECT DISTINCT rid, unnest(string_split(form, chr(10))) AS line FROM forms
), hits AS (
  SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM lines_ JOIN known ON sha256(line) = digest GROUP BY rid
)
SELECT doc_id, sha256(replace(form, chr(10), ' ')) AS digest, license, coalesce(notices, '') AS notices
FROM forms LEFT JOIN known ON sha256(replace(form, chr(10), ' ')) = digest LEFT JOIN hits USING (rid)
"""


@query(LICENSE_SQL)
def op10_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: canonical digest, the licence that the entire text is, and the licences of its lines."""
    scanned = licenses.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", "digest", "license", F.array_join("notices", ",").alias("notices"))


@query()
def op13_decision_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: counts of words, signs and repetitions, and the verdict of the learned list."""
    rows, _ = decision_lists.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), scratch_folder(spark))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

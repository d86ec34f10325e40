"""Licence texts found by the digest of their canonical form, with Spark's own functions only.

Canonical form: A-Z in lower case; lines that begin, but for signs, with a copyright mark (the word with "(c)", the sign,
a year or, written Copyright, a capitalised holder; "(c)" with a year; the sign) or with "all rights reserved" are taken out;
signs and white space of any script become one space; equivalent spellings become one. Where much more text follows the
first sentence of such a line, only that sentence is taken out, so that a text on one line is not lost with it; a holder whose
name has a full stop ("Inc.") then leaves the rest of the name behind. The form of a text keeps its line ends, so that its lines
are in canonical form too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import stored
from lodestrata.llm.license_texts import KNOWN, SPELLINGS

#: Digests of known texts that are handed to every task.
LISTED = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A holder without a year, written out before the text is lowered: what is marked so begins like other copyright lines.
HOLDER = r"(^|\n)([^A-Za-z0-9\n]*)Copyright[ \t]+((?:The[ \t]+)?[A-Z])"
NO_HOLDER = r"\bCopyright([ \t]+)(Notice|Holder|Owner|License|Law|Act|Statement|Office|Status|Disclaimer|Protection|And|Or|In|Of)"
MARK = r"(copyright[ \t]*(\(c\)|\x{a9}|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|\x{a9}|all rights reserved)"
#: The first sentence of a copyright line with much more text on it, and a copyright line with the line end before it.
COPYRIGHT_SENTENCE = rf"(^|\n)[^a-z0-9\n]*{MARK}[^\n.]*\.[ \t]+([^\n]{{160}})"
COPYRIGHT_LINE = rf"(^|\n)[^a-z0-9\n]*{MARK}[^\n]*"
#: Signs and white space of any script other than the line end.
SIGNS = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x{9f}\pP\pS\pZ\p{Cf}]+"
LINE_ENDS = r" ?\n[ \n]*"


MARKED = r"copyright|\(c\)|\x{a9}|all rights reserved"
SPELLED = r"\b(" + "|".join(p for p, _ in SPELLINGS) + r")\b"


def one_spelling(text: Column) -> Column:
    """Equivalent spellings replaced, whole words only, one pair after another."""
    return reduce(lambda t, p: F.regexp_replace(t, rf"\b{p[0]}\b", p[1]), SPELLINGS, text)


def with_canonical(docs: DataFrame, text_column: str, into: str) -> DataFrame:
    """Adds the canonical form, a line end after each line but the last; null counts as empty."""
    own = docs.withColumn(into, F.coalesce(F.col(text_column), F.lit("")))
    form = F.col(into)
    held = F.regexp_replace(F.regexp_replace(form, NO_HOLDER, "copyright$1$2"), HOLDER, "$1$2copyright 1999 $3")
    own = own.withColumn(into, F.when(F.contains(form, F.lit("Copyright")), held).otherwise(form))
    own = own.withColumn(into, F.translate(form, UPPER, LOWER))
    cut = form
    for _ in range(2):  # "all rights reserved" is often a sentence after it
        cut = F.regexp_replace(cut, COPYRIGHT_SENTENCE, "$1$4")
    cut = F.regexp_replace(cut, COPYRIGHT_LINE, "$1")
    own = own.withColumn(into, F.when(form.rlike(MARKED), cut).otherwise(form))
    own = own.withColumn(into, F.btrim(F.regexp_replace(F.regexp_replace(form, SIGNS, " "), LINE_ENDS, "\n"), F.lit(" \n")))
    return own.withColumn(into, F.when(form.rlike(SPELLED), one_spelling(form)).otherwise(form))


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """digest, license: of the texts of `known` (license, text), by default those of `license_texts`.

    Of two licences with texts of one form the first by name counts; rows without a licence or a word say nothing.
    """
    if known is None:
        known = spark.createDataFrame(KNOWN, "license string, text string")
    texts = with_canonical(known.select("license", "text"), "text", "form").filter("license IS NOT NULL AND form <> ''")
    return texts.groupBy(F.sha2(F.translate("form", "\n", " "), 256).alias("digest")).agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, text_column: str = "text", known: DataFrame | None = None) -> DataFrame:
    """`docs` with `digest`, `license` and `notices`.

    digest: SHA-256 of the whole text's canonical form (null and empty texts: of the empty form); license: the SPDX id
    of the licence that the entire text is, or null; notices: the sorted SPDX ids of the lines that are an entire known
    text, as an array. Rows come out as they went in, repeated ones too; an empty table stays empty.
    `known` (license, text) takes the place of the list of `license_texts`. Up to `LISTED` digests go to every task; a longer
    list is joined, and `docs` is then stored once in the shared folder.
    """
    known = known_digests(docs.sparkSession, known)
    few = known.limit(LISTED + 1).collect()
    if len(few) > LISTED:
        return _joined_scan(docs, text_column, known)
    by_digest = F.create_map(*[F.lit(x) for r in sorted(few) for x in r]).cast("map<string,string>")
    own = with_canonical(docs, text_column, "_form")
    found = F.transform(F.split("_form", "\n"), lambda line: F.element_at(by_digest, F.sha2(line, 256)))
    scanned = own.withColumn("notices", F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull()))))
    scanned = scanned.withColumn("digest", F.sha2(F.translate("_form", "\n", " "), 256)).drop("_form")
    listed = docs.sparkSession.createDataFrame([tuple(r) for r in few], "_known string, license string")
    return scanned.join(F.broadcast(listed), F.col("digest") == F.col("_known"), "left").drop("_known")


def _joined_scan(docs: DataFrame, text_column: str, known: DataFrame) -> DataFrame:
    """The same over a list of any length: digests of texts and of their different lines are joined with it."""
    forms = with_canonical(docs, text_column, "_form")
    lines = F.array_distinct(F.transform(F.split("_form", "\n"), lambda line: F.sha2(line, 256)))
    own = stored(
        forms.withColumns({"digest": F.sha2(F.translate("_form", "\n", " "), 256), "_lines": lines, "_row": F.monotonically_increasing_id()})
        .drop("_form")
    )
    listed = stored(known.select(F.col("digest").alias("_known"), "license"))
    said = own.select(F.col("_row").alias("_of"), F.explode("_lines").alias("_line")).join(listed, F.col("_line") == F.col("_known"))
    notices = said.groupBy("_of").agg(F.array_sort(F.collect_set("license")).alias("_notices"))
    both = own.join(notices, F.col("_row") == F.col("_of"), "left").join(listed, F.col("digest") == F.col("_known"), "left")
    kept = F.coalesce("_notices", F.array().cast("array<string>")).alias("notices")
    return both.select(*(F.col(f"`{c}`") for c in docs.columns), kept, "digest", "license")

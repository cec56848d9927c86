"""The corpus pipeline: documents in, a clean weighted training mix out.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next one's ``docs``. All stages but the last return the columns
of ``documents``.

1. language ID: a document without a recognisable language goes.
2. n-gram Jaccard join: of each group of near copies the one with the smallest id stays.
3. decontamination: a document that holds a window of a benchmark item goes.
4. PII: personal values become pseudonyms of the same format (``n_chars`` follows).
5. mixing: every source gets its target of words; a document stays with its number of
   ``copies`` (documents with none go).

Rows with a null id pass stage 2 as they are; an id that names several texts is several documents there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpwise.llm.common import ship, staged, table
from dumpwise.llm.decontaminate import marked
from dumpwise.llm.language_id import language_of, train
from dumpwise.llm.mixing import mix
from dumpwise.llm.ngram_join import joined_rows
from dumpwise.llm.pii import pseudonymise
from dumpwise.llm.queries import PSEUDONYM_KEY

# Share of a document's n-grams that its best language must hold, once it is long enough to tell; prose has far more.
MIN_LANGUAGE_SHARE = 0.2
TELLING_CHARS = 40
# Times as JSON text with all their digits.
WHOLE_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages the labelled rows teach; rejected: no letters, or too few known n-grams."""
    ship(spark)
    found = language_of(F.col("text"), train(docs), spark)
    known = (found["score"] >= MIN_LANGUAGE_SHARE) | (F.length("text") < TELLING_CHARS)
    return docs.where((found["lang"] != "und") & known)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and of repeated rows one."""
    ship(spark)
    kept = joined_rows(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("kept_id"), "digest").distinct()
    same = (F.col("doc_id") == F.col("kept_id")) & (F.unhex(F.md5(F.coalesce("text", F.lit("")))) == F.col("digest"))
    one = docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return one.unionByName(docs.where("doc_id is null")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    mark = "_" * (1 + max(map(len, docs.columns)))  # a name that no column has
    return marked(docs, table(spark, sf_dir, "benchmark"), name=mark).where(~F.col(mark)["contaminated"]).drop(mark)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced."""
    changed = pseudonymise(docs.select(F.struct("*").alias("row"), "text"), key=PSEUDONYM_KEY, count_col=None)
    n_chars = F.when(F.col("text") == F.col("row.text"), F.col("row.n_chars")).otherwise(F.length("text").cast("long"))
    new = {"text": F.col("text"), "n_chars": n_chars}
    return changed.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their number of copies, for source targets of 1, 2, 3 parts, repeating."""
    rows = docs.drop("size", "target", "copies", "taken")  # extra columns that would clash with the mix
    key = "_" * (1 + max(map(len, rows.columns)))  # a name that no column has
    # The key is the whole row, so only equal rows share one; they are dealt the copies of their key as a group.
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "text"]), WHOLE_TIMES)
    whole = F.concat(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256), F.col("text").isNull().cast("string"), rest)
    keyed = rows.withColumn(key, F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)))
    mixed = ["size", "target", "copies", "taken"]
    rates = mix(keyed, id_col=key).where("copies > 0").groupBy(F.col("doc_id").alias(key), *mixed).agg(F.count(F.lit(1)).alias(f"{key}n"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{key}n")))
    return keyed.dropDuplicates([key]).join(rates, key).withColumn(f"{key}i", again).select(*[F.col(f"`{c}`") for c in rows.columns], *mixed)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", pii),
    ("mixing sources to target weights", mixing),
]

# Signatures, learned filters and iterations are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{k + 1}")
    return docs

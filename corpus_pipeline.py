"""From raw documents to sampled token ids: each stage reads what the one before has kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last keep the columns of
`documents`. Documents without a doc_id, repeated rows, and null or empty texts pass as each stage's
operator defines it; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spelltide.llm import decontam, fm, sampling, secrets
from spelltide.llm.ngram_join import link_documents
from spelltide.llm.queries import QUALITY, held_out, prepared, table
from spelltide.llm.scratch import quoted, stored, unused

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts: score 0.7 or more. It learns from labels that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out(4))
    model = fm.fit(docs, labels, "doc_id", "quality")
    score = unused("_score", docs)
    return fm.score(docs, model, out=score).where(F.col(score) >= QUALITY).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of rows with linked texts: that with the smallest id, rows without an id last.

    Texts alone link rows, so rows that share an id but not their text stay, and copies without an id go.
    Null and wordless texts link with nothing; of rows that agree in id and such a text, one stays. Hashes
    of the text and the other columns settle what is still equal.
    """
    prepared(spark)
    row = unused("_row", docs)
    # Stored, so that a row has the same key whenever it is read again.
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")
    linked = link_documents(rows.select(row, "text"), key=row)
    named = rows.select(row, F.col("doc_id").alias("_id"), F.md5("text").alias("_text"), F.xxhash64(*[F.col(quoted(c)).cast("string") for c in docs.columns]).alias("_rest"))
    alone = F.col("n_shingles") == 0
    group = [F.when(~alone, F.col("component_id")).alias("_a"), F.when(alone, F.col("_id")).alias("_b"), F.when(alone, F.col("_text")).alias("_c")]
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "_text", "_rest", row))[row].alias(row)
    kept = stored(named.join(linked.hint("merge"), row).groupBy(*group).agg(first).select(row), "pipeline-kept")
    return rows.join(kept.hint("merge"), row, "left_semi").select(*map(quoted, docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item's question and answer."""
    leaks = unused("_leaks", docs)
    return decontam.with_leaks(docs, table(spark, sf_dir, "benchmark"), out=leaks).where(F.size(leaks) == 0).drop(leaks)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in place of each secret and n_chars of the new text."""
    prepared(spark)
    prefix = "_" * (1 + max(len(c) for c in docs.columns))
    found = secrets.scan(docs, secrets.fit(docs), prefix=prefix)
    changed, clean = F.col(f"{prefix}spans") != "", F.col(f"{prefix}clean_text")
    length = F.when(changed, F.char_length(clean).cast("long")).otherwise(F.col("n_chars"))
    return found.withColumns({"text": clean, "n_chars": length}).select(*map(quoted, docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Up to two distinct sampled segmentations of each document, as token ids with their scores."""
    prepared(spark)
    return sampling.encode(docs, "doc_id", columns=["doc_id"])


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact", redact),
    ("encode", encode),
]

#: Trained models, near duplicates and sampling can't be put in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

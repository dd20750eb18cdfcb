"""Corpus pipeline: quality, near-duplicates, decontamination, PII, mixing.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet into the
shared folder and reads it again as the next stage's input. All but the last stage return the
columns of ``documents``; the last adds ``copy``, the number of the copy in the mix.

Every stage accepts NULLs in any column, empty texts, repeated rows, empty tables and extra columns;
see the operators for what each of them gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import decontaminate, mixing, near_dedup, pii, quality
from cardlens.llm.common import materialise, table

PII_KEY = "cardlens-demo-key"
#: Documents below this score are rejected.
MIN_QUALITY = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects. Labels of the held-out third are not learnt."""
    model = quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels")))
    return quality.score(_carried(docs), model).where(F.col("_score") >= MIN_QUALITY).select("_row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each near-duplicate component.

    Five-word shingles, similarity of 0.8 or more. Rows that repeat the kept doc_id are one
    document: the row with the smallest text stays. Rows without a doc_id stay unless they belong to
    the component of a document that has one.
    """
    found = near_dedup.near_duplicates(docs, k_words=5, percent=80)
    gone = found.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    names = _names(docs)
    left = docs.join(materialise(gone, "pipeline-copies"), "doc_id", "left_anti").select(*names)
    # whole-row order makes the choice among repeats of an id defined; ids are unique but for those
    again = materialise(left.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("c"))
                        .where("c > 1").select("doc_id"), "pipeline-repeats")
    if again.isEmpty():
        return left
    single = left.join(again, "doc_id", "left_anti").select(*names)
    first = (left.join(again, "doc_id", "left_semi").groupBy("doc_id")
             .agg(F.min(F.struct(F.col("text").alias("_first"), *names)).alias("r")).select("r.*").drop("_first"))
    return single.unionByName(first.select(*names))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold benchmark windows in a twentieth of their words or more."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*_names(docs))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in every text; n_chars follows the new text where there is one."""
    done = pii.pseudonymise(_carried(docs), PII_KEY)
    row = F.col("_row").withField("text", F.col("text").cast(docs.schema["text"].dataType))
    if "n_chars" in docs.columns:
        n = F.length("text").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(F.col("_entities") > 0, n).otherwise(F.col("_row.n_chars")))
    return done.select(row.alias("_row")).select("_row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it has copies, plus ``copy``, counted from 1 (one of that name goes)."""
    return mixing.mixed_rows(docs)


def _carried(docs: DataFrame) -> DataFrame:
    """``text`` and the whole row beside it, so no column of the row can clash with an operator's."""
    return docs.select(F.struct(*_names(docs)).alias("_row"), "text")


def _names(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

#: The classifier, the keyed surrogates and the Newton solution are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

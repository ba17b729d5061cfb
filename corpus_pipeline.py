"""A corpus pipeline: stages over documents, each written as Parquet and reread as the next one's input.

Every stage works on all that the one before it kept, handles nulls, empty tables and repeated rows as its operator does, and returns the columns of
documents; the last one adds copies, the times that the mix takes a document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.llm import decontamination, mixing, ngram_join, pii, quality
from rasterweave.llm.common import saved, table

#: The quality model learns from labels and the mix draws by hash: SQL can't express these stages.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects. The model learns from the labelled ones outside fold 0; no text is shuffled."""
    model = quality.train(saved(quality.featurise(docs), "features"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the least id, of each group that 5-word shingles link at a Jaccard similarity of 0.75 or more."""
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out, and drops the documents that they cover for the most part."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in brackets in place of personal data."""
    return pii.mask(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with copies in place of a column of that name. Rows are numbered in a written table, so each gets its own copies whatever ids are null or shared."""
    rows = saved(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    sized = mixing.sizes(rows.select("doc.doc_id", "doc.source", "doc.text", "row"))
    taken = mixing.mix(sized, row_col="row").where("copies > 0").select("row", "copies")
    # joined alike at every size: a plan that changes with the size of its input can't be projected
    kept = rows.join(taken.hint("merge"), "row")
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns if c != "copies"], "copies")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("mixing sources", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

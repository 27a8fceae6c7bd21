"""Training-text pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

quality rules -> line dedup -> near duplicates -> benchmark decontamination -> packing. All but the last return the
columns of ``documents``. A rejected document goes, kept ones lose the lines over the limit of their host; line dedup shortens
texts and drops what it leaves empty; of each component of near duplicates one document stays, by the smallest doc_id; documents that hold a benchmark item go; the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadwright.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules, tools


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    left = F.struct(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]).alias("doc")
    # Written first: a filter on what is left would move down into the chunking and repeat its array work.
    written = tools.materialise(found.select(left, "n_removed"), "line-dedup")
    return written.filter("n_removed = 0 OR doc.text <> ''").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, tools.documents(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination), ("best-fit packing", pack),
]

#: Packing needs a tokenizer, which SQL does not have; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tools.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = tools.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

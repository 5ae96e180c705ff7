"""The corpus pipeline: quality classifier, line dedup, near-dedup, decontamination, packing.

Each stage is (name, function of spark, docs, sf_dir); its result is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.

No stage is plain SQL (learned vectors, patience diff, sketches, edit distances and token ids), so
there is no ORACLE_SQL. Tests hold near-dedup against a brute-force version, the others on made cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, linealign, neardup, packing, quality
from tidemark.llm.common import small_or_not, table
from tidemark.llm.queries import quality_model, tokenizer_path
from tidemark.session import written

ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more; a text unlike any labelled one has the labels' prior."""
    scored = quality.scored(docs, quality_model(spark, docs, sf_dir), "_quality")
    return scored.where(F.col("_quality") >= 0.5).drop("_quality")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without aligned blocks of earlier documents. One of which nothing is left goes."""
    cut = linealign.without_blocks(docs)
    emptied = (F.col("_removed") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    return cut.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id, once.

    Of rows with equal sets of shingles one stays, also if they share a doc_id or have none. Different
    texts of a kept doc_id stay, and rows without doc_id are compared on equal sets only.
    """
    found = written(neardup.classified(docs).select("doc_id", "n_shingles", "set_key", "kept"))
    dropped = found.where("not kept").select("doc_id").distinct()
    rows = docs.join(small_or_not(written(dropped)), "doc_id", "left_anti").select(*docs.columns)
    # Sets of several rows that stay so far, or of a row without doc_id beside others.
    repeated = (
        found.where("n_shingles > 0")
        .groupBy(F.col("set_key").alias("_set_key"))
        .agg(F.count_if("kept").alias("_stay"), F.count("*").alias("_rows"), F.count("doc_id").alias("_ids"))
        .where("_stay > 1 or _rows > _ids and _ids > 0")
    )
    repeated = small_or_not(written(repeated.select("_set_key", "_ids")))
    ids = found.where("kept and doc_id is not null").join(repeated, F.col("set_key") == F.col("_set_key"), "left_semi")
    ids = small_or_not(written(ids.select("doc_id").distinct()))
    apart = rows.where("doc_id is not null").join(ids, "doc_id", "left_anti").select(*docs.columns)
    looked_at = rows.join(ids, "doc_id", "left_semi").select(*docs.columns).unionByName(rows.where("doc_id is null"))
    looked_at = neardup.with_set_keys(looked_at)
    single = looked_at.join(repeated, "_set_key", "left_anti")
    # A row without doc_id goes if any with one has its set.
    groups = looked_at.join(repeated, "_set_key").where("doc_id is not null or _ids = 0")
    order = Window.partitionBy("_set_key").orderBy(F.xxhash64(*docs.columns))
    first = groups.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return apart.unionByName(single.select(*docs.columns)).unionByName(first.select(*docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its error budget."""
    hits = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    rows = docs.join(small_or_not(written(hits)), "doc_id", "left_anti")
    return rows.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 1,024-token sequences with their token ids, mixed by source."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("decontaminate", without_benchmark),
    ("pack", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

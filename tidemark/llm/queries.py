"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import base64

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    hardnegatives,
    html,
    linealign,
    neardup,
    packing,
    quality,
    sequencefiles,
    sharding,
    suffixdedup,
    tokencounts,
    vafile,
    whitening,
)
from tidemark.llm.common import table
from tidemark.session import scratch_dir

SHARDS = 40


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pigeonhole_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"
    )


def held_out(doc_id) -> Column:
    """Documents whose labels a quality model never sees."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return quality.fit(docs, labels)


def op3_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = quality.scored(docs.select("doc_id", "text"), quality_model(spark, docs, sf_dir))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op5_longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as lines:
        vocabulary = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    return tokencounts.token_counts(table(spark, sf_dir, "documents"), vocabulary)


def op6_grouped_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixdedup.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "spans")


def op7_vector_approximation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vafile.whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return vafile.top_k(rows, F.col("id") % 100 == 0, k=10)


def op8_patience_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linealign.without_blocks(docs)
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"), "text")


def op9_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    sizes = {
        "size": sharding.text_bytes(F.col("text")) + 16,
        "text_crc32": F.crc32(F.encode(text, "UTF-8")),
    }
    out = sharding.hilbert_shards(docs, "doc_id", ["source", "lang", "n_chars"], sizes, SHARDS, law="rows")
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op11_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op12_shared_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hardnegatives.labelled_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label)
    return hardnegatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op13_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scratch_dir(spark, "sequences")
    files = sequencefiles.write_sequences(docs, tokenizer_path("word_bpe_49k.json"), out)
    return sequencefiles.read_documents(files, docs.schema["doc_id"].dataType.simpleString())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_pigeonhole_edits": op1_pigeonhole_edits,
    "op2_mixture_packing": op2_mixture_packing,
    "op3_neighbour_quality": op3_neighbour_quality,
    "op4_site_templates": op4_site_templates,
    "op5_longest_match_counts": op5_longest_match_counts,
    "op6_grouped_suffixes": op6_grouped_suffixes,
    "op7_vector_approximation": op7_vector_approximation,
    "op8_patience_alignment": op8_patience_alignment,
    "op9_odd_sketches": op9_odd_sketches,
    "op10_hilbert_shards": op10_hilbert_shards,
    "op11_block_whitening": op11_block_whitening,
    "op12_shared_lists": op12_shared_lists,
    "op13_arrow_sequences": op13_arrow_sequences,
    "pipeline": pipeline,
}

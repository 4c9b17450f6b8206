"""The corpus pipeline: toxicity, near duplicates, repeated bytes, benchmark passages, then the mix of sources.

Every stage works on all rows that the one before kept and is written as Parquet
in the shared folder and read again. All but the last return the columns of
documents, extra ones included, whatever their names. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thermaquilt.llm.common import release, stage_table
from thermaquilt.llm.decontaminate import drop_contamination
from thermaquilt.llm.mixing import draw_mix
from thermaquilt.llm.near_dup import near_duplicate_classes
from thermaquilt.llm.suffix_dedup import remove_repeated_bytes
from thermaquilt.llm.toxicity import judge_toxicity

#: No SQL twin: the stages train a model, sketch, sort suffixes and draw at random. Their tests hold them against brute force.
ORACLE_SQL = None
#: Bytes of a repeated string that the third stage cuts out: 51 of the shortest words. (400 bytes belong to op10's contract alone.)
REPEATED_BYTES = 150
#: Columns that the mix adds; a document's own column of such a name gives way.
MIX_COLUMNS = ("size", "source_size", "target", "epoch", "shard", "place")


def _packed(docs: DataFrame, *names: str) -> DataFrame:
    """All columns as one, so that none can clash with an operator's own, and those that the operator reads."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("packed_row"), *names)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go. Null and empty texts have no words; rows with one id are judged by their own texts."""
    judged = judge_toxicity(_packed(docs, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=("packed_row",))
    return judged.where(~F.col("is_toxic")).select("packed_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of equal or similar documents the one with the least id stays.

    Null and empty texts are equal. Documents without an id stay. Rows with one
    id are in one class; of those that also have one text a single one stays.
    """
    classes = near_duplicate_classes(docs.select("doc_id", "text"))
    gone = stage_table(classes.where("doc_id <> class_id").select(F.col("doc_id").alias("gone_id")).distinct(), "near-duplicates")
    kept = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    again = stage_table(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("again_id")), "repeated-ids")
    if not again.head(1):
        return kept
    once = kept.join(again, kept["doc_id"] == again["again_id"], "left_anti")
    several = _packed(kept.join(again, kept["doc_id"] == again["again_id"], "left_semi"), "doc_id", "text")
    numbered = several.withColumn("same_row", F.row_number().over(Window.partitionBy("doc_id", F.coalesce("text", F.lit(""))).orderBy(F.xxhash64("packed_row"))))
    return once.unionByName(numbered.where("same_row = 1").select("packed_row.*"))


def cut_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of REPEATED_BYTES bytes or more that occur twice or more are cut out of the texts, all occurrences; every document stays.

    n_chars follows a text that was cut; a text without repeats, null included,
    is left as it is. Equal texts that long are cut to nothing.
    """
    cut = remove_repeated_bytes(docs, length=REPEATED_BYTES, keep=tuple(docs.columns))
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("rest.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("rest.n_chars"))
    return cut.select(*[new.get(c, F.col("rest")[c]).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that tile half of a benchmark item or more go, each row by its own text, whatever its id. Null texts stay."""
    return drop_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time the mix takes a document: its columns and MIX_COLUMNS. Null sources are a source; empty texts have size 0 and go with their block."""
    mixed = draw_mix(_packed(docs, "doc_id", "source", "text"))
    own = [c for c in docs.columns if c.lower() not in MIX_COLUMNS]
    rows = mixed.select("packed_row", "mix_size", "mix_source_size", "mix_target", F.explode("mix_draws").alias("mix_draw"))
    return rows.select(
        *[F.col("packed_row")[c].alias(c) for c in own], F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        F.col("mix_draw.epoch").alias("epoch"), F.col("mix_draw.shard").alias("shard"), F.col("mix_draw.place").alias("place"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_arrays", cut_repeated_bytes),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)

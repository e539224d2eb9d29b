"""A corpus pipeline: each stage applies one operator to what the stage before has kept.

Each row is judged on its own, also where rows share an id, NULL being one; only rows alike in id and text are dropped together.
The stages hand on the columns of ``documents`` (the last one gives the mix); further
columns stay with their rows. An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.decontaminate import contaminated, contaminated_words
from ledgerloom.llm.lines import without_repeated_lines
from ledgerloom.llm.mixing import mixed
from ledgerloom.llm.near import near_duplicates
from ledgerloom.llm.quality import quality_scores
from ledgerloom.llm.tables import row_key, saved


def _with_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows whose ``row_key`` of id and text is (``left_semi``) or isn't (``left_anti``) among ``keys``."""
    k1, k2 = row_key("doc_id", "text")
    # Shuffled whatever its size, so a small corpus shows what a large one costs.
    keys = keys.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct().hint("shuffle_merge")
    return docs.withColumns({"__k1": k1, "__k2": k2}).join(keys, ["__k1", "__k2"], how).select(docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects; it learns from the labelled ones among ``docs``.

    NULL texts are scored as empty ones.
    """
    scores = quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keys=True)
    return _with_keys(docs, scores.where("predicted = 0"), "left_anti")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated runs of lines from the texts. All rows stay, emptied ones too."""
    found = without_repeated_lines(docs)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near or exact copies: the one with the smallest id.

    Empty texts are copies of each other; NULL texts are not. Of rows alike in id and text one stays.
    """
    members, _ = near_duplicates(docs, keys=True)
    return _with_keys(docs, members.where("kept"), "left_semi").dropDuplicates(["doc_id", "text"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of which a twentieth of the words or more stands in benchmark windows."""
    key = F.concat_ws(" ", *row_key("doc_id", "text"))
    found = contaminated_words(docs.withColumn("__key", key), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc="__key")
    one, two = (F.split("__key", " ")[i].cast("bigint") for i in (0, 1))
    return _with_keys(docs, found.where(contaminated()).select(one.alias("k1"), two.alias("k2")), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document: ``(doc_id, source, size, source_size, target, copies, taken)``."""
    return mixed(docs)


STAGES = [
    ("quality classifier", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("near-duplicate documents", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix_sources),
]
#: The classifier and the draws of the mix are beyond SQL; tests compare the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

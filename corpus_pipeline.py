"""A corpus pipeline of the operators in `shopgrain.llm`, stage by stage.

Every stage takes the documents its predecessor kept. Rows with null or repeated ids are documents
of their own; null texts count as empty; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm import mixing, pieces, recurrent, simhash, substrings
from shopgrain.llm.catalogue import piece_model
from shopgrain.llm.common import staged, unique_ids

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window is not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = recurrent.trained(docs, labels)
    scored = recurrent.score(docs.select(*COLUMNS), model, keep=COLUMNS)
    return scored.where(F.col("score") < TOXIC).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each SimHash group."""
    numbered, _ = unique_ids(docs.select(*COLUMNS), "doc_id", "text")
    groups = simhash.near_duplicates(numbered, "uid", shingle=3, distance=2)
    first = groups.where("uid = component_id").select("uid")
    return numbered.join(first, "uid", "left_semi").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the characters that strings of 100 bytes repeated from before cover."""
    found = substrings.without_repeats(
        docs, width=100, keep=("lang", "source"), whole_characters=True
    )
    text = F.col("kept").cast("string")
    return found.select(
        "doc_id", text.alias("text"), "lang", "source",
        F.length(text).cast("long").alias("n_chars"),
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    numbered, _ = unique_ids(docs.select(*COLUMNS), "doc_id", "text")
    taken, _ = mixing.mix(numbered, id_col="uid", cycle=(1, 2, 3), epochs=3)
    copies = taken.where("copies > 0").select("uid", "copies")
    return numbered.join(copies, "uid").select(
        *COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    ).drop("_copy")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the text they decode to."""
    return pieces.encode(docs, piece_model(), keep=("doc_id", "source"), digests=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("simhash", near_duplicates),
    ("substrings", substring_dedup),
    ("mixing", mixture),
    ("pieces", encoding),
]
# The stages train a network and hash by XXH64, which SQL does not express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs

"""A training corpus from raw documents: the stages of a pipeline over table documents, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import mixing, near_dedup, sentencepiece_scan, suffix_dedup, toxicity
from framelake.llm.common import checkpointed, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Bytes of a passage that counts as repeated: 51 words and the spaces between them take as many in 99 of 100 places of the test tables.
PASSAGE = 240


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score comes to the threshold go; the model learns from the labelled rows outside the held-out quarter."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, into="q_score").where(F.col("q_score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least key of each class stays."""
    return near_dedup.deduplicate(docs).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that repeated strings of PASSAGE bytes cover are cut out of the texts; what a cut leaves of a character goes too. Every document stays."""
    kept = suffix_dedup.cleaned(docs, keep=("lang", "source"), length=PASSAGE)
    text = F.try_validate_utf8(F.col("q_kept").cast("string"))
    # an invalid text is one that was cut inside a character
    clean = F.coalesce(text, F.replace(F.make_valid_utf8(F.col("q_kept").cast("string")), F.lit("�"), F.lit("")))
    return kept.select(F.col("q_key").alias("doc_id"), clean.alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, shuffled."""
    return mixing.mix(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's rows as token ids."""
    return sentencepiece_scan.encode(docs.select("doc_id", "source", "text")).select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL has no trained lexicons, sketches or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

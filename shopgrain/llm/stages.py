"""The stages of the corpus pipeline; each calls one operator on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.plans.saving import saved

from . import bpe, mixing, pii, resampling, simhash
from .queries import VOCABULARY, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def select(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose importance weights put them among the target's share."""
    labels = table(spark, sf_dir, "labels")
    return resampling.resample(docs, labels, keep=COLUMNS).select(COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Ids only choose within a group: documents of different groups that share an id all
    stay, and so does one of a group without ids. Of rows that share the id chosen, the
    one with the smallest digest of its text stays, once.
    """
    mark = F.coalesce(F.sha2("text", 256), F.lit(""))
    marked = docs.withColumn("mark", mark)
    found = simhash.near_duplicates(marked, "doc_id", "text", 4, 4, ("mark",), "group")
    unnamed = F.col("doc_id").isNull()
    first = found.groupBy("group").agg(F.min(F.struct(unnamed, "doc_id", "mark")).alias("s"))
    first = saved(first.select("s.doc_id", "s.mark").toDF("id", "of"), "survivors")
    own = marked.doc_id.eqNullSafe(first.id) & (marked.mark == first.of)
    stay = marked.join(first, own, "left_semi")
    repeats = Window.partitionBy("doc_id", "mark").orderBy("lang", "source", "n_chars")
    once = stay.withColumn("nth", F.row_number().over(repeats)).where("nth = 1")
    return once.select(COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to marks; every document stays."""
    rest = [c for c in COLUMNS if c != "text"]
    found = pii.redact(docs, "text", rest).withColumnRenamed("redacted", "text")
    return found.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row per document and pass over its source."""
    mixed = mixing.mix_sources(docs, "doc_id", "text", "source")
    taken = mixing.taken_texts(mixed, docs, "doc_id", "text", ["doc_id", "lang", "source"])
    return taken.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text."""
    ids = bpe.encode_column(docs, "text", VOCABULARY, ["doc_id", "lang", "source"])
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", select),
    ("simhash", deduplicate),
    ("pii", redact),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through all stages; each writes Parquet that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs

"""A training corpus from raw documents, in stages.

Each stage is ``(name, function)``; ``function(spark, docs, sf_dir)`` works on all
rows its predecessor kept and returns the columns of ``documents`` (the last one: the
packed pieces). ``run`` writes each stage's rows as Parquet into the shared folder
and reads them again for the next, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import mixing, packing, suffix_dedup, toxic_spans, weighted_minhash
from eventide.llm.common import table
from eventide.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the span tagger scores below one half. It learns from ``labels``
    outside the held-out fold."""
    return toxic_spans.clean(docs, toxic_spans.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near-duplicates the document of smallest id."""
    gone = weighted_minhash.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the bytes of passages of 100 bytes or more that start
    earlier in the corpus; ``n_chars`` is counted anew."""
    cut = suffix_dedup.without_repeats(docs, with_text=True, carry=["doc_id", "lang", "source"])
    return cut.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("kept").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: whole copies and chosen blocks of documents;
    ``n_chars`` is counted anew."""
    return mixing.mixed(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of balanced cost, one row per piece."""
    return packing.pack(docs, added=packing.added_tokens())


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mix", mix),
    ("pack", pack),
]

#: The trained tagger and the seeded draws have no SQL form; tests hold each stage
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        place = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return STAGES[-1][1](spark, docs, sf_dir)

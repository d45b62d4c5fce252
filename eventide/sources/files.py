"""File sources and sinks: headerless CSV with a declared schema (SRC-4),
CSV with a header renamed by position (SRC-5), a JSON document of weighted
categories (SRC-6) and a time-sorted headerless CSV (SNK-2, R-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.quality import require
from eventide.operators.scan import prefix_sums

# --- fixed values: comment CSV layout (column order of the input file) ------
COMMENT_SCHEMA = "commentId STRING, time BIGINT, user STRING, topic STRING, acronim STRING"
COMMENT_COLUMNS = ("commentId", "time", "user", "topic", "acronym")

WEIGHTS_SCHEMA = ("stores ARRAY<STRUCT<name: STRING, probability: DOUBLE>>, "
                  "appIds ARRAY<STRUCT<name: STRING, probability: DOUBLE>>, "
                  "eventTypes ARRAY<STRUCT<name: STRING, probability: DOUBLE>>, "
                  "eventTimeFreqMillis BIGINT")
WEIGHT_DIMENSIONS = ("stores", "appIds", "eventTypes")


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = False,
             streaming: bool = False) -> DataFrame:
    """SRC-4: CSV with a declared schema; a malformed line fails the read."""
    reader = spark.readStream if streaming else spark.read
    return (reader.schema(schema).option("header", header).option("mode", "FAILFAST")
            .csv(path))


def read_comments(spark: SparkSession, path: str, header: bool = False,
                  streaming: bool = False) -> DataFrame:
    """The comment file (commentId, time ms, user, topic, acronim)."""
    return read_csv(spark, path, COMMENT_SCHEMA, header=header, streaming=streaming)


def read_csv_renamed(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """SRC-5: CSV whose first line is a header; columns renamed by position.
    Values stay strings (no schema inference pass over the data)."""
    df = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}")
    return df.toDF(*names)


def write_sorted_csv(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """SNK-2 (after K-3): global sort, headerless CSV. The sort is a range
    partitioning, so part files are in order and each is sorted."""
    df.orderBy(*by).write.mode("errorifexists").option("header", False).csv(path)


def read_places(spark: SparkSession, path: str, schema: str, name: str = "place") -> DataFrame:
    """The lines of a headerless CSV folder with their place in it (from 1): part files by number, lines in
    the order of their file. For K-3: after ``write_sorted_csv`` the places are the global order. The files are read once;
    lines are counted per range of them, not in one task."""
    rows = (spark.read.schema(schema).option("mode", "FAILFAST").csv(path)
            .withColumn("_part", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long"))
            .withColumn("_block", F.col("_metadata.file_block_start"))
            .withColumn("_line", F.monotonically_increasing_id()))
    return prefix_sums(rows, [], ["_part", "_block", "_line"], {name: F.lit(1).cast("long")}).drop("_part", "_block", "_line")


def sort_comments_file(spark: SparkSession, src: str, dst: str) -> None:
    """R-2: headered comment CSV -> rename by position -> sort by time
    (ties by id) -> headerless CSV."""
    raw = read_csv_renamed(spark, src, COMMENT_COLUMNS)
    typed = raw.withColumn("time", F.col("time").cast("long"))
    write_sorted_csv(typed, dst, ["time", "commentId"])


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: the weight document flattened to (dimension, pos, name,
    probability). A malformed document, a missing section or a missing
    name or probability fails the load."""
    doc = (spark.read.schema(WEIGHTS_SCHEMA).option("multiLine", True)
           .option("mode", "FAILFAST").json(path))
    for dim in WEIGHT_DIMENSIONS:
        doc = require(doc, F.col(dim).isNotNull(), F.lit(f"the weight document has no section {dim}"))
    sections = F.array(*[F.struct(F.lit(dim).alias("dimension"), F.col(dim).alias("items"))
                         for dim in WEIGHT_DIMENSIONS])
    flat = (doc.select(F.explode(sections).alias("s"))
            .select("s.dimension", F.posexplode("s.items").alias("pos", "item")))
    flat = flat.select("dimension", "pos", F.col("item.name").alias("name"),
                       F.col("item.probability").alias("probability"))
    return require(flat, F.col("name").isNotNull() & F.col("probability").isNotNull(),
                   F.concat(F.lit("invalid weight entry in "), F.col("dimension")))


def write_weights(spark: SparkSession, path: str, sections, time_freq_ms: int) -> None:
    """The weight document as one JSON file: ``sections`` gives (name, probability) pairs per
    dimension. A configuration, so one row."""
    def items(pairs):
        return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("probability")) for n, p in pairs])

    doc = spark.range(1).select(*[items(sections[dim]).alias(dim) for dim in WEIGHT_DIMENSIONS],
                                F.lit(time_freq_ms).cast("long").alias("eventTimeFreqMillis"))
    doc.coalesce(1).write.json(path)

"""Readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Columns and defaults of the training file.
TRAINING_SCHEMA = "label double, user_features string, user_weights string, ads_features string, ads_weights string"
TRAINING_DEFAULTS = {"label": 0.0, "user_features": "0", "user_weights": "0.0", "ads_features": "0", "ads_weights": "0.0"}

def training_rows(raw: DataFrame) -> DataFrame:
    """Raw training columns to label, string lists and float lists; works on a stream as well."""
    full = raw.select(*[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in TRAINING_DEFAULTS.items()])
    return full.select(
        F.col("label").cast("int").alias("label"),
        *[F.split(c, ";").alias(c) for c in ("user_features", "ads_features")],
        *[F.split(c, ";").cast("array<float>").alias(c) for c in ("user_weights", "ads_weights")],
    )


def training_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return training_rows(spark.read.schema(TRAINING_SCHEMA).csv(paths))


def training_csv_stream(spark: SparkSession, path: str) -> DataFrame:
    return training_rows(spark.readStream.schema(TRAINING_SCHEMA).csv(path))


def delimited(spark: SparkSession, path: str | list[str], schema: str | T.StructType, sep: str = "\t") -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).csv(path)


def word_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``doc \\t w1 \\t w2 ...`` as doc and words."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(parts[0].alias("doc"), F.slice(parts, 2, F.size(parts)).alias("words"))


def topic_vectors(spark: SparkSession, path: str, topics: int = 50) -> DataFrame:
    """Comma lines of package, name, id, topic weights and their sum; lines of another length are skipped."""
    parts = F.split(F.trim("value"), ",")
    rows = spark.read.text(path).select(parts.alias("p")).filter(F.size("p") == topics + 4)
    return rows.select(
        F.col("p")[0].alias("package"),
        F.col("p")[1].alias("name"),
        F.col("p")[2].try_cast("bigint").alias("id"),
        F.slice("p", 4, topics).cast("array<double>").alias("topics"),
        F.col("p")[topics + 3].try_cast("double").alias("sum"),
    )


def jdbc(
    spark: SparkSession, url: str, query: str, properties: dict[str, str], column: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 16,
) -> DataFrame:
    """A query run by the database; with a number column and its bounds, read in parallel ranges."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", **properties)
    if column and bounds:
        reader = reader.options(
            partitionColumn=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def joined_jdbc(
    spark: SparkSession, url: str, properties: dict[str, str], tables: tuple[str, str], on: tuple[str, str],
    columns: dict[str, str], **more,
) -> DataFrame:
    """Two tables (``l`` and ``r``) joined in the database; ``columns`` gives the expression behind each output name."""
    chosen = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    query = f"SELECT {chosen} FROM {tables[0]} l INNER JOIN {tables[1]} r ON l.{on[0]} = r.{on[1]}"
    return jdbc(spark, url, query, properties, **more)


def kafka(spark: SparkSession, servers: str, topic: str, schema: str, start: str = "latest") -> DataFrame:
    """A topic of JSON records as a stream; needs Spark's Kafka package on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def not_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.length(column) > 0))

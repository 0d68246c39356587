"""Plain tables on any Hadoop file system: parquet, CSV, JSON lines, and file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; quoted fields may span lines, as page text does."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def list_objects(
    spark: SparkSession, root: str, date: str | None = None, glob: str = "*"
) -> DataFrame:
    """``name`` (below ``root``), path, time and length of the files; contents stay unread.

    With ``date`` only names whose first path segment equals it.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "modificationTime", "length")
    )
    base = root.rstrip("/").split("://")[-1].removeprefix("file:")
    name = F.substring_index(F.col("path"), base + "/", -1)
    named = files.withColumn("name", name)
    return named.filter(F.split_part("name", F.lit("/"), F.lit(1)) == date) if date else named


def write_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace the partitions ``df`` holds rows for; the others stay as they are."""
    (
        df.write.partitionBy(*columns)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested columns are written as JSON text."""
    flat = [
        F.to_json(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    writer = df.select(*flat).write.option("header", True).option("escape", '"')
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.mode("overwrite").csv(path)


def write_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").option("compression", compression).json(path)

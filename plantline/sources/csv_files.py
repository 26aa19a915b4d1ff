"""Entity CSV files with a header, read with declared types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantline import schema

OPTIONS = {"header": True, "mode": "FAILFAST", "dateFormat": "yyyy-MM-dd", "enforceSchema": False}


def read_entity(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One entity file; columns and types are declared, nothing is inferred."""
    return spark.read.schema(schema.entity(name)).options(**OPTIONS).csv(path)


def read_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All entity files of a folder as a star schema."""
    return {
        table: read_entity(spark, f"{folder}/{name}.csv", name) for name, table in schema.STAR_TABLE.items()
    }


def read_text_batch(spark: SparkSession, path: str, seq: str) -> DataFrame | None:
    """An unvalidated file: every column as text, plus the position in the file. None when the file is absent.

    The line order decides which duplicate wins. Splits are packed into tasks by size, so the position is
    (file, offset of the split, row within the task), which sorts in line order.
    """
    try:
        lines = spark.read.options(header=True).csv(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if seq in lines.columns:
        return lines.withColumn(seq, F.col(seq).cast("bigint"))
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return lines.withColumn(seq, place)


def write_csv(tables: Mapping[str, DataFrame], folder: str, compression: str | None = None) -> None:
    """One folder of CSV parts per table; ``compression`` is a codec that Spark's readers know by the name of the file."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite").option("header", True)
        if compression:
            writer = writer.options(**{"compression": compression, "zlib.compress.level": "BEST_SPEED"})
        writer.csv(f"{folder}/{name}.csv")


def roundtrip(tables: Mapping[str, DataFrame], spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Write tables as CSV and read them back with their own types. The files are only read here, so they are packed."""
    write_csv(tables, folder, compression="gzip")
    return {
        name: spark.read.schema(_nullable(df.schema)).options(**OPTIONS).csv(f"{folder}/{name}.csv")
        for name, df in tables.items()
    }


def _nullable(struct: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in struct.fields])



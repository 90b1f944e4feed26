"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing value for floating-point columns: NaN becomes null."""
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table; NaN comes as null, the only missing value."""
    reader = spark.read.schema(schema) if schema else spark.read
    return nan_to_null(reader.parquet(path))


def read_csv(
    spark: SparkSession, path: str, schema: StructType, header: bool = True, multi_line: bool = False
) -> DataFrame:
    """CSV with a declared schema; types are never guessed. Empty text reads back as null.

    `multi_line` allows line breaks within values, at the price of unsplit files.
    """
    return spark.read.schema(schema).csv(path, header=header, escape='"', multiLine=multi_line)


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).csv(path, header=True, escape='"')


def write_auto(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV if the path ends in `.csv`, else Parquet."""
    (write_csv if path.endswith(".csv") else write_table)(df, path, mode)


def read_auto(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    if path.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV source needs a schema")
        return read_csv(spark, path, schema)
    return read_table(spark, path, schema)


def export_bundle(tables: dict[str, DataFrame], directory: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Several named tables, one folder each."""
    suffix = ".csv" if fmt == "csv" else ""
    for name, df in tables.items():
        write_auto(df, f"{directory.rstrip('/')}/{name}{suffix}", mode)


# How the data dictionary names the types.
TYPE_LABELS = {
    "byte": "Integer", "short": "Integer", "integer": "Integer", "long": "Integer",
    "float": "Decimal", "double": "Decimal", "decimal": "Decimal",
    "string": "Text", "boolean": "Boolean",
    "date": "DateTime", "timestamp": "DateTime", "timestamp_ntz": "DateTime",
}


def data_dictionary(df: DataFrame, descriptions: dict[str, str] | None = None, distinct: bool = False) -> DataFrame:
    """Column, type, description and nulls; with `distinct` also an estimate of distinct values."""
    fields = df.schema.fields
    aggs = [F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(fields)]
    if distinct:
        aggs += [F.approx_count_distinct(f.name).alias(f"d{i}") for i, f in enumerate(fields)]
    cells = []
    for i, f in enumerate(fields):
        cell = [
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(TYPE_LABELS.get(f.dataType.typeName(), f.dataType.simpleString())).alias("type"),
            F.lit((descriptions or {}).get(f.name, "")).alias("description"),
            F.col(f"n{i}").alias("nulls"),
        ]
        cells.append(F.struct(*cell, *([F.col(f"d{i}").alias("distinct")] if distinct else [])))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def folder_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Names and paths of the Parquet tables in a folder of any file system that Spark reads."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    names = sorted(f.getPath().getName() for f in found)
    return {n.removesuffix(".parquet"): f"{folder.rstrip('/')}/{n}" for n in names if n.endswith(".parquet")}


def list_path_tables(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Name, rows and columns of the Parquet tables at the given paths; rows come from the file footers."""
    out = None
    for name, path in tables.items():
        df = spark.read.parquet(path)
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        out = row if out is None else out.unionByName(row)
    return out

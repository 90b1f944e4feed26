"""Database source. Reads in parallel when a partition column with bounds is given."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Partition:
    """Column and bounds that split a table scan into `count` queries of its own."""

    column: str
    lower: int
    upper: int
    count: int


# Where each database lists its base tables, by the scheme of its address.
CATALOG_QUERIES = {
    "derby": "SELECT TABLENAME AS table_name FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'",
    "oracle": "SELECT TABLE_NAME AS table_name FROM USER_TABLES",
    "default": "SELECT TABLE_NAME AS table_name FROM INFORMATION_SCHEMA.TABLES WHERE TABLE_TYPE = 'BASE TABLE'",
}


def jdbc_options(
    url: str, table: str | None = None, query: str | None = None, partition: Partition | None = None,
    properties: dict[str, str] | None = None, fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options |= {"dbtable": table} if table else {"query": query}
    if partition:
        if query:
            raise ValueError("only a whole table can be split")
        options |= {
            "partitionColumn": partition.column,
            "lowerBound": str(partition.lower),
            "upperBound": str(partition.upper),
            "numPartitions": str(partition.count),
        }
    return options


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition: Partition | None = None, limit: int | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A whole table, or `limit` of its rows; the limit is applied in Spark."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, None, partition, properties)).load()
    return df if limit is None else df.limit(limit)


def list_tables(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> DataFrame:
    scheme = url.split(":")[1] if url.startswith("jdbc:") else ""
    query = CATALOG_QUERIES.get(scheme, CATALOG_QUERIES["default"])
    return spark.read.format("jdbc").options(**jdbc_options(url, query=query, properties=properties)).load()

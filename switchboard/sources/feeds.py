"""Readers for the landed feeds, each with the table's declared schema.

* pipe-delimited change feeds (the ``_delta`` tables) -> ``read_pipe_delta``
* CSV file feeds -> ``read_csv_feed`` (PERMISSIVE: malformed fields -> NULL)
* JSON file feeds with nested arrays -> ``read_json_feed``
* regex-parsed log lines -> ``read_log_lines`` + ``operators.transforms.regex_log_parse``
* RDBMS mirrors -> ``read_jdbc_mirror`` (partitioned JDBC read)

Schemas are never inferred. The partition column of a landed folder
(``extract_ts`` / ``feed_date``) comes from the ``col=value`` folder names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import schemas


def read_pipe_delta(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A ``|``-separated change feed (no header) with the declared schema."""
    return (spark.read.schema(schemas.schema(table)).option("sep", "|").option("header", "false")
            .option("mode", "PERMISSIVE").option("nullValue", "").csv(path))


def read_csv_feed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A CSV feed with a header row; malformed fields become NULL."""
    return (spark.read.schema(schemas.schema(table)).option("header", "true").option("mode", "PERMISSIVE")
            .option("multiLine", "true").option("escape", '"').csv(path))


def read_json_feed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A JSON-lines feed with nested columns."""
    return spark.read.schema(schemas.schema(table)).option("mode", "PERMISSIVE").json(path)


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw log lines (one ``value`` column), parsed later by regex."""
    return spark.read.text(path)


def read_jdbc_mirror(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
                     num_partitions: int, properties: dict | None = None) -> DataFrame:
    """An RDBMS source table read in ``num_partitions`` parallel range slices
    of ``partition_column`` (needs the vendor's JDBC driver on the classpath)."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties or {})

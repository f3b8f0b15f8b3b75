"""Zone maps: smallest and largest value of the cluster columns by file, to leave files out before a scan.

Parquet keeps such figures inside each file, where a reader meets them only
after it has opened the file. ``write_zones`` gathers them once into a small
table beside the data (one row a file, in a folder that Spark's readers pass
over); ``read_zoned`` opens only the files whose zones meet all conditions. A
table whose rows are dealt to its files at random has zones that all overlap, so
what a layout is worth can be read off ``Zoned.kept`` / ``Zoned.total``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import write_clustered

ZONES = "_zones"


class Zoned(NamedTuple):
    """The rows that meet the conditions, the files opened for them and the files there are."""
    rows: DataFrame
    kept: int
    total: int


def write_zones(spark: SparkSession, path: str, cols: list[str]) -> None:
    """(Re)write the zone map of the table at ``path``: one partial aggregate by file."""
    rows = spark.read.parquet(path)
    each = [a for c in cols for a in (F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi"), F.count(c).alias(f"{c}__some"))]
    zones = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *each)
    zones.write.mode("overwrite").parquet(f"{path}/{ZONES}")


def write_zoned(df: DataFrame, path: str, cluster_cols: list[str], partition_col: str | None = None, num_partitions: int | None = None) -> None:
    """Write ``df`` clustered by up to three columns (L3), with its zone map."""
    if len(cluster_cols) > 3:
        raise ValueError("three cluster columns at most")
    write_clustered(df, path, cluster_cols, partition_col, num_partitions=num_partitions)
    write_zones(df.sparkSession, path, [*([partition_col] if partition_col else []), *cluster_cols])


def read_zoned(spark: SparkSession, path: str, conditions: dict[str, tuple]) -> Zoned:
    """Rows with lo <= column <= hi for each of ``conditions`` (column -> (lo, hi); NULL meets none).

    Conditions on columns without a zone only filter rows. The file names come to the driver, as they do for any scan.
    """
    zones = spark.read.parquet(f"{path}/{ZONES}")
    meet = F.lit(True)
    for c, (lo, hi) in conditions.items():
        if f"{c}__lo" in zones.columns:
            meet = meet & F.coalesce((F.col(f"{c}__some") > 0) & (F.col(f"{c}__hi") >= F.lit(lo)) & (F.col(f"{c}__lo") <= F.lit(hi)), F.lit(False))
    files = zones.select("file", meet.alias("meet")).collect()
    kept = [r["file"] for r in files if r["meet"]]
    rows = spark.read.option("basePath", path).parquet(*kept) if kept else spark.read.parquet(path).where(F.lit(False))
    for c, (lo, hi) in conditions.items():
        rows = rows.where(F.col(c).between(F.lit(lo), F.lit(hi)))
    return Zoned(rows, len(kept), len(files))

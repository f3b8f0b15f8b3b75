"""Materialized sums kept by signed deltas (L5): a refresh reads what changed, not the base.

A view that groups rows and sums columns is stored with the number of rows of
each group and of non-NULL values of each sum. Inserted base rows count +1,
deleted ones -1 (an update is both); their partial aggregates are added to the
stored groups. Only the folders that the delta falls into are read, by a filter
on the partition column, and written again; a group without rows is gone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .tables import BUCKET_SUFFIX, DATE_KEY_RANGE, range_bucket, write_date_partitioned

ROWS = "__rows"


def _count(c: str) -> str:
    return f"__n_{c}"


def signed(inserted: DataFrame | None, deleted: DataFrame | None, keys: list[str], sums: list[str]) -> DataFrame:
    """The delta's groups: keys, signed sums, signed counts."""
    def one(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, *[(F.col(c) * sign).alias(c) for c in sums], *[F.when(F.col(c).isNotNull(), sign).otherwise(0).alias(_count(c)) for c in sums],
                         F.lit(sign).alias(ROWS))
    rows = reduce(DataFrame.unionByName, [one(df, s) for df, s in ((inserted, 1), (deleted, -1)) if df is not None])
    return _added(rows, keys, sums)


def _added(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    def kind(c: str):
        t = rows.schema[c].dataType
        return "bigint" if t.typeName() in ("integer", "short", "byte") else t
    return rows.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(kind(c)).alias(c) for c in sums],
                                   *[F.sum(c).cast("bigint").alias(c) for c in (*[_count(c) for c in sums], ROWS)])


class SummedView:
    """A view of SUMs by ``keys``, stored in month folders of the date key ``key``."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], sums: list[str], key: str = "date_key", key_range: tuple[int, int, int] = DATE_KEY_RANGE):
        self.spark, self.path, self.keys, self.sums, self.key, self.key_range = spark, path, keys, sums, key, key_range
        self.part = key + BUCKET_SUFFIX

    def _placed(self, groups: DataFrame) -> DataFrame:
        return groups.withColumn(self.part, range_bucket(self.key, *self.key_range))

    def create(self, base: DataFrame) -> None:
        write_date_partitioned(self._placed(signed(base, None, self.keys, self.sums)), self.path, self.part, overwrite="static")

    def stored(self, folders: list[int | None] | None = None) -> DataFrame:
        """The stored groups, all or those of some folders (a filter on the partition column, so no other folder is read)."""
        df = self.spark.read.parquet(self.path)
        if folders is None:
            return df
        some = [f for f in folders if f is not None]
        meet: Column = F.col(self.part).isin(some) if some else F.lit(False)
        return df.where(meet | F.col(self.part).isNull() if None in folders else meet)

    def refresh(self, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> None:
        """Bring the view up to date with base rows that came and went."""
        ensure_checkpoint_dir(self.spark)
        delta = self._placed(signed(inserted, deleted, self.keys, self.sums)).checkpoint(eager=True)
        folders = [r[0] for r in delta.select(self.part).distinct().collect()]  # as many as folders at most
        if not folders:
            return
        both = self.stored(folders).select(*delta.columns).unionByName(delta)
        left = self._placed(_added(both, self.keys, self.sums).where(F.col(ROWS) > 0)).checkpoint(eager=True)  # the folders read are written
        write_date_partitioned(left, self.path, self.part)
        kept = {r[0] for r in left.select(self.part).distinct().collect()}
        base = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for f in set(folders) - kept:
            name = "__HIVE_DEFAULT_PARTITION__" if f is None else f
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(base, f"{self.part}={name}"), True)

    def rows(self) -> DataFrame:
        """The view: keys and sums, a sum of NULLs only being NULL."""
        return self.stored().select(*self.keys, *[F.when(F.col(_count(c)) > 0, F.col(c)).alias(c) for c in self.sums])

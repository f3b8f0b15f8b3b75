"""Name -> DataFrame resolution for the warehouse tables.

Queries are plain functions whose parameters are table names. A
``Warehouse`` supplies those tables from one of three places:

* ``Warehouse.fixtures(spark, sf_dir)`` - the driver's test tables through
  the bridge projections (tests, bench, correctness check);
* ``Warehouse.from_root(spark, root)`` - one folder per table under a root
  (Parquet by default), as written by the table jobs;
* ``Warehouse.from_catalog(spark, database)`` - tables in a catalog.
"""

from __future__ import annotations

import inspect
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bridge


class Warehouse:
    def __init__(self, spark: SparkSession, resolve: Callable[[str], DataFrame]):
        self.spark = spark
        self._resolve = resolve
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._resolve(name)
        return self._cache[name]

    def run(self, fn: Callable[..., DataFrame], **overrides) -> DataFrame:
        """Call ``fn`` with every table parameter resolved by name."""
        args = {}
        for p in inspect.signature(fn).parameters.values():
            if p.name in overrides:
                args[p.name] = overrides[p.name]
            elif p.default is inspect.Parameter.empty:
                args[p.name] = self[p.name]
        return fn(**args)

    @classmethod
    def fixtures(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        fx = bridge.Fixtures(spark, sf_dir)

        def resolve(name: str) -> DataFrame:
            if name in bridge.BUILDERS:
                return bridge.BUILDERS[name](fx)
            if name in bridge.FIXTURE_TABLES:
                return fx(name)
            raise KeyError(f"no fixture bridge for table {name!r}")
        return cls(spark, resolve)

    @classmethod
    def from_root(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> "Warehouse":
        """Tables under ``root``; declared schemas are used (never inferred),
        with the partition folders' columns appended."""
        from . import schemas
        root = root.rstrip("/")

        def resolve(name: str) -> DataFrame:
            r = spark.read.format(fmt)
            if name in schemas.COLUMNS:
                from pyspark.sql.types import LongType, StructField, StructType
                sch = schemas.schema(name)
                extra = [StructField(c, LongType(), True) for c in schemas.partition_columns(name)
                         if c not in sch.fieldNames()]
                r = r.schema(StructType(sch.fields + extra))
            return r.load(f"{root}/{name}")
        return cls(spark, resolve)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None) -> "Warehouse":
        prefix = f"{database}." if database else ""
        return cls(spark, lambda name: spark.table(prefix + name))

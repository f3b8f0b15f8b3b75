"""Table-level jobs (L1-L8): layout-aware writers, retention, MV refresh, audits.

Layouts mirror the warehouse DDL on a file store:

* date partitions -> Hive-style ``col=value`` folders (L1);
* integer-range partitions -> a derived ``<col>__bucket`` partition column,
  with a reader that adds the bucket predicate so the range prunes (L2);
* clustering -> range partitioning + sort inside each file, so Parquet
  row-group statistics skip data for cluster-key predicates (L3).

Writers range-partition on (partition key, cluster keys / row hash) before
writing: a hot date is split over many tasks, and each task writes few
partition folders. Overwrites are dynamic (only touched partitions).
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BUCKET_SUFFIX = "__bucket"
UNPARTITIONED_BUCKET = -1        # keys outside [start, end)

# fixed values of the warehouse layout (must equal the reference DDL)
DATE_KEY_RANGE = (20200101, 20301201, 100)     # RANGE_BUCKET(date_key, GENERATE_ARRAY(...))
EFF_YEAR_RANGE = (2018, 2031, 1)
PARTITION_EXPIRATION_DAYS = 90


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/switchboard-tables/{name}-{uuid.uuid4().hex[:12]}"


def _n(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _spread(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def write_date_partitioned(df: DataFrame, path: str, date_col: str, mode: str = "overwrite",
                           num_partitions: int | None = None, max_records_per_file: int = 5_000_000,
                           overwrite: str = "dynamic") -> None:
    """L1: one folder per date value; dynamic overwrite replaces only the
    dates present in ``df``, static overwrite the whole table."""
    out = df.repartitionByRange(_n(df, num_partitions), F.col(date_col), _spread(df))
    (out.write.mode(mode).option("partitionOverwriteMode", overwrite)
     .option("maxRecordsPerFile", max_records_per_file).partitionBy(date_col).parquet(path))


def range_bucket(col: str, start: int, end: int, interval: int) -> Column:
    """RANGE_BUCKET over [start, end) step interval: bucket index, -1 outside
    the range, NULL for NULL keys."""
    c = F.col(col)
    inside = (c >= start) & (c < end)
    return (F.when(c.isNull(), F.lit(None)).when(inside, F.floor((c - start) / interval))
            .otherwise(F.lit(UNPARTITIONED_BUCKET))).cast("bigint")


def write_range_bucketed(df: DataFrame, path: str, key: str, start: int, end: int, interval: int,
                         cluster_cols: list[str] | None = None, mode: str = "overwrite",
                         num_partitions: int | None = None) -> None:
    """L2: integer-range partitioning through a derived bucket column."""
    b = key + BUCKET_SUFFIX
    out = df.withColumn(b, range_bucket(key, start, end, interval))
    order = [F.col(b)] + [F.col(c) for c in (cluster_cols or [])] + [_spread(df)]
    out = out.repartitionByRange(_n(df, num_partitions), *order).sortWithinPartitions(b, *(cluster_cols or []))
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(b).parquet(path)


def read_range(spark: SparkSession, path: str, key: str, lo: int, hi: int, start: int, end: int,
               interval: int) -> DataFrame:
    """Rows with lo <= key <= hi from an L2 table, with the bucket predicate
    added so that only the touched bucket folders are listed and read."""
    b = key + BUCKET_SUFFIX
    blo = (max(lo, start) - start) // interval
    bhi = (min(hi, end - 1) - start) // interval
    in_range = F.col(b).between(blo, bhi)
    spill = F.col(b) == UNPARTITIONED_BUCKET if (lo < start or hi >= end) else F.lit(False)
    df = spark.read.parquet(path)
    return df.where((in_range | spill) & F.col(key).between(lo, hi))


def write_clustered(df: DataFrame, path: str, cluster_cols: list[str], partition_col: str | None = None,
                    mode: str = "overwrite", num_partitions: int | None = None) -> None:
    """L3: CLUSTER BY as range partitioning on the cluster keys plus a sort
    inside each file; min/max statistics then prune row groups and files."""
    keys = ([partition_col] if partition_col else []) + cluster_cols
    out = df.repartitionByRange(_n(df, num_partitions), *[F.col(c) for c in keys], _spread(df))
    out = out.sortWithinPartitions(*keys)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_partitions(spark: SparkSession, path: str, partition_col: str) -> list[str]:
    """Partition values of a Hive-style table from the folder names (metadata
    only; bounded by the number of partitions)."""
    fs, p = _fs(spark, path)
    prefix = partition_col + "="
    return [s.getPath().getName()[len(prefix):] for s in fs.listStatus(p)
            if s.isDirectory() and s.getPath().getName().startswith(prefix)]


def expire_partitions(spark: SparkSession, path: str, partition_col: str, as_of: dt.date,
                      days: int = PARTITION_EXPIRATION_DAYS) -> list[str]:
    """L4: drop date partitions older than ``as_of - days`` (partition
    expiration). Only folder metadata is touched; returns dropped values."""
    cutoff = as_of - dt.timedelta(days=days)
    fs, p = _fs(spark, path)
    dropped = []
    for v in list_partitions(spark, path, partition_col):
        try:
            d = dt.date.fromisoformat(v)
        except ValueError:
            continue  # NULL / default partition is never expired
        if d < cutoff:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(p, f"{partition_col}={v}"), True)
            dropped.append(v)
    return sorted(dropped)


def refresh_materialized(view: DataFrame, path: str, key: str, touched: DataFrame | None = None,
                         key_range: tuple[int, int, int] | None = DATE_KEY_RANGE) -> None:
    """Make the stored result equal the query on the current base.

    The result is stored in the table's declared layout: range buckets of
    ``key`` (``key_range``), or one folder per key value when ``key_range``
    is None. With ``touched`` (one column: the keys whose base rows changed)
    only the partitions holding those keys are recomputed and overwritten
    (dynamic overwrite), and those of them that no row is left for are
    removed; without it the whole result is rewritten (static overwrite).
    The files are replaced in place: readers should not run meanwhile.
    """
    if key_range is None:
        part, view_p = key, view
        tk = None if touched is None else touched.select(F.col(touched.columns[0]).alias(part)).distinct()
    else:
        part = key + BUCKET_SUFFIX
        view_p = view.withColumn(part, range_bucket(key, *key_range))
        tk = None if touched is None else (touched.select(range_bucket(touched.columns[0], *key_range).alias(part))
                                           .distinct())
    if tk is not None:
        view_p = view_p.join(tk, view_p[part].eqNullSafe(tk[part]), "left_semi")
    if tk is None:
        write_date_partitioned(view_p, path, part, overwrite="static")
        return
    write_date_partitioned(view_p, path, part)
    # touched partitions (as many as folders at most) without a row any more
    gone = tk.join(view_p.select(F.col(part).alias("_p")).distinct(), F.col(part).eqNullSafe(F.col("_p")), "left_anti")
    spark = view.sparkSession
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in gone.select(F.coalesce(F.col(part).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))).collect():
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(base, f"{part}={r[0]}"), True)


def conformance_audit(df: DataFrame, targets: dict[str, str], epoch_ms_cols: tuple = (),
                      epoch_s_cols: tuple = ()) -> DataFrame:
    """Per column, rows, NULLs, values that fail the cast to the target
    type, and implausible epoch units; one pass, unpivoted to a long table."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c, t in targets.items():
        v = F.col(f"`{c}`")
        aggs.append(F.count(F.when(v.isNull(), 1)).alias(f"{c}__nulls"))
        aggs.append(F.count(F.when(v.isNotNull() & v.try_cast(t).isNull(), 1)).alias(f"{c}__bad_cast"))
        if c in epoch_ms_cols:
            aggs.append(F.count(F.when(F.abs(v.try_cast("bigint")) < 100_000_000_000, 1)).alias(f"{c}__bad_unit"))
        elif c in epoch_s_cols:
            aggs.append(F.count(F.when(F.abs(v.try_cast("bigint")) >= 100_000_000_000, 1)).alias(f"{c}__bad_unit"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"{c}__bad_unit"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("target_type"), F.col("__rows").alias("row_count"),
                     F.col(f"{c}__nulls").alias("null_count"), F.col(f"{c}__bad_cast").alias("bad_cast_count"),
                     F.col(f"{c}__bad_unit").cast("bigint").alias("bad_unit_count"))
            for c, t in targets.items()]
    return one.select(F.inline(F.array(*rows)))


def key_integrity_audit(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """Each check is (name, table of violating rows); returns one row per
    check with its violation count. Use ``duplicate_keys`` / ``orphans``."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
             for name, df in checks]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (anti join)."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    c = child.where(F.col(child_key).isNotNull())
    return c.join(p, F.col(child_key) == F.col("_pk"), "left_anti")


def layer_reconcile(staged: DataFrame, ods: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Per key (a NULL key is a key), rows and sum of ``measure`` on both
    layers, tagged and unioned into one aggregate, and a status."""
    u = (staged.select(*keys, F.col(measure).alias("_s"), F.lit(True).alias("_staged"))
         .unionByName(ods.select(*keys, F.col(measure).alias("_s"), F.lit(False).alias("_staged"))))
    side = {"staged": F.col("_staged"), "ods": ~F.col("_staged")}
    j = u.groupBy(*keys).agg(*[F.nullif(F.count_if(on), F.lit(0)).alias(f"{n}_rows") for n, on in side.items()],
                             *[F.sum(F.when(on, F.col("_s"))).alias(f"{n}_sum") for n, on in side.items()])
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    status = (F.when(F.col("staged_rows").isNull(), "MISSING_IN_STAGING")
              .when(F.col("ods_rows").isNull(), "MISSING_IN_ODS")
              .when(z("staged_rows") != z("ods_rows"), "ROW_COUNT_MISMATCH")
              .when(z("staged_sum") != z("ods_sum"), "SUM_MISMATCH").otherwise("OK"))
    return j.select(*keys, z("staged_rows").alias("staged_rows"), z("ods_rows").alias("ods_rows"),
                    "staged_sum", "ods_sum", status.alias("recon_status"))


def expire_table(spark: SparkSession, root: str, table: str, as_of: dt.date) -> list[str]:
    """L4 driven by the declared layout: the table's date partition column and
    its expiration days (tables without expiration are left alone)."""
    from ..sources.schemas import LAYOUT
    part, _cluster, days = LAYOUT[table]
    if days is None or part is None or part[1] is not None:
        return []
    return expire_partitions(spark, f"{root.rstrip('/')}/{table}", part[0], as_of, days)

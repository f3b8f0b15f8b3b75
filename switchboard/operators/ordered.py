"""Global order statistics without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one
task. The helpers here compute global row numbers, prefix sums, NTILE and
PERCENT_RANK across range partitions instead:

1. ``repartitionByRange`` + ``sortWithinPartitions`` on a total order;
2. a per-partition running count (the generated row id) or running sum
   of a weight (numpy cumsum inside each task);
3. one reliable ``checkpoint()`` so counts and values come from the same
   materialisation (range bounds and tie order are fixed after it);
4. per-partition totals -> exclusive offsets. That table has one row per
   partition, so its size is bounded by the partition count and it is
   broadcast.

Hot keys are split across partitions by the range partitioner, because
the sort key always ends with a unique tiebreak.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

_PID = "_sb_pid"
_LOC = "_sb_local"
_OFF = "_sb_offset"
_TOT = "_sb_total"


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _local_cumsum(weight: str | None):
    def run(batches):
        carry = {}
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(**{_LOC: pd.Series([], dtype="int64")})
                continue
            w = np.ones(len(pdf), dtype=np.int64) if weight is None else pdf[weight].fillna(0).to_numpy(np.int64)
            pid = int(pdf[_PID].iloc[0])
            start = carry.get(pid, 0)
            cs = np.cumsum(w) + start
            carry[pid] = int(cs[-1])
            yield pdf.assign(**{_LOC: cs})
    return run


def with_global_prefix_sum(df: DataFrame, order_cols: list, out: str, weight: str | None = None,
                           num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``weight`` (1 per row when None) in the
    global order ``order_cols`` (inclusive of the current row).

    Also adds ``_sb_total`` = sum of the weight over the whole table.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = _num_partitions(df, num_partitions)
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    if weight is None:
        # row counting stays in the JVM: the generated id is (partition index
        # << 33) + position of the row in its sorted partition
        mid = F.monotonically_increasing_id()
        local = (ranged.withColumn("_sb_mid", mid)
                 .withColumn(_PID, F.shiftright(F.col("_sb_mid"), 33))
                 .withColumn(_LOC, F.col("_sb_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
                 .drop("_sb_mid").checkpoint(eager=True))
    else:
        ranged = ranged.withColumn(_PID, F.spark_partition_id().cast("bigint"))
        schema = T.StructType(ranged.schema.fields + [T.StructField(_LOC, T.LongType(), False)])
        local = ranged.mapInPandas(_local_cumsum(weight), schema).checkpoint(eager=True)
    w = F.lit(1) if weight is None else F.coalesce(F.col(weight), F.lit(0))
    per_part = local.groupBy(_PID).agg(F.sum(w).cast("bigint").alias("_sb_n"))
    # one row per partition: a bounded table, ordered in one small task
    wspec = Window.orderBy(_PID)
    offsets = per_part.select(
        _PID,
        F.coalesce(F.sum("_sb_n").over(wspec.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(_OFF),
        F.sum("_sb_n").over(wspec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(_TOT))
    return (local.join(F.broadcast(offsets), _PID)
            .withColumn(out, (F.col(_OFF) + F.col(_LOC)).cast("bigint"))
            .drop(_PID, _LOC, _OFF))


def with_global_row_number(df: DataFrame, order_cols: list, out: str = "rn",
                           num_partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order_cols); order_cols must be a total order."""
    return with_global_prefix_sum(df, order_cols, out, None, num_partitions)


def with_global_ntile(df: DataFrame, buckets: int, order_cols: list, out: str,
                      num_partitions: int | None = None) -> DataFrame:
    """NTILE(buckets) OVER (ORDER BY order_cols) without a single-partition window."""
    r = with_global_row_number(df, order_cols, "_sb_rn", num_partitions)
    return r.withColumn(out, ntile_of(F.col("_sb_rn"), F.col(_TOT), buckets)).drop("_sb_rn", _TOT)


def with_global_percent_rank(df: DataFrame, value: str, tiebreak: list, out: str,
                             ascending: bool = True, num_partitions: int | None = None) -> DataFrame:
    """PERCENT_RANK() OVER (ORDER BY value): (rank - 1) / (n - 1).

    rank = first row number of the value's tie group. The tie groups are
    reduced by a partial aggregate, so a hot value costs one row per task.
    """
    order = [F.col(value).asc_nulls_first() if ascending else F.col(value).desc_nulls_last()] + tiebreak
    r = with_global_row_number(df, order, "_sb_rn", num_partitions)
    firsts = r.groupBy(value).agg(F.min("_sb_rn").alias("_sb_rank"))
    j = r.join(firsts, r[value].eqNullSafe(firsts[value]), "inner").drop(firsts[value])
    pr = F.when(F.col(_TOT) <= 1, F.lit(0.0)).otherwise((F.col("_sb_rank") - 1) / (F.col(_TOT) - 1))
    return j.withColumn(out, pr.cast("double")).drop("_sb_rn", "_sb_rank", _TOT)


def with_stepped_row_number(df: DataFrame, steps: list[Column], order_cols: list, out: str = "rn") -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order_cols) as one lazy plan: no range partitions, no checkpoint, no job before it is read.

    ``steps`` are ever finer keys that the order goes through one after another (say the whole part of a value, the
    value, a block of the tiebreak): a row's number is the rows of smaller first keys, plus those of the same first and a
    smaller second key, and so on, plus its place within the last. Each is a window over counts within the key before,
    so a window holds as many rows as a key has next keys; the first step's key should have few values. Also adds
    ``_sb_total``, the number of rows.
    """
    names = [f"_sb_s{i}" for i in range(len(steps))]
    # a struct, in which a NULL equals a NULL and comes first
    x = df.withColumns({n: F.struct(c) for n, c in zip(names, steps)})
    place = F.row_number().over(Window.partitionBy(*names).orderBy(*order_cols))
    numbered = x.withColumn(out, place.cast("bigint"))
    counts = x.groupBy(*names).agg(F.count(F.lit(1)).alias("_sb_n"))
    ahead = None
    for i in range(len(names)):
        level = counts.groupBy(*names[: i + 1]).agg(F.sum("_sb_n").alias("_sb_n"))
        inside = Window.partitionBy(*names[:i]) if i else Window.partitionBy()
        before = inside.orderBy(names[i]).rowsBetween(Window.unboundedPreceding, -1)
        cols = [*names[: i + 1], F.coalesce(F.sum("_sb_n").over(before), F.lit(0)).alias(f"_sb_a{i}")]
        level = level.select(*cols, *([F.sum("_sb_n").over(inside).alias(_TOT)] if not i else []))
        ahead = level if ahead is None else ahead.join(level, names[:i])
    joined = numbered.join(ahead, names)
    total = joined
    for i in range(len(names)):
        total = total.withColumn(out, F.col(out) + F.col(f"_sb_a{i}"))
    return total.drop(*names, *[f"_sb_a{i}" for i in range(len(names))])


def ntile_of(row_number: Column, total: Column, buckets: int) -> Column:
    """NTILE(buckets) from a row number and the number of rows."""
    base, rem = F.floor(total / buckets), total % buckets
    big = (base + 1) * rem  # rows held by the first ``rem`` larger buckets
    return (F.when(row_number <= big, F.floor((row_number - 1) / (base + 1)) + 1)
            .otherwise(rem + F.floor((row_number - big - 1) / F.greatest(base, F.lit(1))) + 1)).cast("bigint")

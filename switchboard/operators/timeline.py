"""Per-key sequences in two levels: (key, time bucket), then buckets of a key.

LAG, LEAD, LAST_VALUE, running counts and ordered string aggregation over
``PARTITION BY key ORDER BY time`` put all rows of a key into one task when
written as one window. Here the window's partition is (key, bucket of
``width`` time units), and what a bucket needs from the ones before it is
one row per (key, bucket), taken through a second, far smaller window
over the key. A key with a third of all rows is as many groups as it has
buckets. Everything is a lazy plan of built-in expressions: no sample, no
checkpoint, no choice by size, nothing collected.

Keys and buckets are wrapped in structs, in which a NULL equals a NULL as in
PARTITION BY, so they stay plain join keys and the window's shuffle serves the
join: the rows are shuffled once. A NULL time is a bucket of its own, before all others (NULLS FIRST).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X

#: seconds (units of the order column when that is a number) of a bucket
WIDTH = 3600

#: rows of a key up to which one task takes them in one window
LONG = 1_000_000

_K, _B = "_tl_key", "_tl_bucket"


def bucket(df: DataFrame, col: str, width: int = WIDTH) -> Column:
    """The time bucket of a timestamp, date or whole-number column."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return X.floor_div(F.datediff(F.col(col), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400, width)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return X.floor_div(X.epoch_seconds(col), width)
    return X.floor_div(F.col(col).cast("bigint"), width)


def long_keys(df: DataFrame, keys: list[str], limit: int = LONG) -> DataFrame:
    """The keys (NULLs too) that more than ``limit`` rows of ``df`` have: one of ``limit`` rows at most, so it may be broadcast."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tl_n")).where(F.col("_tl_n") > limit).select(*[F.col(k).alias(f"_tl_l{i}") for i, k in enumerate(keys)])


def split_long(df: DataFrame, keys: list[str], long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key is not one of ``long`` (made by ``long_keys``), and the others."""
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_tl_l{i}")) for i, k in enumerate(keys)])
    return df.join(F.broadcast(long), same, "left_anti"), df.join(F.broadcast(long), same, "left_semi")


def _keyed(df: DataFrame, keys: list[str], ts: str, width: int) -> DataFrame:
    return df.withColumns({_K: F.struct(*keys), _B: F.struct(bucket(df, ts, width))})


def _neighbour(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], value: str, out: str, width: int, ahead: bool) -> DataFrame:
    x = _keyed(df, keys, ts, width)
    names = [ts, *tiebreak]
    order = [F.col(c).desc_nulls_last() if ahead else F.col(c).asc_nulls_first() for c in names]
    inside = Window.partitionBy(_K, _B).orderBy(*order)
    over = Window.partitionBy(_K).orderBy(F.col(_B).desc_nulls_last() if ahead else F.col(_B).asc_nulls_first())
    last = F.min_by if ahead else F.max_by
    edge = x.groupBy(_K, _B).agg(last(F.struct(F.col(value).alias("v")), F.struct(*names)).alias("_tl_edge"))
    carried = edge.select(_K, _B, F.lag("_tl_edge").over(over).alias("_tl_carry"))
    x = x.withColumns({"_tl_near": F.lag(F.struct(F.col(value).alias("v"))).over(inside)})
    return x.join(carried, [_K, _B], "left").withColumn(out, F.coalesce("_tl_near", "_tl_carry")["v"]).drop(_K, _B, "_tl_near", "_tl_carry")


def with_previous(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], value: str, out: str, width: int = WIDTH) -> DataFrame:
    """Add ``out`` = LAG(value) OVER (PARTITION BY keys ORDER BY ts, tiebreak); the order must be total within a key."""
    return _neighbour(df, keys, ts, tiebreak, value, out, width, ahead=False)


def with_next(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], value: str, out: str, width: int = WIDTH) -> DataFrame:
    """Add ``out`` = LEAD(value) OVER (PARTITION BY keys ORDER BY ts, tiebreak)."""
    return _neighbour(df, keys, ts, tiebreak, value, out, width, ahead=True)


def carry_forward(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], cols: dict[str, str], width: int = WIDTH) -> DataFrame:
    """Add, for each ``cols`` entry in -> out, LAST_VALUE(in IGNORE NULLS) OVER (PARTITION BY keys ORDER BY ts, tiebreak)
    up to the row itself."""
    x = _keyed(df, keys, ts, width)
    order = [F.col(c).asc_nulls_first() for c in (ts, *tiebreak)]
    inside = Window.partitionBy(_K, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(_K).orderBy(F.col(_B).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct(ts, *tiebreak)
    closing = x.groupBy(_K, _B).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"_tl_c{i}") for i, c in enumerate(cols)])
    carried = closing.select(_K, _B, *[F.last(f"_tl_c{i}", ignorenulls=True).over(before).alias(f"_tl_c{i}") for i in range(len(cols))])
    x = x.withColumns({f"_tl_l{i}": F.last(c, ignorenulls=True).over(inside) for i, c in enumerate(cols)})
    j = x.join(carried, [_K, _B], "left")
    return j.withColumns({out: F.coalesce(f"_tl_l{i}", f"_tl_c{i}") for i, out in enumerate(cols.values())}).drop(
        _K, _B, *[f"_tl_{a}{i}" for a in "lc" for i in range(len(cols))])


def as_of(facts: DataFrame, versions: DataFrame, on: dict[str, str], fact_ts: str, version_ts: str, take: dict[str, str],
          tiebreak: list[str] | None = None, width: int = WIDTH, limit: int = LONG) -> DataFrame:
    """``facts`` with the columns ``take`` (version column -> new column) of the version in force at ``fact_ts``: the
    one of the same key (``on``: fact column -> version column) with the latest ``version_ts`` at or before it (ties:
    the largest ``tiebreak``). NULL where there is none, as for NULL keys and times. A fact is one row however many
    versions there are, and no pair of a fact and a version is formed. A key of up to ``limit`` facts and versions is one
    window, shuffled once; only longer ones are cut in buckets.
    """
    keys = [f"_ao_k{i}" for i in range(len(on))]
    told = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*on.values(), version_ts]])
    v = versions.where(told).select(*[F.col(c).alias(k) for k, c in zip(keys, on.values())], F.col(version_ts).alias("_ao_t"), F.lit(0).alias("_ao_kind"),
                                    F.struct(*(tiebreak or list(take))).alias("_ao_tie"), F.struct(*take).alias("_ao_v"))
    f = facts.select(*[F.col(c).alias(k) for k, c in zip(keys, on)], F.col(fact_ts).alias("_ao_t"), F.lit(1).alias("_ao_kind"),
                     F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_ao_f"))
    u = v.unionByName(f, allowMissingColumns=True)
    short, long = split_long(u, keys, long_keys(u, keys, limit))
    so_far = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in ("_ao_t", "_ao_kind", "_ao_tie")]).rowsBetween(Window.unboundedPreceding, 0)
    u = short.withColumn("_ao_at", F.last("_ao_v", ignorenulls=True).over(so_far)).unionByName(
        carry_forward(long, keys, "_ao_t", ["_ao_kind", "_ao_tie"], {"_ao_v": "_ao_at"}, width))
    return u.where(F.col("_ao_kind") == 1).select("_ao_f.*", *[F.col(f"_ao_at.{c}").alias(out) for c, out in take.items()])


def running_total(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], weight: str, out: str, width: int = WIDTH) -> DataFrame:
    """Add ``out`` = SUM(weight) OVER (PARTITION BY keys ORDER BY ts, tiebreak ROWS UNBOUNDED PRECEDING)."""
    x = _keyed(df, keys, ts, width)
    inside = Window.partitionBy(_K, _B).orderBy(*[F.col(c).asc_nulls_first() for c in (ts, *tiebreak)]).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(_K).orderBy(F.col(_B).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sums = x.groupBy(_K, _B).agg(F.sum(weight).alias("_tl_s"))
    ahead = sums.select(_K, _B, F.coalesce(F.sum("_tl_s").over(before), F.lit(0)).alias("_tl_ahead"))
    return (x.withColumn("_tl_run", F.sum(weight).over(inside)).join(ahead, [_K, _B], "left")
            .withColumn(out, F.col("_tl_ahead") + F.col("_tl_run")).drop(_K, _B, "_tl_run", "_tl_ahead"))


def ordered_concat(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], value: str, sep: str, out: str, width: int = WIDTH) -> DataFrame:
    """One row per key: ``value`` of its rows joined by ``sep`` in (ts, tiebreak) order (NULL values skipped, like ``array_join``).

    A bucket's rows are joined first, then a key's buckets: no task gathers the rows of a key, only its part strings.
    """
    x = _keyed(df.select(*dict.fromkeys([*keys, ts, *tiebreak, value])), keys, ts, width)
    rows = F.array_sort(F.collect_list(F.struct(*[F.struct(F.col(c).isNotNull().alias("some"), F.col(c).alias("v")).alias(f"o{i}")
                                                  for i, c in enumerate((ts, *tiebreak))], F.col(value).alias("_tl_v"))))
    part = x.groupBy(_K, _B).agg(rows.alias("r"), F.count(value).alias("n"))
    part = part.select(_K, _B, F.when(F.col("n") > 0, F.array_join(F.transform("r", lambda e: e["_tl_v"]), sep)).alias("p"))
    parts = F.array_sort(F.collect_list(F.struct(F.col(f"{_B}.col1").isNotNull().alias("some"), F.col(_B).alias("b"), "p")))
    return part.groupBy(_K).agg(F.array_join(F.transform(parts, lambda e: e["p"]), sep).alias(out)).select(f"{_K}.*", out)

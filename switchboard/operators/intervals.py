"""Range (interval) join as counts: no candidate pairs are materialised.

``probe LEFT JOIN point ON point.key = probe.key AND point.ts > probe.lo
AND point.ts <= probe.hi`` only feeds counts in the warehouse queries, so
what is needed per probe is m = number of matching points. With
P(k, x) = number of points with key k and ts <= x, m = P(k, hi) - P(k, lo).

Points and both probe ends are one table ordered by (key, ts, kind), points
before probe ends at equal ts; the running sum of the point weight gives P at
every probe end. It is taken in two levels (``timeline.running_total``), so a
customer with a third of all rows is as many groups as there are hours. Equal
probes have equal counts: they are one row with the number of its copies, which
pairs the two ends without a row id. O(n log n) work, no size switch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .timeline import WIDTH, running_total


def count_points_in_windows(points: DataFrame, probes: DataFrame, key: str, ts: str, lo: str, hi: str,
                            carry: list, out: str = "matches", copies: str | None = None, width: int = WIDTH) -> DataFrame:
    """``carry`` columns plus ``out`` = matching points: one row per probe row, or, with ``copies``, one row
    per distinct probe with its number of rows in that column.
    """
    k, t, n = "_iv_k", "_iv_t", "_iv_n"
    # equal (key, ts) points collapse into one weighted row (partial aggregate)
    pts = (points.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
           .groupBy(F.col(key).alias(k), F.col(ts).alias(t)).agg(F.count(F.lit(1)).alias("_iv_w")).withColumn("_iv_kind", F.lit(0)))
    distinct = probes.groupBy(F.col(key).alias(k), F.col(lo).alias("_iv_lo"), F.col(hi).alias("_iv_hi"), *carry).agg(F.count(F.lit(1)).alias(n))
    valid = F.col(k).isNotNull() & F.col("_iv_lo").isNotNull() & F.col("_iv_hi").isNotNull()
    probe = F.struct("_iv_lo", "_iv_hi", *carry, n)
    ends = (distinct.where(valid).select(k, probe.alias("_iv_p"), F.explode(F.array(F.struct(F.col("_iv_lo").alias("t"), F.lit(-1).alias("sign")),
                                                                                  F.struct(F.col("_iv_hi").alias("t"), F.lit(1).alias("sign")))).alias("_e"))
            .select(k, F.col("_e.t").alias(t), "_iv_p", F.col("_e.sign").alias("_iv_sign"), F.lit(0).cast("bigint").alias("_iv_w"), F.lit(1).alias("_iv_kind")))
    s = running_total(pts.unionByName(ends, allowMissingColumns=True), [k], t, ["_iv_kind", "_iv_p", "_iv_sign"], "_iv_w", "_iv_cum", width)
    counted = (s.where(F.col("_iv_kind") == 1).groupBy(k, "_iv_p").agg(F.sum(F.col("_iv_sign") * F.col("_iv_cum")).cast("bigint").alias(out))
               .select(*[F.col(f"_iv_p.{c}").alias(c) for c in carry], out, F.col(f"_iv_p.{n}").alias(n)))
    # probes that cannot match anything keep m = 0 (LEFT JOIN keeps them)
    nomatch = distinct.where(~valid).select(*carry, F.lit(0).cast("bigint").alias(out), n)
    found = counted.unionByName(nomatch)
    if copies:
        return found.withColumnRenamed(n, copies)
    return found.select(*carry, out, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n))).alias("_iv_i")).drop("_iv_i")

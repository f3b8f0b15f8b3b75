"""Embedding near-duplicates: exact metric range join over pivot cells.

Vectors of one label (and length) are scaled to unit length, where cosine
>= c means a distance of at most r = sqrt(2 - 2c). Each label has pivots;
a vector's home is the cell of its nearest pivot p. If u in cell p and v are
within r, then d(v, p) <= d(v, home(v)) + 2r by the triangle inequality, and
d(v, p) <= R_p + r with R_p the cell's radius; v is replicated to every cell
that meets both bounds, so all of u's partners visit u's cell and the cells
join independently. Cells are joined in blocks of at most about ``BLOCK``
home rows and as many visitors, so a crowded cell is many tasks.

Equal vectors are collapsed first and count with their multiplicity. A block
gives back, for each home row, the number of its links, and a spanning
forest of the links for the components: never the links themselves, whose
number grows with the square of a group.

Cosines are computed in double precision. Near the threshold the matrix
product's rounding could differ from the definition's, so values within
1e-9 of it are computed again, row by row, with the dot product and norms of
the given components.

Results for odd input: rows whose label or vector is null, or whose vector
is empty, zero or holds nulls or non-finite values, are linked with nothing;
a null vec_id is linked with nothing; repeated rows are copies like any
other (each links with the rest).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch

#: rows of a block; vectors a pivot stands for; most pivots of a label (a label with more has fuller cells, in more blocks)
BLOCK, CELL, PIVOTS = 2048, 4096, 256


def _unit(vecs) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vecs])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # norms neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def _cosine(x: np.ndarray, y: np.ndarray) -> float:
    return float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())))


def _homes(radius: float):
    def run(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        """Each vector's nearest pivot, and the pivots it may have to visit with the distance to each."""
        if not len(rows):
            return pd.DataFrame({"rep": pd.Series(dtype="int64"), "home": pd.Series(dtype="int32"), "near": pd.Series(dtype="float64"), "visit": pd.Series(dtype="object"), "far": pd.Series(dtype="object")})
        pivots = pivots.sort_values("pivot")
        d = _distance(_unit(rows["embedding"]), _unit(pivots["embedding"]))
        home = d.argmin(axis=1)
        near = d.min(axis=1)
        can = d <= (near + 2 * radius + 1e-9)[:, None]
        ids = pivots["pivot"].to_numpy(np.int32)
        return pd.DataFrame({"rep": rows["rep"].to_numpy(), "home": ids[home], "near": near,
                             "visit": [ids[c] for c in can], "far": [x[c] for x, c in zip(d, can)]})
    return run


def _forest(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Enough of the links to connect what they connect: a search by breadth from side to side, each row and column once."""
    out = []
    rows, columns = hit.any(axis=1), hit.any(axis=0)  # those not reached yet
    for start in np.flatnonzero(rows):
        if not rows[start]:
            continue
        rows[start] = False
        at = np.array([start])
        while len(at):
            new = np.flatnonzero(columns)
            links = hit[np.ix_(at, new)]
            met = links.any(axis=0)
            new, by = new[met], at[links[:, met].argmax(axis=0)]
            columns[new] = False
            out += zip(left[by].tolist(), right[new].tolist())
            other = np.flatnonzero(rows)
            links = hit[np.ix_(other, new)]
            met = links.any(axis=1)
            at, by = other[met], new[links[met].argmax(axis=1)] if len(new) else new
            rows[at] = False
            out += zip(left[at].tolist(), right[by].tolist())
    return out


def _join_block(cosine: float):
    def run(home: pd.DataFrame, visit: pd.DataFrame) -> pd.DataFrame:
        """For each home row: (rep, null, links); for each link of the forest: (rep, other, 0)."""
        if not len(home) or not len(visit):
            return pd.DataFrame({"rep": pd.Series(dtype="int64"), "other": pd.Series(dtype="Int64"), "n": pd.Series(dtype="int64")})
        a, b = home["rep"].to_numpy(np.int64), visit["rep"].to_numpy(np.int64)
        x, y = _unit(home["embedding"]), _unit(visit["embedding"])
        c = x @ y.T
        hit = c >= cosine
        for i, j in zip(*np.nonzero(np.abs(c - cosine) < 1e-9)):
            u, v = (np.asarray(t, np.float64) for t in (home["embedding"].iloc[i], visit["embedding"].iloc[j]))
            hit[i, j] = _cosine(u, v) >= cosine
        hit &= a[:, None] != b[None, :]
        n = hit @ visit["copies"].to_numpy(np.int64)
        links = _forest(hit, a, b)
        return pd.DataFrame({"rep": np.concatenate([a[n > 0], np.array([p[0] for p in links], np.int64)]),
                             "other": pd.array([pd.NA] * int((n > 0).sum()) + [p[1] for p in links], dtype="Int64"),
                             "n": np.concatenate([n[n > 0], np.zeros(len(links), np.int64)])})
    return run


def _renewed(df: DataFrame) -> DataFrame:
    """The same columns under new ids, for a cogroup with a table of the same origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def similar_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """One row a row of ``vectors``(vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    radius = float(np.sqrt(2 - 2 * cosine))
    v = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                       F.col("label").cast("string").alias("label"))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
             & F.forall("embedding", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
             & F.exists("embedding", lambda e: e != 0))
    # equal vectors: +0 and -0 alike; grouped by a hash first, with the vector itself as the key's second part
    v = v.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("embedding", F.transform("embedding", lambda e: e + 0.0))
    sides = v.where("sound").withColumn("h", F.xxhash64("label", "embedding"))
    reps = scratch.keep(sides.groupBy("h", "label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                        .withColumn("dim", F.size("embedding")), "reps")
    key = ["label", "dim"]
    order = F.xxhash64(F.lit(3), "h")
    sizes = scratch.keep(reps.groupBy(*key).agg(F.count(F.lit(1)).alias("size")), "sizes")
    # a label's pivots: those of its vectors whose hash is among the first; about size / CELL, PIVOTS at most
    want = F.least(F.lit(PIVOTS), F.ceil(F.col("size") / CELL))
    chance = F.pmod(order, F.lit(1_000_000_007)) / 1_000_000_007.0
    drawn = reps.join(sizes, key).where(chance < 4 * want / F.col("size")).select(*key, "embedding", order.alias("o"), want.alias("want"))
    least = reps.groupBy(*key).agg(F.min(F.struct(order.alias("o"), "embedding")).alias("p")).select(*key, "p.embedding", "p.o", F.lit(1).alias("want"))
    by_order = Window.partitionBy(*key).orderBy("o", "embedding")
    pivots = scratch.keep(drawn.union(least).dropDuplicates([*key, "o"]).withColumn("pivot", F.row_number().over(by_order))
                          .where("pivot <= greatest(want, 1) or pivot = 1").select(*key, "pivot", "embedding"), "pivots")
    shares = F.ceil(F.col("size") / CELL).cast("int")
    sized = reps.join(sizes, key).withColumn("share", F.pmod(F.xxhash64(F.lit(5), "h"), F.greatest(shares, F.lit(1))).cast("int")).select(*key, "share", "rep", "embedding")
    each = pivots.join(sizes, key).withColumn("share", F.explode(F.sequence(F.lit(0), F.greatest(shares, F.lit(1)) - 1))).select(*key, "share", "pivot", "embedding")
    homes = scratch.keep(sized.groupBy(*key, "share").cogroup(_renewed(each).groupBy(*key, "share")).applyInPandas(
        _homes(radius), "rep bigint, home int, near double, visit array<int>, far array<double>"), "homes")
    placed = reps.select("rep", *key, "embedding", "copies").join(homes, "rep")
    cells = scratch.keep(placed.groupBy(*key, F.col("home").alias("cell")).agg(F.max("near").alias("wide"), F.count(F.lit(1)).alias("rows")), "cells")
    visits = (placed.select("rep", *key, "embedding", "copies", F.explode(F.arrays_zip("visit", "far")).alias("z"))
              .select("rep", *key, "embedding", "copies", F.col("z.visit").alias("cell"), F.col("z.far").alias("far"))
              .join(cells, [*key, "cell"]).where(F.col("far") <= F.col("wide") + radius + 1e-9))
    guests = visits.groupBy(*key, "cell").agg(F.count(F.lit(1)).alias("guests"))
    blocks = scratch.keep(cells.join(guests, [*key, "cell"]).select(*key, "cell", F.ceil(F.col("rows") / BLOCK).cast("int").alias("bi"),
                                                                  F.ceil(F.col("guests") / BLOCK).cast("int").alias("bj")), "blocks")
    spread = F.xxhash64(F.lit(9), "rep")
    own = (placed.select("rep", *key, "embedding", "copies", F.col("home").alias("cell")).join(blocks, [*key, "cell"])
           .withColumn("i", F.pmod(spread, F.col("bi")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("bj") - 1))))
    guest = (visits.select("rep", *key, "embedding", "copies", "cell").join(blocks, [*key, "cell"])
             .withColumn("j", F.pmod(spread, F.col("bj")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("bi") - 1))))
    at = [*key, "cell", "i", "j"]
    found = scratch.keep(own.select(*at, "rep", "embedding").groupBy(*at).cogroup(
        _renewed(guest.select(*at, "rep", "embedding", "copies")).groupBy(*at)).applyInPandas(_join_block(cosine), "rep bigint, other bigint, n bigint"), "found")
    labels = connected_components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")), scratch)
    counts = found.where("other is null").groupBy("rep").agg(F.sum("n").alias("links"))
    roots = labels.select(F.col("id").alias("rep"), F.col("label").alias("root"))
    classes = (reps.select("h", "label", "embedding", "rep", "copies").join(counts, "rep", "left").join(roots, "rep", "left")
               .select("h", "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "rep").alias("root")))
    all_rows = v.withColumn("h", F.when(F.col("sound"), F.xxhash64("label", "embedding")))
    return (all_rows.join(classes, ["h", "label", "embedding"], "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"),
                    F.coalesce(F.col("vec_id") == F.coalesce("root", "vec_id"), F.lit(True)).alias("kept")))

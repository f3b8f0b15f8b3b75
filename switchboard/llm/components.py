"""Connected components of a link table, as DataFrame joins.

Each round every vertex takes the smallest label among its own, its
neighbours' and its label's label; rounds needed grow with the logarithm of
the longest chain. Labels stay in tables; only whether rows changed comes to
the driver. A vertex with very many links is no hot task: links are
aggregated before they are shuffled, and the join against one row a vertex
can be split. A vertex's label counts as one more neighbour, so a round is a
single join of links and labels with the labels: each join of a small table
is a broadcast that the driver builds and holds, whatever its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links(a, b) of comparable ids -> (id, label): the smallest id reachable, for every id in ``links``.

    Repeated links, links to itself and both directions are allowed; links
    with a null end are ignored.
    """
    ok = links.where("a is not null and b is not null and a <> b")
    ways = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba")])
    edges = scratch.keep(ok.select(F.explode(ways).alias("e")).select("e.*").distinct(), "edges")
    labels = scratch.keep(edges.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "labels")
    while True:
        near = edges.select("a", "b", F.lit(None).cast(edges.schema["a"].dataType).alias("was")).union(
            labels.select("id", "label", F.col("label").alias("was")))
        new = scratch.keep(near.join(labels, near.b == labels.id).groupBy(F.col("a").alias("id")).agg(
            F.min("label").alias("label"), F.max("was").alias("was")), "labels")
        moved = not new.where("label < was").isEmpty()
        scratch.drop(labels)
        labels = new.drop("was")
        labels._scratch_path = new._scratch_path
        if not moved:
            scratch.drop(edges)
            return labels

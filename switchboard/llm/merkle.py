"""Merkle dataset manifest: a tree of SHA-256 midstates per source, folded from a replaced leaf with right siblings only.

Every document is a leaf; a source's leaves, by doc_id, make a tree of arity
``ARITY``; the sources' roots make another one, whose root stands for the
data set. A parent's digest is the hash of its children's digests as hex text. As
such a digest is one hash block, a parent keeps the hash state before each
child's slot (32 bytes): to know the root after a leaf has changed, hashing is
taken up from the state before its slot with the new digest and the siblings
to its right; what stands to its left is never read again, and so on upwards.

The tree is made in cells of ARITY ** LEVELS consecutive leaves: a cell is one
group of a Spark job and holds LEVELS levels of the tree, the cells' tops are
the leaves of the next stage, so a source with a third of all rows is very many
groups and the number of stages grows with the logarithm of the rows. Places
within a source come from range partitions, each of which adds what its
predecessors hold of the source. Cells, with all digests and states, are a
table in the shared folder.

``Manifest(docs)`` builds the tree; ``roots()`` gives the sources' subroots and
the root, ``fold(leaves)`` the proof and the folded root of every leaf.

Results for odd input: null values are hashed as "-" (never equal to a text of
"-", which is "1:-"); a null doc_id comes first in its source, a null source is a source
of its own and comes first; equal doc_ids are ordered by their leaf; repeated
rows are leaves each; empty texts are "0:"; a text of any length is one leaf;
an empty table has no roots and gives no rows; columns other than
``FIELDS`` are no part of a leaf, whatever their names, and are not in the
results; columns of ``FIELDS`` that are missing count as null. All rows of one
doc_id are sorted in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import sha256 as S
from .scratch import Scratch

#: children of a parent; levels of the tree that a cell holds
ARITY, LEVELS = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: keys of a tree: whether the source is null, the source
KEYS = ["_none", "_source"]
_CELL = "_none boolean, _source string, cell bigint, size bigint, n bigint, digests binary, states binary, top binary"
_PATH = "array<struct<left: binary, state: binary, right: binary, n: int>>"


def leaf_digest(fields: list[Column]) -> Column:
    """The leaf's digest, 32 bytes."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.unhex(F.sha2(F.concat(*[part(c) for c in fields]), 256))


def midstates(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the state before each child's slot, the parents' digests) of one level (n x 32 bytes)."""
    n = len(digests)
    parents = -(-n // ARITY)
    blocks = S.hex_blocks(digests)
    state = np.repeat(S.START[None, :], parents, axis=0)
    before = np.empty((n, 8), np.uint32)
    for slot in range(ARITY):
        child = np.arange(slot, n, ARITY)
        if not len(child):
            break
        before[child] = state[: len(child)]
        state[: len(child)] = S.absorb(state[: len(child)], blocks[child])
    width = np.minimum(ARITY, n - ARITY * np.arange(parents))
    return S.to_bytes(before), S.finished(state, width)


def fold_level(digests: np.ndarray, states: np.ndarray, at: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The parents' digests when child ``at[i]`` has the digest ``new[i]``, from the kept states and the right siblings."""
    n = len(digests)
    state = S.absorb(S.from_bytes(states[at]), S.hex_blocks(new))
    end = np.minimum((at // ARITY + 1) * ARITY, n)
    for step in range(1, ARITY):
        go = np.flatnonzero(at + step < end)
        if not len(go):
            break
        state[go] = S.absorb(state[go], S.hex_blocks(digests[at[go] + step]))
    return S.finished(state, end - at // ARITY * ARITY)


def _heights(size: int, n: int, levels: int) -> list[int]:
    """The sizes of the levels that a cell of ``size`` leaves in a tree of ``n`` keeps, from below, its top not included."""
    out = []
    while len(out) < levels and (n > ARITY ** levels or size > 1):
        out.append(size)
        size = -(-size // ARITY)
    return out


def _bytes(column) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x) for x in column), np.uint8).reshape(len(column), 32)


def _grow(levels: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """A cell's row, from its leaves."""
        rows = rows.sort_values("pos")
        level, n = _bytes(rows["digest"]), int(rows["n"].iloc[0])
        digests, states = [], []
        for _ in _heights(len(level), n, levels):
            before, above = midstates(level)
            digests.append(level)
            states.append(before)
            level = above
        one = rows.iloc[0]
        return pd.DataFrame({"_none": [bool(one["_none"])], "_source": [one["_source"]], "cell": [int(one["cell"])], "size": [len(rows)], "n": [n],
                             "digests": [b"".join(x.tobytes() for x in digests)], "states": [b"".join(x.tobytes() for x in states)], "top": [level[0].tobytes()]})
    return run


class _Cell:
    """A cell as kept: its levels' digests and states, and the path from its top to its tree's root."""

    def __init__(self, row, levels: int):
        self.levels, lo = [], 0
        sizes = _heights(int(row["size"]), int(row["n"]), levels)
        digests, states = (np.frombuffer(bytes(row[c]), np.uint8).reshape(-1, 32) for c in ("digests", "states"))
        for size in sizes:
            self.levels.append((digests[lo: lo + size], states[lo: lo + size]))
            lo += size
        self.above = [{k: (s[k] if k == "n" else bytes(s[k])) for k in ("left", "state", "right", "n")} for s in row["path"]]

    def path(self, leaf: int) -> list[dict]:
        """What stands beside a leaf on its way to the root, level by level."""
        out = []
        for digests, states in self.levels:
            lo = leaf // ARITY * ARITY
            run = S.hex_blocks(digests[lo: lo + ARITY])
            out.append({"left": run[: leaf - lo].tobytes(), "state": states[leaf].tobytes(), "right": run[leaf - lo + 1:].tobytes(), "n": len(run)})
            leaf //= ARITY
        return out + self.above

    def proofs(self, leaves: np.ndarray) -> list[str]:
        """Hashes of all siblings on each leaf's way."""
        rest = b"".join(s["left"] + s["right"] for s in self.above)
        upper = {0: rest}
        for digests, _ in reversed(self.levels[1:]):
            blocks = S.hex_blocks(digests)
            upper = {i: blocks[i // ARITY * ARITY: i].tobytes() + blocks[i + 1: i // ARITY * ARITY + ARITY].tobytes() + upper[i // ARITY] for i in range(len(blocks))}
        if not self.levels:
            return [hashlib.sha256(rest).hexdigest()] * len(leaves)
        text = S.hex_blocks(self.levels[0][0]).tobytes()
        out = []
        for i in leaves.tolist():
            lo = i // ARITY * ARITY
            out.append(hashlib.sha256(text[64 * lo: 64 * i] + text[64 * (i + 1): 64 * (lo + ARITY)] + upper[i // ARITY]).hexdigest())
        return out

    def roots(self, leaves: np.ndarray, new: np.ndarray) -> np.ndarray:
        """The roots of the whole tree when ``leaves[i]`` has the digest ``new[i]``.

        Leaves that lead to the same digest in the same place are folded on as one.
        """
        at, digest = leaves, new
        of = np.arange(len(leaves))
        for digests, states in self.levels:
            digest = fold_level(digests, states, at, digest)
            at = at // ARITY
            both = np.concatenate([np.ascontiguousarray(at.astype(np.int64)).view(np.uint8).reshape(len(at), 8), digest], axis=1)
            _, first, back = np.unique(np.ascontiguousarray(both).view("V40").ravel(), return_index=True, return_inverse=True)
            at, digest, of = at[first], digest[first], back[of]
        for s in self.above:
            state = np.repeat(S.from_bytes(np.frombuffer(s["state"], np.uint8).reshape(1, 32)), len(digest), axis=0)
            state = S.absorb(state, S.hex_blocks(digest))
            for k in range(0, len(s["right"]), 64):
                state = S.absorb(state, np.frombuffer(s["right"][k: k + 64], np.uint8).reshape(1, 64))
            digest = S.finished(state, np.full(1, s["n"]))
        return digest[of]


def _child_paths(levels: int):
    def run(cells: pd.DataFrame, paths: pd.DataFrame) -> pd.DataFrame:
        """The paths of a cell's leaves: (keys, pos, path)."""
        if not len(cells) or not len(paths):
            return pd.DataFrame({"_none": pd.Series(dtype="bool"), "_source": pd.Series(dtype="object"), "pos": pd.Series(dtype="int64"), "path": pd.Series(dtype="object")})
        row = cells.iloc[0].copy()
        row["path"] = paths["path"].iloc[0]
        cell, size = _Cell(row, levels), int(row["size"])
        return pd.DataFrame({"_none": [bool(row["_none"])] * size, "_source": [row["_source"]] * size,
                             "pos": int(row["cell"]) * ARITY ** levels + np.arange(size), "path": [cell.path(i) for i in range(size)]})
    return run


_FOLDED = ("id", "doc_id", "leaf", "subroot", "proof_sha256", "folded_root")


def _fold(levels: int):
    def run(rows: pa.Table, cells: pa.Table) -> pa.Table:
        """Arrow tables, so that a doc_id keeps its type beside nulls."""
        got = cells.to_pylist() if rows.num_rows else []
        if not got:
            return pa.table({"id": pa.array([], pa.int64()), "doc_id": rows["doc_id"].slice(0, 0), **{c: pa.array([], pa.string()) for c in _FOLDED[2:]}})
        cell, at = _Cell(got[0], levels), rows["pos"].to_numpy() % ARITY ** levels
        roots = cell.roots(at, _bytes(rows["new"].to_pylist()))
        return pa.table({"id": rows["id"], "doc_id": rows["doc_id"], "leaf": pa.array([x.hex() for x in rows["leaf"].to_pylist()], pa.string()),
                         "subroot": pa.array([got[0]["subroot"].hex()] * rows.num_rows, pa.string()),
                         "proof_sha256": pa.array(cell.proofs(at), pa.string()), "folded_root": pa.array([x.tobytes().hex() for x in roots], pa.string())})
    return run


def _places(rows: DataFrame, order: list, scratch: Scratch) -> DataFrame:
    """``rows`` with ``pos`` (from 0, in ``order`` within the keys) and ``n`` (rows of the keys)."""
    ranged = rows.repartitionByRange(*KEYS, *order).sortWithinPartitions(*KEYS, *order)
    local = scratch.keep(ranged.withColumn("_at", F.monotonically_increasing_id()), "ordered").withColumn("_part", F.shiftright("_at", 33))
    held = local.groupBy(*KEYS, "_part").agg(F.min("_at").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    over = Window.partitionBy(*KEYS)
    earlier = over.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(*KEYS, "_part", "_lo", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_ahead"), F.sum("_n").over(over).alias("n"))
    # the keys of this join hold no more rows than a range partition does
    return local.join(held, [*KEYS, "_part"]).withColumn("pos", F.col("_ahead") + F.col("_at") - F.col("_lo")).drop("_at", "_part", "_lo", "_ahead")


def _renewed(df: DataFrame) -> DataFrame:
    """The same columns under new ids, for a cogroup with a table of the same origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


class _Trees:
    """The trees over nodes (keys, pos, n, digest): a table of cells a stage."""

    def __init__(self, nodes: DataFrame, scratch: Scratch, levels: int):
        self.scratch, self.stages, self.levels, self.size = scratch, [], levels, ARITY ** levels
        most = nodes.agg(F.max("n")).first()[0] or 0
        while most:
            dealt = nodes.select(*KEYS, "pos", "n", "digest", F.floor(F.col("pos") / self.size).cast("bigint").alias("cell"))
            cells = scratch.keep(dealt.groupBy(*KEYS, "cell").applyInPandas(_grow(levels), _CELL), "cells")
            self.stages.append(cells)
            most = -(-most // self.size) if most > self.size else 0
            nodes = cells.where(F.col("n") > self.size).select(*KEYS, F.col("cell").alias("pos"), F.ceil(F.col("n") / self.size).cast("bigint").alias("n"), F.col("top").alias("digest"))

    def tops(self) -> DataFrame:
        out = None
        for cells in self.stages:
            one = cells.where(F.col("n") <= self.size).select(*KEYS, F.col("top").alias("subroot"))
            out = one if out is None else out.union(one)
        return out

    def cells(self, above: DataFrame) -> DataFrame:
        """The cells of the leaves with their paths, ``above``(keys, path) being the paths of the trees' roots."""
        ready = None
        for cells in reversed(self.stages):
            last = cells.where(F.col("n") <= self.size).select(*KEYS, "cell").join(above, KEYS)
            paths = last if ready is None else last.unionByName(ready)
            if cells is self.stages[0]:
                return cells.join(paths, [*KEYS, "cell"])
            at = [*KEYS, "cell"]
            found = cells.groupBy(*at).cogroup(_renewed(paths).groupBy(*at)).applyInPandas(_child_paths(self.levels), f"_none boolean, _source string, pos bigint, path {_PATH}")
            ready = self.scratch.keep(found, "paths").withColumnRenamed("pos", "cell")


def _field(docs: DataFrame, name: str) -> Column:
    return F.col(name) if name in docs.columns else F.lit(None).cast("string")


class Manifest:
    """The trees of ``docs``; ``extra`` columns (name -> Column over docs) are kept with each leaf."""

    def __init__(self, docs: DataFrame, levels: int = LEVELS, **extra: Column):
        self.scratch, self.levels = Scratch(docs.sparkSession, "merkle"), levels
        fields = [_field(docs, c) for c in FIELDS]
        source = fields[FIELDS.index("source")].cast("string")
        order = [F.asc_nulls_first("doc_id"), "leaf", *[F.asc_nulls_first(k) for k in extra]]
        leaves = self.scratch.keep(docs.select(source.isNull().alias("_none"), F.coalesce(source, F.lit("")).alias("_source"), fields[0].alias("doc_id"),
                                               leaf_digest(fields).alias("leaf"), *[v.alias(k) for k, v in extra.items()]), "leaves")
        placed = _places(leaves, order, self.scratch).withColumn("id", F.monotonically_increasing_id())
        #: one row a document: id (any), keys, doc_id, leaf (32 bytes), extra columns, pos and n within the source
        self.leaves = self.scratch.keep(placed, "places")
        self._trees = _Trees(self.leaves.withColumnRenamed("leaf", "digest"), self.scratch, levels)
        self._top = None
        if self._trees.stages:
            subroots = self.scratch.keep(self._trees.tops(), "subroots")
            ranked = subroots.select(F.lit(False).alias("_none"), F.lit("").alias("_source"), F.col("_none").alias("none"), F.col("_source").alias("source"), "subroot")
            self._sources = self.scratch.keep(_places(ranked, [F.desc("none"), "source"], self.scratch), "sources")
            self._top = _Trees(self._sources.withColumnRenamed("subroot", "digest"), self.scratch, levels)

    def root(self) -> str | None:
        """The data set's root, None of an empty table."""
        return bytes(self._top.tops().first()["subroot"]).hex() if self._top else None

    def roots(self) -> DataFrame:
        """source, subroot."""
        return self._sources.select(F.when(~F.col("none"), F.col("source")).alias("source"), F.lower(F.hex("subroot")).alias("subroot"))

    def cells(self) -> DataFrame:
        """The cells of the sources' trees: what is kept, the path from each cell's top to the data set's root, and the subroot."""
        none = self._top.tops().select(*KEYS, F.array().cast(_PATH).alias("path"))
        run = _child_paths(self.levels)
        paths = self._top.cells(none).groupBy(*KEYS, "cell").applyInPandas(lambda c: run(c, c), f"_none boolean, _source string, pos bigint, path {_PATH}")
        paths = self.scratch.keep(paths, "tops").select("pos", "path")
        named = self._sources.select("pos", F.col("none").alias("_none"), F.col("source").alias("_source"), "subroot")
        above = named.join(paths, "pos").drop("pos")
        return self._trees.cells(above.drop("subroot")).join(named.drop("pos"), KEYS)

    def fold(self, new: str = "leaf") -> DataFrame:
        """One row a leaf: id, doc_id, leaf, subroot, proof_sha256 (of its siblings' digests, level by level) and folded_root, the
        root when its digest is that of the column ``new`` (null: the leaf's own)."""
        kind = self.leaves.schema["doc_id"].dataType.simpleString()
        if not self._top:
            return self.leaves.select("id", "doc_id", *[F.lit(None).cast("string").alias(c) for c in _FOLDED[2:]])
        at = [*KEYS, "cell"]
        dealt = self.leaves.select("id", "doc_id", *KEYS, "pos", "leaf", F.coalesce(new, "leaf").alias("new"), F.floor(F.col("pos") / ARITY ** self.levels).cast("bigint").alias("cell"))
        cells = _renewed(self.scratch.keep(self.cells(), "folding"))
        return dealt.groupBy(*at).cogroup(cells.groupBy(*at)).applyInArrow(
            _fold(self.levels), f"id bigint, doc_id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")


def verified_manifest(docs: DataFrame, tampered: Column, changed: dict[str, Column], levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document, those where ``tampered`` holds with the fields ``changed``."""
    fields = [changed.get(c, _field(docs, c)) for c in FIELDS]
    made = Manifest(docs, levels, other=F.when(tampered, leaf_digest(fields)))
    root = F.lit(made.root()).cast("string")
    return made.fold("other").select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))

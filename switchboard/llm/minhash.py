"""Near-duplicate documents: chosen-path set similarity join.

A document is the set of its distinct k-word shingles. Documents of equal
sets form one class; each class has a sketch of ``SKETCH`` minwise values.
Every tree of the join starts with all classes and branches them by minwise
values: a node picks a few sketch coordinates (by a hash of the node) and
sends each class to a child for each, named after the value found there
(below the roots a child takes ``GROUP`` coordinates at once, so that classes
of lower similarity part quickly). Every class of a node is compared with the
node's hub class, and nodes of at most ``SMALL`` classes are compared
exhaustively; larger ones whose classes are not all connected are branched
again. What is large after ``DEPTH`` levels is compared exhaustively but for
pairs already connected, so no node is cut short. Candidates are those that
pass two sketch tests: four-bit minwise values (see ``MAX_OFF``) and parity
bits, of which two sets never differ in more than they differ in shingles, so
that test loses no pair and is sharp for texts of up to ``PARITY`` shingles.
They are confirmed on the full shingle sets.

A pair whose classes are already connected by links to hubs needs no
comparison for the components asked for; nodes of one such component are
dropped. Each node picks its own hub, so the many nodes that a large group of
near copies meets in give it many hubs, and few of its classes stay apart.

Recall: a pair of similarity 0.8 shares a root child with probability 0.8 and,
below it, one of ``BRANCH`` children with 1 - (1 - 0.8^4)^6 = 0.96;
with ``TREES`` x ``ROOT`` = 8 root children the pair is met with
1 - (1 - 0.8 * 0.96)^8 > 0.9999 (0.998 for a sketch that by chance shows 0.7).

Results for odd input: null, empty and blank texts have no shingles and are
linked with nothing; rows with a null doc_id are linked with nothing and
have a null component; repeated rows each come back, with one result; rows
of one doc_id with several texts are each judged by their own text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bytetext as B
from .components import connected_components
from .scratch import Scratch

SKETCH = 64
TREES, ROOT, BRANCH, GROUP = 4, 2, 6, 4
SMALL, DEPTH = 48, 2
#: rows of a large node that are compared with one unconnected class at once
REST = 1024
#: Of 64 four-bit minwise values, a pair of similarity 0.8 differs in 12 on average (sd 3.1); more than
#: this many is 4.7 deviations away.
MAX_OFF = 26
#: parity bits of a set: bit i is the parity of the number of its shingles that hash to i
PARITY = 512
#: bits of the filter that spares texts without candidates from being shuffled (1 MB, whatever the input)
FILTER_BITS = 23

_SIG = [f"s{j}" for j in range(SKETCH // 16)] + [f"p{j}" for j in range(PARITY // 64)]
_A = B.mix(np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _distinct(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each row, sorted, and where each row's begin."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    h = h.copy()
    for i in range(len(first) - 1):
        h[first[i]: first[i + 1]].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(first) - 1))]).astype(np.int64)


def _sketch_rows(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    h, first = B.shingles(B.words(B.flat(batch.column(1)), B.SPACED), k)
    h, first = _distinct(h, first)
    n = np.diff(first)
    rows, full = len(n), np.flatnonzero(n)
    mins = np.zeros((SKETCH, rows), np.uint32)
    sums = np.zeros((2, rows), np.uint64)
    parity = np.zeros((rows, PARITY // 64), np.uint64)
    slot = (B.mix(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(PARITY)).astype(np.int64)
    np.bitwise_xor.at(parity.reshape(-1), np.repeat(np.arange(rows), n) * (PARITY // 64) + (slot >> 6), np.uint64(1) << (slot & 63).astype(np.uint64))
    if len(full):
        # rows in runs that stay in cache, however many coordinates are taken
        cuts = [0]
        for i in range(1, len(full) + 1):
            if i == len(full) or first[full[i - 1] + 1] - first[full[cuts[-1]]] > 60_000:
                cuts.append(i)
        for a, b in zip(cuts, cuts[1:]):
            part = full[a:b]
            x = h[first[part[0]]: first[part[-1] + 1]]
            at = first[part] - first[part[0]]
            for c in range(SKETCH):
                mins[c, part] = np.minimum.reduceat(((x * _A[c]) >> np.uint64(32)).astype(np.uint32), at)
            sums[0, part] = np.add.reduceat(x, at)
            sums[1, part] = np.add.reduceat(B.mix(x), at)
    four = B.mix(mins.astype(np.uint64) + (np.arange(SKETCH, dtype=np.uint64) << np.uint64(32))[:, None]) & np.uint64(15)
    four <<= np.uint64(4) * (np.arange(SKETCH, dtype=np.uint64) % np.uint64(16))[:, None]
    sig = [pa.array(_signed(four[16 * j: 16 * j + 16].sum(axis=0, dtype=np.uint64))) for j in range(SKETCH // 16)]
    sig += [pa.array(_signed(np.ascontiguousarray(parity[:, j]))) for j in range(PARITY // 64)]
    sig = pa.StructArray.from_arrays(sig, names=_SIG)
    flat_mins = pa.array(np.ascontiguousarray(mins.T).view(np.int32).ravel())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * SKETCH), flat_mins)
    return pa.RecordBatch.from_arrays(
        [batch.column(0).cast(pa.int64()), batch.column(2), pa.array(n.astype(np.int64)), pa.array(_signed(sums[0])),
         pa.array(_signed(sums[1])), sig, lists],
        names=["doc_id", "key", "n_shingles", "set1", "set2", "sig", "mins"])


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, set size, set fingerprint (order-free sums of shingle hashes), sketch bits and minwise values."""
    def run(batches):
        for b in batches:
            for part in B.slices(b, "text"):
                yield _sketch_rows(part, k)
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64("doc_id", text).alias("key")).mapInArrow(
        run, "doc_id bigint, key bigint, n_shingles bigint, set1 bigint, set2 bigint, sig struct<" + ", ".join(f"{c}: bigint" for c in _SIG) + ">, mins array<int>")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for part in B.slices(b, "text"):
                h, first = B.shingles(B.words(B.flat(part.column(1)), B.SPACED), k)
                h, first = _distinct(h, first)
                sets = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(_signed(h)))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), sets], names=["id", "set"])
    return docs.mapInArrow(run, "id bigint, set array<bigint>")


def _filter_by(df: DataFrame, key: str, keys: DataFrame, bits: int) -> DataFrame:
    """The rows whose key may be among ``keys(id)``: a semi-join with a bitmap of fixed size.

    The bitmap has 2**bits bits in 2**(bits-6) rows, so its broadcast is
    bounded for any input; rows let through by chance are dropped by the
    exact join that follows.
    """
    def slot(c: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(7), F.col(c)), F.lit(1 << bits))
    one = keys.select(slot("id").alias("s")).groupBy(F.shiftright("s", 6).alias("_w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("_bits"))
    d = df.withColumn("_s", slot(key)).withColumn("_w", F.shiftright("_s", 6))
    return (d.join(F.broadcast(one), "_w")
            .where(F.expr("getbit(_bits, cast(_s % 64 as int))") == 1).select(*df.columns))


def _components(pairs: DataFrame, docs: DataFrame, k: int, threshold: int, scratch: Scratch, spent: list[DataFrame] = (), known: list[DataFrame] = ()) -> DataFrame:
    """Components (id, label) of the labels of each pair(a, b, la, lb) whose full sets have 100 |A & B| >= threshold |A | B|.

    ``spent`` are tables that only ``pairs`` still reads, ``known`` labels(id, label) that are links as well. Of a pair met at two
    levels the later labels count, which are the smaller ones.
    """
    pairs = scratch.keep(pairs.groupBy("a", "b").agg(F.min("la").alias("la"), F.min("lb").alias("lb")), "pairs")
    for t in spent:
        scratch.drop(t)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    texts = _filter_by(docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text")),
                       "id", ids, FILTER_BITS)
    sets = scratch.keep(_sets(texts, k).join(ids.distinct(), "id", "left_semi").dropDuplicates(), "sets")
    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    both = one.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    # 100 |A & B| >= threshold |A | B| with |A | B| = |A| + |B| - |A & B|
    common, total = F.size(F.array_intersect("sa", "sb")).cast("bigint"), F.size("sa").cast("bigint") + F.size("sb")
    hit = (F.size("sa") > 0) & (F.size("sb") > 0) & (common * (100 + threshold) >= total * threshold)
    links = both.where(hit).select(F.col("la").alias("a"), F.col("lb").alias("b"))
    out = connected_components(_union([links, *[x.select(F.col("id").alias("a"), F.col("label").alias("b")) for x in known]]), scratch)
    for t in (pairs, sets):
        scratch.drop(t)
    return out


def _alike(a: str, b: str, threshold: int) -> Column:
    """What any pair of that similarity meets (sizes, parity bits), or all but for chance (four-bit values)."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    odd = F.lit(0)
    for j in range(PARITY // 64):
        odd = odd + F.bit_count(F.col(f"{a}.sig.p{j}").bitwiseXOR(F.col(f"{b}.sig.p{j}")))
    off = F.lit(0)
    for j in range(SKETCH // 16):
        d = F.col(f"{a}.sig.s{j}").bitwiseXOR(F.col(f"{b}.sig.s{j}"))
        d = d.bitwiseOR(F.shiftright(d, 1))
        d = d.bitwiseOR(F.shiftright(d, 2))  # the lowest of four bits: any differs (what a sign copies in is masked off)
        off = off + F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))
    # similarity t means at most (x + y) (1 - t) / (1 + t) shingles that only one set has
    return ((F.least(x, y) * 100 >= F.greatest(x, y) * threshold) & (odd * (100 + threshold) <= (x + y) * (100 - threshold))
            & (off <= MAX_OFF))


def _children(node: Column, salt: int, count: int, group: int) -> Column:
    """Array of ``count`` child nodes, each for ``group`` coordinates that the node's hash picks and the values found there."""
    kids = []
    for j in range(count):
        at = [F.pmod(F.xxhash64(F.lit((salt * 64 + j) * 16 + g), node), F.lit(SKETCH)).cast("int") + 1 for g in range(group)]
        kids.append(F.xxhash64(F.lit(salt), F.lit(j), node, *[F.element_at("mins", i) for i in at]))
    return F.array_distinct(F.array(*kids))


def near_duplicates(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """One row a row of ``docs``(doc_id, text): doc_id, key, n_shingles, component_id, kept, class_size.

    Documents with 100 * |A & B| >= threshold * |A | B| on distinct k-word
    shingles are linked; component_id is the smallest doc_id reachable by
    links, kept marks that document, class_size counts rows of the same set, key
    is xxhash64(doc_id, text).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    rows = scratch.keep(sketches(docs, k), "sketches")
    classes = scratch.keep(rows.where("n_shingles > 0 and doc_id is not null").groupBy("set1", "set2").agg(
        F.min_by(F.struct("doc_id", "n_shingles", "sig", "mins"), "doc_id").alias("r"), F.count(F.lit(1)).alias("class_size"))
        .select("set1", "set2", F.col("r.doc_id").alias("rep"), F.col("r.n_shingles").alias("n"), "r.sig", "r.mins", "class_size"), "classes")
    roots = F.concat(*[_children(F.lit(tree), tree, ROOT, 1) for tree in range(TREES)])
    members = classes.select("rep", "n", "sig", F.col("rep").alias("label"), F.explode(roots).alias("node"))
    # a level's labels lead from those of the level before (at first the classes themselves) to theirs: a component
    # found is one vertex from then on
    levels, pairs, spent = [], [], []
    for depth in range(1, DEPTH + 1):
        nodes = members.groupBy("node").agg(
            F.count(F.lit(1)).alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi"),
            F.min(F.struct(F.xxhash64("rep", "node").alias("o"), "rep", "n", "sig", "label")).alias("hub")).where("lo < hi").select("node", "c", "hub")
        mixed = scratch.keep(members.join(nodes, "node"), "mixed")
        scratch.drop(members)
        # every class of a node against the node's hub
        star = mixed.alias("m").where(_alike("m", "hub", threshold) & (F.col("label") != F.col("hub.label"))).select(
            *_ends("m", "hub"))
        levels.append(_components(star, docs, k, threshold, scratch))
        now = _labelled(mixed.select("node", "rep", "n", "sig", "c", "label"), levels[-1])
        # the classes of small nodes not yet connected, exhaustively
        x, y = now.where(F.col("c") <= SMALL).alias("x"), now.where(F.col("c") <= SMALL).alias("y")
        found = x.join(y, (F.col("x.node") == F.col("y.node")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.label") != F.col("y.label"))
                       & _alike("x", "y", threshold)).select(*_ends("x", "y"))
        # those of the last level are written once, with all other pairs
        pairs.append(found if depth == DEPTH else scratch.keep(found.distinct(), "pairs"))
        large = now.where(F.col("c") > SMALL).select("node", "rep", "n", "sig", "c", "label")
        still = large.groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("node", "lo")
        large = scratch.keep(large.join(still, "node"), "large")
        if depth == DEPTH:
            spent = [mixed, large]
        else:
            scratch.drop(mixed)
        if large.isEmpty():
            break
        if depth == DEPTH:
            pairs.append(_rest_pairs(large, threshold))
        else:
            members = scratch.keep(large.join(classes.select("rep", "mins"), "rep").select(
                "rep", "n", "sig", "label", F.explode(_children(F.col("node"), TREES + depth, BRANCH, GROUP)).alias("node")).distinct(), "members")
            scratch.drop(large)
    levels.append(_components(_union(pairs), docs, k, threshold, scratch, spent, levels[1:]))
    reps = classes.select("set1", "set2", "class_size", F.col("rep").alias("label"))
    for level in (levels[0], levels[-1]):
        reps = _labelled(reps, level)
    reps = reps.select("set1", "set2", F.col("label").alias("component_id"), "class_size")
    own = F.col("n_shingles") > 0
    return rows.select("doc_id", "key", "n_shingles", "set1", "set2").join(reps, ["set1", "set2"], "left").select(
        "doc_id", "key", "n_shingles", F.when(own & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce(F.when(own, F.col("doc_id") == F.col("component_id")), F.lit(True)).alias("kept"),
        F.when(own & F.col("doc_id").isNotNull(), F.col("class_size")).otherwise(F.lit(1)).alias("class_size"))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.union(more)
    return out


def _ends(x: str, y: str) -> list[Column]:
    """A pair of classes and their labels, both in order."""
    return [f(f"{x}.{of}", f"{y}.{of}").alias(name) for of, names in (("rep", "ab"), ("label", ("la", "lb"))) for f, name in zip((F.least, F.greatest), names)]


def _labelled(rows: DataFrame, level: DataFrame) -> DataFrame:
    """``rows`` with their label replaced by the one that ``level``(id, label) has for it, if any."""
    to = level.select(F.col("id").alias("label"), F.col("label").alias("_to"))
    return rows.join(to, "label", "left").withColumn("label", F.coalesce("_to", "label")).drop("_to")


def _rest_pairs(large: DataFrame, threshold: int) -> DataFrame:
    """All alike pairs of different label in large nodes, each from the smallest node that both are in.

    One of such a pair does not have the node's most frequent label; those
    are compared with all of the node. Both sides are dealt into parts of
    about REST rows, each part of the one meeting each of the other in a
    group of its own, so that no group grows with the node. (A join of the two
    sides is split at hot nodes into runs of the one times runs of the other:
    thousands of tasks for little work.) A class is in
    TREES * ROOT * BRANCH ** (DEPTH - 1) nodes at most, so its list of nodes
    is bounded.
    """
    of = large.groupBy("node", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("node").agg(
        F.max(F.struct("k", "label")).alias("m"), F.sum("k").alias("total")).select("node", F.col("m.label").alias("most"), (F.col("total") - F.col("m.k")).alias("few"))
    rows = (large.join(of, "node").withColumn("nodes", F.collect_set("node").over(Window.partitionBy("rep"))).withColumn("odd", F.col("label") != F.col("most"))
            .withColumn("parts", F.ceil(F.col("c") / REST).cast("int")).withColumn("odd_parts", F.ceil(F.col("few") / REST).cast("int")))
    dealt = lambda salt, parts: F.pmod(F.xxhash64(F.lit(salt), "rep"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    group = ["node", "part", "odd_part"]
    of_row = [F.col(c).alias(c.removeprefix("sig.")) for c in (*group, "rep", "n", "label", "odd", *[f"sig.{f}" for f in _SIG], "nodes")]
    odd = rows.where("odd").withColumn("part", every("parts")).withColumn("odd_part", dealt(1, "odd_parts")).select(of_row)
    all_rows = rows.withColumn("part", dealt(0, "parts")).withColumn("odd_part", every("odd_parts")).select(of_row)
    return odd.groupBy(group).cogroup(all_rows.groupBy(group)).applyInArrow(lambda x, y: _alike_block(x, y, threshold), "a bigint, b bigint, la bigint, lb bigint")


def _alike_block(x: pa.Table, y: pa.Table, threshold: int) -> pa.Table:
    """The alike pairs (see ``_alike``) of a row of ``x`` and one of ``y`` that have their node as the smallest in common."""
    def numbers(t: pa.Table, name: str, kind=np.int64) -> np.ndarray:
        return t.column(name).to_numpy().view(kind)

    node, found = set(x.column("node").slice(0, 1).to_pylist()), [np.zeros((2, 0), np.int64)]
    n_x, n_y, rep_x, rep_y, label_x, label_y = (numbers(t, c) for c in ("n", "rep", "label") for t in (x, y))
    plain = ~np.asarray(y.column("odd").to_numpy(), bool)
    sig_x, sig_y = ([numbers(t, c, np.uint64) for c in _SIG] for t in (x, y))
    nodes_x, nodes_y = ([set(v) for v in t.column("nodes").to_pylist()] for t in (x, y))
    # so many rows of x at a time that a block has about a million pairs
    step = max(1, (1 << 20) // max(1, len(rep_y)))
    for at in range(0, len(rep_x) if len(rep_y) else 0, step):
        some = slice(at, at + step)
        n, m = n_x[some, None], n_y[None, :]
        hit = (label_x[some, None] != label_y) & (plain | (rep_x[some, None] < rep_y)) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * threshold)
        odd = np.zeros(hit.shape, np.int64)
        for p, q in zip(sig_x[SKETCH // 16:], sig_y[SKETCH // 16:]):
            odd += np.bitwise_count(p[some, None] ^ q)
        hit &= odd * (100 + threshold) <= (n + m) * (100 - threshold)
        i, j = np.nonzero(hit)
        i += at
        off = np.zeros(len(i), np.int64)
        for p, q in zip(sig_x[:SKETCH // 16], sig_y[:SKETCH // 16]):
            d = p[i] ^ q[j]
            d |= d >> np.uint64(1)
            d |= d >> np.uint64(2)
            off += np.bitwise_count(d & np.uint64(0x1111111111111111))
        i, j = i[off <= MAX_OFF], j[off <= MAX_OFF]
        least = np.array([min(nodes_x[u] & nodes_y[v]) in node for u, v in zip(i.tolist(), j.tolist())], bool)
        found.append(np.stack([i[least], j[least]]))
    i, j = np.concatenate(found, axis=1)
    return pa.table({name: f(of_x[i], of_y[j]) for of_x, of_y, names in ((rep_x, rep_y, "ab"), (label_x, label_y, ("la", "lb")))
                     for f, name in zip((np.minimum, np.maximum), names)})

"""Mixing sources to target weights with soft membership, in DataFrame functions only.

A multinomial classifier over hashed words learns from the rows whose domain
is known and gives every document a posterior over the domains. Document
rates r >= 0 are then fitted so that the expected domain totals
sum_d r_d tokens_d p_dk match the targets: projected gradient on the least
squares of the residuals, whitened by M = sum_d tokens_d p_d p_d' / tokens.
In that metric the gradient at a document is p_d' M^-1 residual and its
Lipschitz constant is 1, so steps of length 1 converge, in one step where no
rate meets zero. Each step is one aggregate of K sums over the documents; only K
numbers come to the driver, and the rates stay in a table.

Results for odd input: a null domain is not learnt from but scored; a null
or empty text has the prior as posterior and no tokens (any rate fits; it
keeps the starting rate 1); a target domain without labelled rows cannot be
reached and its residual remains; domains without a target get target 0;
an empty table gives no rows; repeated rows are documents of their own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: hashed words; tokens' worth of evidence at most (words of a text are not independent, and memberships stay soft)
SLOTS, EVIDENCE = 4096, 30.0
MOST_DOMAINS = 64
STEPS, TOLERANCE, STEPS_A_TABLE = 60, 1e-6, 6


def _word_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with one row a word, its slot in _slot (null for a text without words); lower-cased, split at blanks."""
    words = F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+")
    rows = docs.withColumn("_w", F.explode(words)).drop("text")
    return rows.withColumn("_slot", F.when(F.col("_w") != "", F.pmod(F.xxhash64("_w"), F.lit(SLOTS)).cast("int"))).drop("_w")


def word_model(docs: DataFrame, domain: str, domains: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """ln priors (K) and ln P(slot | domain) (K x SLOTS), from all rows of a known domain; K x SLOTS counts come to the driver."""
    known = docs.select(F.col(domain).cast("string").alias("k"), "text").where(F.col("k").isin(domains))
    counts = _word_rows(known).where("_slot is not null").groupBy("k", "_slot").agg(F.count(F.lit(1)).alias("n"))
    table = np.full((len(domains), SLOTS), 0.5)
    at = {k: i for i, k in enumerate(domains)}
    for r in counts.collect():
        table[at[r["k"]], r["_slot"]] += r["n"]
    rows = {r["k"]: r["n"] for r in known.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = np.array([rows.get(k, 0) + 1.0 for k in domains])
    return np.log(prior / prior.sum()), np.log(table / table.sum(axis=1, keepdims=True))


def posteriors(docs: DataFrame, prior: np.ndarray, table: np.ndarray) -> DataFrame:
    """_row, doc_id, _tokens, _p0.._pK-1 of ``docs``(_row, doc_id, text).

    The words' mean log-likelihood by domain, times EVIDENCE words at most,
    softmaxed. The words of a text are summed where they are read; the table
    of SLOTS rows is broadcast, its size being fixed.
    """
    k = len(prior)
    names = [f"_l{i}" for i in range(k)]
    small = docs.sparkSession.createDataFrame([(s, *map(float, table[:, s])) for s in range(SLOTS)], "_slot int, " + ", ".join(f"{n} double" for n in names))
    sums = (_word_rows(docs.select("_row", "doc_id", "text")).join(F.broadcast(small), "_slot", "left").groupBy("_row")
            .agg(F.first("doc_id").alias("doc_id"), F.count("_slot").alias("_tokens"), *[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names]))
    scale = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(F.col("_tokens"), F.lit(1)))
    sums = sums.select("_row", "doc_id", "_tokens", *[(F.col(n) * scale + float(prior[i])).alias(n) for i, n in enumerate(names)])
    top = F.greatest(*names) if k > 1 else F.col(names[0])
    rel = sums.select("_row", "doc_id", "_tokens", *[F.exp(F.col(n) - top).alias(n) for n in names])
    total = F.lit(0.0)
    for n in names:
        total = total + F.col(n)
    return rel.select("_row", "doc_id", "_tokens", *[(F.col(n) / total).alias(f"_p{i}") for i, n in enumerate(names)])


def mixing_rates(docs: DataFrame, domain: str, targets: dict[str, float], budget: float | None = None) -> DataFrame:
    """One row a row of ``docs``: doc_id, _tokens, _rate, _copies, and _p<i>, the posteriors in the sorted order of ``targets``.

    targets: domain -> weight (scaled to sum 1), MOST_DOMAINS at most. budget:
    tokens wanted in all; by default as many as there are. _copies rounds
    _rate up or down by a hash of doc_id, so that sums keep their expectation.
    """
    if not 0 < len(targets) <= MOST_DOMAINS:
        raise ValueError(f"1 to {MOST_DOMAINS} target domains")
    scratch = Scratch(docs.sparkSession, "mixing")
    names = sorted(targets)
    k = len(names)
    p = [f"_p{i}" for i in range(k)]
    prior, table = word_model(docs, domain, names)
    soft = scratch.keep(posteriors(docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id()), prior, table)
                        .select("_row", "doc_id", "_tokens", *p).withColumn("_rate", F.lit(1.0)), "soft")
    tokens = F.col("_tokens").cast("double")
    first = soft.agg(F.sum(tokens), *[F.sum(tokens * F.col(p[i]) * F.col(p[j])) for i in range(k) for j in range(i, k)]).first()
    total = first[0] or 0.0
    if total:
        m = np.zeros((k, k))
        for x, (i, j) in zip(first[1:], [(i, j) for i in range(k) for j in range(i, k)]):
            m[i, j] = m[j, i] = x / total
        inverse = np.linalg.pinv(m, rcond=1e-9, hermitian=True)
        weight = np.array([targets[n] for n in names], float)
        want = weight / weight.sum() * (budget if budget is not None else total)
        rate, since = F.col("_rate"), 0
        for _ in range(STEPS):
            now = np.array(soft.agg(*[F.sum(rate * tokens * F.col(c)) for c in p]).first(), float)
            gap = (now - want) / total
            if np.abs(gap).max() <= TOLERANCE:
                break
            step = inverse @ gap
            move = F.lit(0.0)
            for i in range(k):
                move = move + F.col(p[i]) * F.lit(float(step[i]))
            rate = F.when(F.col("_tokens") > 0, F.greatest(F.lit(0.0), rate - move)).otherwise(F.lit(1.0))
            since += 1
            if since == STEPS_A_TABLE:
                new = scratch.keep(soft.withColumn("_rate", rate), "soft")
                scratch.drop(soft)
                soft, rate, since = new, F.col("_rate"), 0
        soft = soft.withColumn("_rate", rate)
    part = F.pmod(F.xxhash64(F.lit(17), "doc_id", "_row"), F.lit(1 << 30)) / float(1 << 30)
    return soft.withColumn("_copies", (F.floor("_rate") + F.when(part < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)).cast("bigint")).drop("_row")

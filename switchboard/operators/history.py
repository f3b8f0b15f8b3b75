"""Type-2 histories from several timestamped sources.

``merged_history`` takes observations: at some time a source states some
attributes of a key (NULL may be what it states) and says nothing of the
others. The state at a time is the last statement of each attribute up to it;
what holds between two changes of the state is one version. ``interval_history``
takes rows that hold from a time until an expiry, of which a later row of the
same key takes over. Both are lazy plans. The rows of a key are shuffled once and
sorted once, and all steps are windows over that order; a key with a very long
history (``timeline.long_keys``) goes in two levels, as many groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .timeline import LONG, WIDTH, carry_forward, long_keys, split_long, with_next, with_previous


def observations(df: DataFrame, keys: list[str], ts: Column, rank: int, tiebreak: str, stated: dict[str, Column]) -> DataFrame:
    """Rows of a source: ``stated`` gives an attribute's value (a Column: stated by every row; made by ``if_stated``: by some).

    At one time a higher ``rank`` counts more, then a higher ``tiebreak``.
    """
    return df.select(*keys, ts.alias("eff_from_ts"), F.lit(rank).alias("_rank"), F.col(tiebreak).cast("bigint").alias("_tie"),
                     *[c.alias(f"_s_{a}") for a, c in stated.items()])


def stated(value: Column) -> Column:
    return F.struct(value.alias("v"))


def stated_if(condition: Column, value: Column) -> Column:
    return F.when(condition, stated(value))


def _named(v: DataFrame, keys: list[str], attributes: list[str], id_col: str, present: str | None) -> DataFrame:
    """Versions(keys, attributes, eff_from_ts, eff_to_ts) that hold something, with their id and flags."""
    v = v.where(F.col(present)) if present else v
    ident = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], X.epoch_micros("eff_from_ts").cast("string"))
    return v.select(F.sha2(ident, 256).alias(id_col), *keys, *attributes, "eff_from_ts", "eff_to_ts",
                    F.col("eff_to_ts").isNull().alias("is_current"), F.year("eff_from_ts").cast("bigint").alias("eff_from_year"))


def _versions(states: DataFrame, keys: list[str], attributes: list[str], id_col: str, present: str | None, width: int) -> DataFrame:
    """Versions from states(keys, eff_from_ts, attributes): runs of equal states, one row each."""
    held = [*attributes, *([present] if present else [])]
    states = states.withColumn("_sig", F.struct(*held))
    changed = with_previous(states, keys, "eff_from_ts", [], "_sig", "_was", width).where(F.col("_was").isNull() | ~F.col("_was").eqNullSafe(F.col("_sig")))
    v = with_next(changed.select(*keys, "eff_from_ts", *held), keys, "eff_from_ts", [], "eff_from_ts", "eff_to_ts", width)
    return _named(v, keys, attributes, id_col, present)


def _versions_in_order(rows: DataFrame, order, keys: list[str], attributes: list[str], id_col: str, present: str | None) -> DataFrame:
    """``_versions`` of short keys, from rows of which the last of a time in ``order`` has its state: windows over one sort."""
    held = [*attributes, *([present] if present else [])]
    after, sig = F.lead("eff_from_ts").over(order), F.struct(*held)
    states = rows.withColumn("_after", after).where(F.col("_after").isNull() | (F.col("_after") != F.col("eff_from_ts")))
    changed = states.withColumn("_was", F.lag(sig).over(order)).where(F.col("_was").isNull() | ~F.col("_was").eqNullSafe(sig))
    return _named(changed.withColumn("eff_to_ts", after), keys, attributes, id_col, present)


def _order(keys: list[str], *cols: str):
    return Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in cols])


def merged_history(sources: list[DataFrame], keys: list[str], attributes: list[str], id_col: str, width: int = WIDTH, limit: int = LONG) -> DataFrame:
    """Versions of the keys over all ``sources`` (made by ``observations``): id, keys, attributes, eff_from_ts, eff_to_ts,
    is_current, eff_from_year. Statements at one time are one state; rows without key or time are left out."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    u = u.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, "eff_from_ts"]]))
    short, long = split_long(u, keys, long_keys(u, keys, limit))
    return _merged_short(short, keys, attributes, id_col).unionByName(_merged_long(long, keys, attributes, id_col, width))


def _merged_short(u: DataFrame, keys: list[str], attributes: list[str], id_col: str) -> DataFrame:
    order = _order(keys, "eff_from_ts", "_rank", "_tie", *[f"_s_{a}" for a in attributes])
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    known = u.withColumns({f"_k_{a}": F.last(f"_s_{a}", ignorenulls=True).over(so_far) for a in attributes})
    return _versions_in_order(known.withColumns({a: F.col(f"_k_{a}.v") for a in attributes}), order, keys, attributes, id_col, None)


def _merged_long(u: DataFrame, keys: list[str], attributes: list[str], id_col: str, width: int) -> DataFrame:
    at = F.struct("_rank", "_tie")
    once = u.groupBy(*keys, "eff_from_ts").agg(*[F.max_by(f"_s_{a}", F.when(F.col(f"_s_{a}").isNotNull(), at)).alias(f"_s_{a}") for a in attributes])
    known = carry_forward(once, keys, "eff_from_ts", [], {f"_s_{a}": f"_k_{a}" for a in attributes}, width)
    states = known.select(*keys, "eff_from_ts", *[F.col(f"_k_{a}.v").alias(a) for a in attributes])
    return _versions(states, keys, attributes, id_col, None, width)


def interval_history(rows: DataFrame, keys: list[str], row_id: str, start: str, end: str, attributes: list[str], id_col: str,
                     width: int = WIDTH, limit: int = LONG, counted: DataFrame | None = None) -> DataFrame:
    """Versions from rows that hold in [start, end) (``end`` NULL: open): of overlapping rows of a key the later start holds
    (ties: the higher ``row_id``), its expiry ends it, and an expiry of a row that another has taken over ends nothing.
    Rows that end before they begin, or have no key or start, are left out. Keys are counted in ``counted`` when given:
    a table that has at least the rows of each key and is cheaper to read."""
    sound = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, row_id, start]]) & (F.col(end).isNull() | (F.col(end) > F.col(start)))
    rows = rows.where(sound)
    short, long = split_long(rows, keys, long_keys(rows if counted is None else counted, keys, limit))
    return _intervals_short(short, keys, row_id, start, end, attributes, id_col).unionByName(
        _intervals_long(long, keys, row_id, start, end, attributes, id_col, width))


def _intervals_short(rows: DataFrame, keys: list[str], row_id: str, start: str, end: str, attributes: list[str], id_col: str) -> DataFrame:
    """A row begins at its start and, as a row without attributes, ends at its end; at one time ends come first."""
    here = F.col("_here")
    u = rows.withColumn("_here", F.explode(F.when(F.col(end).isNull(), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))))
    u = u.select(*keys, F.when(here, F.col(start)).otherwise(F.col(end)).alias("eff_from_ts"), "_here", F.col(row_id).alias("_id"),
                 *[F.when(here, F.col(a)).alias(a) for a in attributes])
    order = _order(keys, "eff_from_ts", "_here", "_id", *attributes)
    holder = F.last(F.when(here, F.col("_id")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # an end counts when its row is the one that holds
    u = u.withColumn("_holder", holder).where(here | (F.col("_holder") == F.col("_id"))).drop("_holder")
    return _versions_in_order(u, order, keys, attributes, id_col, "_here")


def _intervals_long(rows: DataFrame, keys: list[str], row_id: str, start: str, end: str, attributes: list[str], id_col: str, width: int) -> DataFrame:
    opens = rows.groupBy(*keys, F.col(start).alias("_t")).agg(F.max(F.struct(F.col(row_id).alias("id"), *attributes)).alias("_set")).withColumn("_kind", F.lit(1))
    closes = rows.where(F.col(end).isNotNull()).select(*keys, F.col(end).alias("_t"), F.col(row_id).alias("_own"), F.lit(0).alias("_kind"))
    u = carry_forward(opens.unionByName(closes, allowMissingColumns=True), keys, "_t", ["_kind", "_own"], {"_set": "_cur"}, width)
    ends = F.col("_cur.id") == F.col("_own")
    # one state a time: a row that opens, else the end of the one that holds
    at = u.where((F.col("_kind") == 1) | ends).groupBy(*keys, F.col("_t").alias("eff_from_ts")).agg(F.max("_kind").alias("_kind"), F.max("_set").alias("_set"))
    states = at.select(*keys, "eff_from_ts", (F.col("_kind") == 1).alias("_here"), *[F.col(f"_set.{a}").alias(a) for a in attributes])
    return _versions(states, keys, attributes, id_col, "_here", width)


# ---- the three histories of the warehouse ----------------------------------------

AGENT = ["employee_no", "org_unit_id", "job_grade", "employment_type", "status"]
#: what an employment event says of the status (fixed here; other events say nothing of it)
EVENT_STATUS = {"HIRE": "ACTIVE", "REHIRE": "ACTIVE", "TERMINATION": "TERM", "LEAVE": "LEAVE"}
MOVES = ("HIRE", "REHIRE", "TRANSFER")


def agent_history(stg_hr_agent: DataFrame, stg_hr_employment_event: DataFrame) -> DataFrame:
    """``ods_agent_scd2``: the master's snapshots state all attributes from their load date on; employment events state the
    status and, where they move an agent, the org unit. At one instant an event counts more than a snapshot."""
    master = observations(stg_hr_agent, ["agent_id"], F.col("load_date").cast("timestamp_ntz"), 0, "hire_ts", {a: stated(F.col(a)) for a in AGENT})
    kind = F.col("event_type")
    status = F.coalesce(*[F.when(kind == e, s) for e, s in EVENT_STATUS.items()])
    events = observations(stg_hr_employment_event, ["agent_id"], X.seconds_to_ts("event_ts"), 1, "event_id", {
        "status": stated_if(kind.isin(*EVENT_STATUS), status),
        "org_unit_id": stated_if(kind.isin(*MOVES) & F.col("to_org_unit_id").isNotNull(), F.col("to_org_unit_id"))})
    return merged_history([master, events], ["agent_id"], AGENT, "agent_history_id")


def agent_skill_history(stg_hr_agent_skill: DataFrame, stg_hr_skill: DataFrame) -> DataFrame:
    """``ods_agent_skill_scd2``: an agent's certified skills with their code, from effective to expiry; the last load of a row counts."""
    cols = ["agent_id", "skill_id", "proficiency", "certified", "effective_ts", "expiry_ts"]
    rows = stg_hr_agent_skill.groupBy("agent_skill_id").agg(F.max(F.struct("load_date", *cols)).alias("v")).select("agent_skill_id", "v.*")
    rows = rows.withColumns({"_from": X.seconds_to_ts("effective_ts"), "_to": X.seconds_to_ts("expiry_ts")})
    h = interval_history(rows, ["agent_id", "skill_id"], "agent_skill_id", "_from", "_to", ["proficiency", "certified"], "agent_skill_history_id",
                         counted=stg_hr_agent_skill)
    codes = stg_hr_skill.groupBy(F.col("skill_id").alias("_sid")).agg(F.max_by("skill_code", "load_date").alias("skill_code"))
    return h.join(codes, F.col("skill_id") == F.col("_sid"), "left")


def agent_assignment_history(assignments: DataFrame) -> DataFrame:
    """``ods_agent_assignment_scd2`` from assignments(assignment_id, agent_id, program_id, queue_id, role_on_program, start_ts,
    end_ts): per agent and program, as the source of this table is not stated."""
    return interval_history(assignments, ["agent_id", "program_id"], "assignment_id", "start_ts", "end_ts",
                            ["queue_id", "role_on_program"], "assignment_history_id")

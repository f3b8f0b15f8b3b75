"""Cross-layer joins (X1-X3) and filtered-vs-full scans.

The reference's queryability spec runs three joins with LIMIT 0 and
compares bytes scanned by COUNT(*) with and without a partition / cluster
predicate. Here the joins run over whole tables and each scan pair returns
both counts in one row; the physical side (partition filters, pushed
filters, row-group skipping) is exercised by the table jobs and their tests
(``operators/tables.py``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tables import scratch_path
from ..operators.zonemap import read_zoned, write_zoned


def xjoin_staging(stg_fin_invoice: DataFrame, stg_fin_invoice_line: DataFrame) -> DataFrame:
    """Invoice header x line on invoice_id."""
    s = stg_fin_invoice.select("invoice_id", "issued_ts_sec")
    ln = stg_fin_invoice_line.select(F.col("invoice_id").alias("_l_inv"), "line_amount")
    return s.join(ln, s.invoice_id == ln._l_inv).select("invoice_id", "issued_ts_sec", "line_amount")


def xjoin_ods(ods_interaction: DataFrame, ods_call: DataFrame) -> DataFrame:
    """Interaction x call on a computed key, CAST(call_id AS STRING) = SUBSTR(interaction_id, 2).

    Both sides compute their key in a projection, so the join is a plain
    equi (hash / sort-merge) join, never a nested loop.
    """
    i = ods_interaction.select("interaction_id", F.substring("interaction_id", 2, 1 << 30).alias("_k"))
    c = ods_call.select("call_id", F.col("call_id").cast("string").alias("_k"))
    return i.join(c, "_k").select("interaction_id", "call_id")


def xjoin_dm(fact_interaction: DataFrame, dim_agent: DataFrame, dim_program: DataFrame) -> DataFrame:
    """Star join of the interaction fact to two dimensions."""
    f = fact_interaction.select("interaction_id", "agent_sk", "program_sk")
    a = dim_agent.select("agent_sk", "full_name")
    p = dim_program.select("program_sk", "program_name")
    return f.join(a, "agent_sk").join(p, "program_sk").select("interaction_id", "full_name", "program_name")


# --- fixed values of the scan-comparison spec (must equal the reference): column -> (lowest, highest) ---
SCAN_CONDITIONS = {
    "fact_interaction": {"date_key": (20240101, 20240201), "channel": ("VOICE", "VOICE")},
    "fact_agent_activity": {"agent_sk": (1, 1)},
    "fact_queue_interval": {"queue_sk": (1, 1)},
    "fact_billing_line": {"client_sk": (1, 1), "program_sk": (1, 1)},
    "fact_csat_survey": {"program_sk": (1, 1)},
    "agg_agent_daily": {"agent_sk": (1, 1)},
    "agg_billing_monthly": {"client_sk": (1, 1), "program_sk": (1, 1)},
    "stg_tel_call": {"load_date": (dt.date(2026, 6, 2), dt.date(2026, 6, 2))},
}

#: files that a scanned table is written in, at least
LEAST_FILES = 8


def scan_count(table: str):
    """COUNT(*) of the table and, in a scan of its own, COUNT(*) under the predicate.

    The table is written clustered by the predicate's columns as the layout declares, with a zone map. The filtered
    scan opens only the files whose zones meet the predicate: ``pruned`` says that it opened fewer than the full one,
    by the file names that the rows of each scan come from.
    """
    def run(df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path = scratch_path(spark, f"scan-{table}")
        conditions = SCAN_CONDITIONS[table]
        clusters = list(reversed(conditions))  # channel before date_key, as fact_interaction is clustered
        write_zoned(df, path, clusters, num_partitions=max(LEAST_FILES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        found = read_zoned(spark, path, conditions)
        file = F.col("_metadata.file_path")
        full = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("full_count"), F.count_distinct(file).alias("_all"))
        part = found.rows.agg(F.count(F.lit(1)).alias("filtered_count"), F.count_distinct(file).alias("_some"))
        # one row each
        return full.crossJoin(F.broadcast(part)).select("full_count", "filtered_count", (F.col("_some") < F.col("_all")).alias("pruned"))
    run.__name__ = f"scan_count_{table}"
    return run

"""Change feeds with tombstones (T6): merge on read, append per increment, compaction below a watermark.

A change is (keys, payload, op I/U/D, change time in ms, extract date). What
counts of a key is its latest change: by change time, then extract date, then
I < U < D, then payload (so that the outcome never hangs on row order). A key
whose latest change is a delete keeps that change as a tombstone: an update
that is older than the delete but lands in a later increment does not bring the
row back. ``merge`` is the step over tables, ``ChangeLog`` the stored form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X

OP_RANK = {"I": 0, "U": 1, "D": 2}          # at equal change time a delete wins
META = ["op", "change_ms", "extract_ts"]


def _order(payload: list[str]) -> Column:
    rank = F.when(F.col("op") == "D", OP_RANK["D"]).when(F.col("op") == "U", OP_RANK["U"]).otherwise(OP_RANK["I"])
    return F.struct("change_ms", "extract_ts", rank.alias("rank"), *payload)


def latest(changes: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """The latest change of each key, deletes included: a max-by aggregate, of which a task hands on one row a key."""
    held = changes.groupBy(*keys).agg(F.max_by(F.struct(*payload, *META), _order(payload)).alias("_v"))
    return held.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in [*payload, *META]])


def merge(state: DataFrame | None, changes: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """The state (latest change a key, tombstones kept) after ``changes``; ``state`` None is empty."""
    new = changes.select(*keys, *payload, *META)
    return latest(new if state is None else state.select(*new.columns).unionByName(new), keys, payload)


def current(state: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """The rows that are there now, with ``last_change_ts``."""
    return state.where(F.col("op") != "D").select(*keys, *payload, X.millis_to_ts("change_ms").alias("last_change_ts"))


class ChangeLog:
    """A stored change log under ``path``, in the shared folder.

    ``append`` writes an increment's latest changes as a folder of their own
    and touches nothing else, so its cost is the increment's; appending the same
    number again replaces it (a replayed micro-batch counts once). ``state``
    merges on read. ``compact`` writes one base of all increments so far and
    drops the tombstones older than the watermark; from then on changes older
    than the watermark are not taken any more, as nothing would tell that their
    row was deleted. A folder counts once Spark has marked it complete, so a
    run that was ended early leaves the log as it was.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], payload: list[str]):
        self.spark, self.path, self.keys, self.payload = spark, path.rstrip("/"), keys, payload

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _complete(self, kind: str) -> dict[tuple[int, ...], str]:
        """The finished folders of a kind: numbers in the name -> path (as many as increments since the base)."""
        fs, root = self._fs(self.path)
        found = {}
        for s in fs.listStatus(root) if fs.exists(root) else []:
            name = s.getPath().getName()
            if name.startswith(kind + "-") and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
                found[tuple(int(x) for x in name[len(kind) + 1:].split("-"))] = f"{self.path}/{name}"
        return found

    def append(self, changes: DataFrame, number: int) -> None:
        """Add an increment; numbers ascend."""
        rows = latest(changes.select(*self.keys, *self.payload, *META), self.keys, self.payload)
        rows.write.mode("overwrite").parquet(f"{self.path}/increment-{number:012d}")

    def _parts(self) -> tuple[list[str], int, int]:
        """(folders to read, the base's last increment, the watermark); the base first."""
        bases = self._complete("base")
        done, mark = max(bases, default=(-1, 0))
        later = {n: p for n, p in self._complete("increment").items() if n[0] > done}
        return [*([bases[(done, mark)]] if bases else []), *[later[n] for n in sorted(later)]], done, mark

    def state(self) -> DataFrame | None:
        """The latest change of each key, tombstones included; None before the first increment."""
        folders, done, mark = self._parts()
        if not folders:
            return None
        if done < 0:
            return latest(self.spark.read.parquet(*folders), self.keys, self.payload)
        rows = self.spark.read.parquet(folders[0])
        if len(folders) > 1:
            rows = rows.unionByName(self.spark.read.parquet(*folders[1:]).where(F.col("change_ms") >= mark))
        return latest(rows, self.keys, self.payload)

    def current(self) -> DataFrame | None:
        state = self.state()
        return None if state is None else current(state, self.keys, self.payload)

    def compact(self, watermark_ms: int) -> None:
        """One base of all increments; tombstones older than the watermark (never lowered) go."""
        folders, done, mark = self._parts()
        if not folders:
            return
        mark = max(mark, watermark_ms)
        last = max([done, *[n[0] for n in self._complete("increment")]])
        kept = self.state().where((F.col("op") != "D") | (F.col("change_ms") >= mark))
        base = f"{self.path}/base-{last:012d}-{mark:015d}"
        if base in folders:
            return
        kept.write.mode("overwrite").parquet(base)
        for f in folders:  # replaced by the base, which is complete by now
            fs, p = self._fs(f)
            fs.delete(p, True)

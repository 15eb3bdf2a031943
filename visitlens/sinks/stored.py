"""Stored tables that are changed by key: ``KeyedTable`` (K2-K7 as merges that
rewrite only the partitions they touch) and ``BatchTable`` (what a stream's
micro-batches add: a short log over a keyed table of running totals).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.sinks.tables import append_new, merge_add, merge_overwrite, replace_groups

#: partitions of a table (of a day, if it has a day column): as many as keep one
#: of them, with all its keys, well below what a task reads
BUCKETS = 4
#: batches that a stream adds before its log is merged into the totals
MERGE_EVERY = 20

MARK = "_mark"
Parts = list[tuple]


class KeyedTable:
    """Rows with distinct ``keys``, partitioned by ``day_col`` (if any) and a
    hash of ``bucket_by`` (the keys unless given).

    A merge finds the partitions that its delta falls into, reads those, and
    replaces them by dynamic partition overwrite; the others are not opened. Two
    merges must not run at once. A merge with a ``number`` is applied once to
    each partition: rows carry the number of the last one, so a merge that was
    interrupted can be run again, sums included.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], day_col: str | None = None,
                 bucket_by: list[str] | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys
        self.day_col, self.bucket_by, self.buckets = day_col, bucket_by or [k for k in keys if k != day_col] or keys, buckets
        self.part_cols = [*([day_col] if day_col else []), "bucket"]
        days = [f for f in schema if f.name == day_col]
        self._stored = T.StructType([*(f for f in schema if f.name != day_col), T.StructField(MARK, T.LongType()),
                                     *days, T.StructField("bucket", T.IntegerType())])
        # an empty table can be read
        self._write(spark.createDataFrame([], self._stored), "ignore")

    def _write(self, rows: DataFrame, mode: str) -> None:
        (rows.select(*self._stored.names).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.part_cols).parquet(self.path))

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their bucket."""
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int"))

    def parts_of(self, rows: DataFrame) -> Parts:
        """The partitions that ``rows`` fall into: at most days x buckets values."""
        return [tuple(r) for r in self.placed(rows).select(*self.part_cols).distinct().collect()]

    def _in(self, parts: Parts) -> Column:
        """Partition filter: one term a day."""
        days: dict = {}
        for *day, bucket in parts:
            days.setdefault(tuple(day), []).append(bucket)
        terms = [reduce(lambda a, b: a & b, [F.col(self.day_col).eqNullSafe(d) for d in day], F.col("bucket").isin(found))
                 for day, found in days.items()]
        return reduce(lambda a, b: a | b, terms, F.lit(False))

    def stored(self, parts: Parts | None = None) -> DataFrame:
        """Rows with mark and bucket, of some partitions or of all."""
        rows = self.spark.read.schema(self._stored).parquet(self.path)
        return rows if parts is None else rows.where(self._in(parts))

    def read(self, parts: Parts | None = None) -> DataFrame:
        return self.stored(parts).select(*self.schema.names)

    def merge(self, delta: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], number: int | None = None,
              first: bool = False) -> None:
        """Replace the partitions of ``delta`` by ``combine(their rows, delta)``;
        with a ``number`` only those whose last merge has a lower one (``first``:
        all, as no merge of that number has begun before)."""
        delta = self.placed(delta.select(*self.schema.names)).persist()
        try:
            parts = self.parts_of(delta)
            if number is not None and parts and not first:
                done = self.stored(parts).where(F.col(MARK) >= number).select(*self.part_cols).distinct().collect()
                parts = [p for p in parts if p not in {tuple(r) for r in done}]
            if not parts:
                return
            mark = F.lit(number).cast("long")
            old = self.read(parts)
            new = combine(old, delta.where(self._in(parts)).select(*self.schema.names))
            self._write(self.placed(new).withColumn(MARK, mark).repartition(*self.part_cols), "overwrite")
        finally:
            delta.unpersist()

    def upsert(self, delta: DataFrame) -> None:
        """K3, K4, K7: rows of ``delta`` replace those of equal keys."""
        self.merge(delta, lambda old, new: merge_overwrite(old, new, self.keys))

    def add(self, delta: DataFrame, value: str, number: int | None = None, first: bool = False) -> None:
        """K2: ``value`` is added to that of equal keys."""
        self.merge(delta, lambda old, new: merge_add(old, new, self.keys, value), number, first)

    def insert_new(self, delta: DataFrame) -> None:
        """K6: only rows whose keys are not there."""
        self.merge(delta, lambda old, new: append_new(old, new, self.keys))

    def replace(self, delta: DataFrame, groups: list[str]) -> None:
        """K5: every group of ``delta`` is replaced. Groups must not be cut by
        the partitioning: day and bucket columns are among ``groups``."""
        cut = {*self.bucket_by, *([self.day_col] if self.day_col else [])} - set(groups)
        if cut:
            raise ValueError(f"groups {groups} are cut by {sorted(cut)}")
        self.merge(delta, lambda old, new: replace_groups(old, new, groups))


class BatchTable:
    """What micro-batches add, exact under replay and bounded in files.

    A batch writes its rows to ``log/gen=<g>/run=<id>/batch=<n>``; a replay of the
    batch that is under way replaces them. Every ``merge_every`` batches
    ``merge_log`` adds the log's earlier batches to ``held``, a ``KeyedTable``,
    and opens a new generation of the log, so that a reader lists ``held`` and at
    most ``merge_every`` + 1 batches. The state names the open generation and, per
    run, the last batch that ``held`` has: a batch up to there that comes again is
    passed over. A merge that was interrupted is finished by the next; meanwhile
    readers leave out the log rows of partitions that already hold them.

    With ``keys`` and ``value`` the table is the sum of ``value`` by ``keys``,
    else the distinct rows. One stream writes at a time.
    """

    STATE = "version long, gen long, merging long, marks string"

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str] | None = None, value: str | None = None,
                 day_col: str | None = None, bucket_by: list[str] | None = None, buckets: int = BUCKETS, merge_every: int = MERGE_EVERY):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.value, self.day_col, self.merge_every = keys, value, day_col, merge_every
        self.held = KeyedTable(spark, f"{self.path}/held", schema, keys or schema.names, day_col, bucket_by, buckets)
        self._save({"version": 0, "gen": 0, "merging": None, "marks": {}}, "ignore")
        self._open(0)

    # --- state: the newer one of two small files that are written in turn -----

    def _save(self, state: dict, mode: str = "overwrite") -> None:
        row = (state["version"], state["gen"], state["merging"], json.dumps(state["marks"]))
        (self.spark.createDataFrame([row], self.STATE).coalesce(1).write.mode(mode)
         .json(f"{self.path}/state/slot={state['version'] % 2}"))
        self._state = state if mode == "overwrite" else None

    def state(self, fresh: bool = True) -> dict:
        """``fresh`` False: as this object last saw it (the writer's own)."""
        if fresh or self._state is None:
            rows = self.spark.read.schema(self.STATE).option("ignoreMissingFiles", "true").json(f"{self.path}/state").collect()
            last = max(rows, key=lambda r: r["version"])
            self._state = {**{k: last[k] for k in ("version", "gen", "merging")}, "marks": json.loads(last["marks"])}
        return self._state

    def _open(self, gen: int) -> None:
        self._write(self.spark.createDataFrame([], self.schema), "ignore", f"{self.path}/log/gen={gen}/run=none/batch=-1")

    def _write(self, rows: DataFrame, mode: str, path: str) -> None:
        out = rows.select(*self.schema.names).write.mode(mode)
        if self.day_col:
            out = out.partitionBy(self.day_col)
        out.parquet(path)

    # --- writing ----------------------------------------------------------------

    def batch_path(self, run: str, batch: int) -> str:
        return f"{self.path}/log/gen={self.state(False)['gen']}/run={run}/batch={batch}"

    def has(self, run: str, batch: int) -> bool:
        """Whether the totals have this batch, so that it cannot come again."""
        return batch <= self.state(False)["marks"].get(run, -1)

    def append(self, df: DataFrame, run: str, batch: int) -> None:
        """The rows of one batch; a replay replaces them, and adds nothing once
        the totals have the batch."""
        if not self.has(run, batch):
            self._write(df, "overwrite", self.batch_path(run, batch))

    def merge_log(self, run: str, batch: int, always: bool = False) -> bool:
        """Before ``batch`` of ``run`` writes: add the batches before it to the
        totals, if ``merge_every`` of them are in the log (or ``always``).
        Batches before the one under way are committed, so they cannot come
        again with other rows. Returns whether it merged."""
        state = dict(self.state(False))
        first = state["merging"] is None
        if first:
            if not always and batch - 1 - state["marks"].get(run, -1) < self.merge_every:
                return False
            log = self._log(state["gen"]).where((F.col("run") != run) | (F.col("batch") < batch))
            last = {r["run"]: r["last"] for r in log.groupBy("run").agg(F.max("batch").alias("last")).collect()}  # a row a checkpoint
            marks = {**state["marks"], **last, **({run: batch - 1} if batch > 0 else {})}
            state |= {"version": state["version"] + 1, "gen": state["gen"] + 1, "merging": state["gen"], "marks": marks}
            self._open(state["gen"])
            self._save(state)
        old = state["merging"]
        delta = self.merged(self._log(old).where(self._counted(state["marks"])))
        if self.value is None:
            self.held.merge(delta, lambda held, new: held.unionByName(new).distinct(), old, first)
        else:
            self.held.add(delta, self.value, old, first)
        self._save({**state, "version": state["version"] + 1, "merging": None})
        if old > 0:  # readers that began before this merge may still use the last generation
            _delete(self.spark, f"{self.path}/log/gen={old - 1}")
        return True

    # --- reading ----------------------------------------------------------------

    def _log(self, gen: int) -> DataFrame:
        fields = [f for f in self.schema if f.name != self.day_col]
        days = [f for f in self.schema if f.name == self.day_col]
        schema = T.StructType([*fields, T.StructField("run", T.StringType()), T.StructField("batch", T.LongType()), *days])
        return self.spark.read.schema(schema).parquet(f"{self.path}/log/gen={gen}")

    @staticmethod
    def _counted(marks: dict) -> Column:
        return reduce(lambda a, b: a | b, [(F.col("run") == r) & (F.col("batch") <= n) for r, n in marks.items()], F.lit(False))

    def rows(self, run: str | None = None, before: int | None = None, parts: Parts | None = None) -> DataFrame:
        """All rows, those of the log with run and batch (totals: null). With
        ``run`` and ``before`` without that run's batches from ``before`` on, as
        that batch saw the table. ``parts``: of the totals only these partitions
        (the log's rows are not cut)."""
        state = self.state()
        if run is not None and before <= state["marks"].get(run, -1):
            raise ValueError(f"the totals of {self.path} have batch {before} of {run} already")
        log, held = self._log(state["gen"]), self.held.stored()
        if state["merging"] is not None:  # interrupted: some partitions hold that generation, some do not yet
            done = held.where(F.col(MARK) >= state["merging"]).select(*self.held.part_cols).distinct()
            waiting = self.held.placed(self._log(state["merging"]).where(self._counted(state["marks"])))
            same = reduce(lambda a, b: a & b, [waiting[c].eqNullSafe(done[c]) for c in self.held.part_cols])
            log = log.unionByName(waiting.join(done, same, "left_anti").drop("bucket"))
        if run is not None:
            log = log.where((F.col("run") != run) | (F.col("batch") < before))
        totals = held if parts is None else held.where(self.held._in(parts))
        totals = totals.select(*self.schema.names).withColumn("run", F.lit(None).cast("string")).withColumn("batch", F.lit(None).cast("long"))
        return totals.unionByName(log)

    def merged(self, rows: DataFrame) -> DataFrame:
        if self.value is None:
            return rows.select(*self.schema.names).distinct()
        kind = self.schema[self.value].dataType
        return rows.groupBy(*self.keys).agg(F.sum(self.value).cast(kind).alias(self.value)).select(*self.schema.names)

    def read(self, run: str | None = None, before: int | None = None, parts: Parts | None = None) -> DataFrame:
        return self.merged(self.rows(run, before, parts))

    def compacted(self, path: str) -> "BatchTable":
        """A copy at ``path`` whose totals have everything, and say which batches
        that is: a stream that goes on with the copy adds none of them twice."""
        out = BatchTable(self.spark, path, self.schema, self.keys, self.value, self.day_col, self.held.bucket_by, self.held.buckets, self.merge_every)
        log = self._log(self.state()["gen"]).groupBy("run").agg(F.max("batch").alias("last")).collect()  # a row a checkpoint
        out.held.merge(self.read(), lambda old, new: new, 0)
        out._save({**out.state(), "version": 1, "gen": 1, "marks": {**self.state()["marks"], **{r["run"]: r["last"] for r in log}}})
        out._open(1)
        return out


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

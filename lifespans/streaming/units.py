"""Units of work: a ledger of their states, admission within caps, order per source, failures that stop only themselves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from ..operators.rollup import drop_consecutive_duplicates
from ..sources.parts import KeyedTable, Parts

UNIT = "unit_key string, source string, position bigint, start_at timestamp_ntz, end_at timestamp_ntz, bytes bigint, arrived bigint"
_OPEN = UNIT + ", state string, tries int, reason string, tried_in bigint"
_DONE = UNIT + ", tries int, turn bigint"
_NEXT = "source string, next bigint"
_FAILED = "unit_key string, reason string"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def admit(units: DataFrame, order: list[Column], max_units: int, max_bytes: int) -> DataFrame:
    """The first units in ``order`` that are at most ``max_units`` and together at most ``max_bytes``; one at least.

    Each task keeps its first ``max_units`` rows, so the running sum is over that many rows whatever waits behind them.
    """
    head = units.orderBy(*order).limit(max_units)
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = head.select("*", F.sum("bytes").over(w).alias("_sum"), F.count("*").over(w).alias("_row"))
    return running.where((F.col("_sum") <= max_bytes) | (F.col("_row") == 1)).drop("_sum", "_row")


def in_turn(units: DataFrame, nexts: DataFrame, block: int = 1024) -> DataFrame:
    """The units of every source that follow its last done one without a gap; those behind a gap wait.

    ``nexts`` (source, next) is each source's first position that is not done; a source that is missing starts at 0.  Gaps
    are looked for by counting positions per ``block`` of a source, then within the first block that is not full, so no
    window holds a source's whole backlog.
    """
    since = F.col("position") - F.coalesce("next", F.lit(0))
    placed = units.join(nexts, "source", "left").withColumn("_at", since).where("_at >= 0").drop("next")
    placed = placed.withColumn("_block", F.floor(F.col("_at") / block))
    counts = placed.groupBy("source", "_block").agg(F.count_distinct("_at").alias("_n"))
    w = Window.partitionBy("source").orderBy("_block")  # a row a block
    row = F.row_number().over(w)
    broken = F.when((F.col("_n") < block) | (row != F.col("_block") + 1), row - 1)  # whole blocks before it
    full = counts.withColumn("_broken", broken).groupBy("source").agg(F.coalesce(F.min("_broken"), F.count("*")).alias("_full"))
    near = placed.join(full, "source").where(F.col("_block") <= F.col("_full"))
    inside = Window.partitionBy("source", "_block").orderBy("_at")
    follows = F.dense_rank().over(inside) == F.col("_at") - F.col("_block") * block + 1
    return near.withColumn("_ok", (F.col("_block") < F.col("_full")) | follows).where("_ok").select(*units.columns)


@dataclass
class Ledger:
    """States of units below ``root``: open ones (waiting, failed, deferred) by batch, done ones by a hash of the key.

    A turn takes open and newly arrived units, admits some, has them tried, and publishes the ledger after it.  Turns are
    numbered by stream batch and by turn within one, so a batch that runs again publishes the same turns again.  A unit
    that is known already, open or done, changes nothing when it arrives again.
    """

    parts: Parts
    check: Callable[[DataFrame], DataFrame]
    commit: Callable[[DataFrame, int], None]
    max_units: int = 1000
    max_bytes: int = 8 << 20
    ordered: bool = False
    done_parts: int = 64

    @property
    def spark(self) -> SparkSession:
        return self.parts.spark

    def _hash(self, c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.done_parts)).cast("string")

    def _last(self) -> int | None:
        known = self.parts.generations()
        return known[-1] if known else None

    def open_units(self) -> DataFrame:
        """Units that are not done: with state, tries and the reason of the last failure."""
        return self.parts.read("open", _OPEN, self._last())

    def done_units(self) -> DataFrame:
        """Units that are done, with how often they were tried and the turn in which they succeeded."""
        return self.parts.read("done", _DONE, self._last())

    def turn(self, arrived: DataFrame, generation: int) -> int:
        """One turn over what is open and ``arrived`` (a table that can be read again); how many units it tried.

        ``check`` gets the admitted units and returns (unit_key, reason) of those that fail; ``commit`` gets the others
        and the turn's number, and may be called again for the same turn.  A unit that fails stays open for a later turn
        and stops no other one; in an ordered ledger it stops the later units of its source, which are deferred.
        """
        last = self.parts.before(generation)
        open_ = self.parts.read("open", _OPEN, last)
        keys = [r[0] for r in arrived.select(self._hash("unit_key")).distinct().collect()]  # at most done_parts
        known = self.parts.read("done", _DONE, last, keys).select("unit_key").union(open_.select("unit_key"))
        fresh = arrived.dropDuplicates(["unit_key"]).join(known, "unit_key", "left_anti").select(
            *_names(UNIT), F.lit("waiting").alias("state"), F.lit(0).alias("tries"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("bigint").alias("tried_in"))
        backlog = self._stored(open_.unionByName(fresh), _OPEN, f"backlog/gen={generation:012d}")
        ready, order = backlog, [F.asc_nulls_first("tried_in"), F.col("arrived"), F.col("unit_key")]
        if self.ordered:
            sources = [r[0] for r in backlog.select(self._hash("source")).distinct().collect()]
            ready, order = in_turn(backlog, self.parts.read("next", _NEXT, last, sources)), [F.col("position"), F.col("arrived"), F.col("unit_key")]
        taken = self._stored(admit(ready, order, self.max_units, self.max_bytes), _OPEN, f"taken/gen={generation:012d}")
        failed = self.check(taken).groupBy("unit_key").agg(F.min("reason").alias("_why"))
        found = taken.join(failed, "unit_key", "left").withColumn("_ok", F.col("_why").isNull())
        if self.ordered:
            first = found.where("not _ok").groupBy("source").agg(F.min("position").alias("_stop"))
            late = F.col("_stop").isNotNull() & (F.col("position") > F.col("_stop"))
            found = found.join(first, "source", "left").withColumn("_why", F.when(late, "an_earlier_unit_failed").otherwise(F.col("_why"))).withColumn("_late", late).drop("_stop")
        else:
            found = found.withColumn("_late", F.lit(False))
        found = self._stored(found.select(*_names(_OPEN), "_why", "_late"), _OPEN + ", _why string, _late boolean", f"found/gen={generation:012d}")
        good = found.where("_why is null").select(*_names(UNIT), (F.col("tries") + 1).alias("tries"), F.lit(generation).cast("long").alias("turn"))
        self.commit(good, generation)
        left = backlog.join(taken.select("unit_key"), "unit_key", "left_anti").unionByName(found.where("_why is not null").select(
            *_names(UNIT), F.when(F.col("_late"), "deferred").otherwise("failed").alias("state"), (F.col("tries") + F.when(F.col("_late"), 0).otherwise(1)).cast("int").alias("tries"),
            F.col("_why").alias("reason"), F.lit(generation).cast("long").alias("tried_in")))
        self.parts.write("open", left, F.lit("all"), generation)
        touched = [r[0] for r in good.select(self._hash("unit_key")).distinct().collect()]
        self.parts.write("done", self.parts.read("done", _DONE, last, touched).unionByName(good), self._hash("unit_key"), generation)
        moved = {"open": ["all"], "done": touched}
        if self.ordered:
            sources = [r[0] for r in good.select(self._hash("source")).distinct().collect()]
            after = self.parts.read("next", _NEXT, last, sources).unionByName(good.groupBy("source").agg((F.max("position") + 1).alias("next")))
            self.parts.write("next", after.groupBy("source").agg(F.max("next").alias("next")), self._hash("source"), generation)
            moved["next"] = sources
        self.parts.publish(generation, moved)
        return taken.count()

    def _stored(self, df: DataFrame, schema: str, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.parts.root}/work/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.parts.root}/work/{name}")

    def work_off(self) -> int:
        """Turns without new units until every open one has been tried in one of them, or none may be; how many turns.

        So each open unit is tried once at most, however many there are, and units that always fail end this as well.
        """
        began, k = self._last() or 0, 0
        while True:
            untried = self.open_units().where(F.col("tried_in").isNull() | (F.col("tried_in") <= began))
            if untried.isEmpty() or not self.turn(self.spark.createDataFrame([], UNIT), began + k + 1):
                return k
            k += 1


TURNS = 1_000_000  # turns between two stream batches


def run_units(stream: DataFrame, ledger: Ledger, checkpoint: str) -> StreamingQuery:
    """Units (UNIT without arrived) as they land, one turn a micro-batch; the checkpoint is the acknowledgement.

    What a turn doesn't admit stays in the ledger for the next batch or for ``Ledger.work_off``.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        landed = f"{ledger.parts.root}/work/landed/batch={batch_id}"
        batch.withColumn("arrived", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(landed)
        ledger.turn(batch.sparkSession.read.schema(UNIT).parquet(landed), (batch_id + 1) * TURNS)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def acquisition(table: KeyedTable, subject: str, snapshots: DataFrame, rows: DataFrame) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame, int], None]]:
    """``check`` and ``commit`` of a ledger whose units re-acquire ranges of a stored table.

    ``snapshots`` (unit_key, complete) tells what was acquired, ``rows`` (unit_key, reject_reason, the table's columns)
    holds it.  A unit fails if it has no snapshot, an incomplete one, a rejected row or a row that isn't its own; its
    range stays as it was.  The ranges of the others are replaced in one new generation of the table.
    """

    def own(units: DataFrame) -> DataFrame:
        return units.select("unit_key", "source", "start_at", "end_at").join(rows, "unit_key")

    def check(units: DataFrame) -> DataFrame:
        seen = units.select("unit_key").join(snapshots, "unit_key", "left")
        whole = seen.where("not coalesce(complete, false)").select("unit_key", F.when(F.col("complete").isNull(), "not_acquired").otherwise("range_incomplete").alias("reason"))
        inside = (F.col(table.at) >= F.col("start_at")) & (F.col(table.at) < F.col("end_at")) & (F.col(subject).cast("string") == F.col("source"))
        reason = F.coalesce("reject_reason", F.when(~F.coalesce(inside, F.lit(False)), "outside_range"))
        return whole.unionByName(own(units).select("unit_key", reason.alias("reason")).where("reason is not null"))

    def commit(units: DataFrame, generation: int) -> None:
        kind = own(units).schema[subject].dataType
        ranges = units.select(F.col("source").cast(kind).alias(subject), "start_at", "end_at")
        table.reconcile(own(units).select(*_names(table.schema)), ranges, generation)

    return check, commit


def changes_in_order(parts: Parts, rows: DataFrame, order: list[str], columns: list[str], schema: str) -> Callable[[DataFrame, int], None]:
    """``commit`` of an ordered ledger whose units hold observations: each turn adds those that differ from the one before.

    ``rows`` has unit_key and the columns of ``schema``; ``order`` tells the order within a source.  The last
    observation of a source is kept by a hash of the source, so a turn reads and writes the parts of its sources only.
    """
    by_source = F.pmod(F.xxhash64("source"), F.lit(64)).cast("string")

    def commit(units: DataFrame, generation: int) -> None:
        last = parts.before(generation)
        own = rows.join(units.select("unit_key", "source"), "unit_key").select("source", *_names(schema))
        sources = [r[0] for r in units.select(by_source).distinct().collect()]  # at most 64
        kept = parts.read("last", f"source string, {schema}", last, sources)
        both = kept.withColumn("_known", F.lit(True)).unionByName(own.withColumn("_known", F.lit(False)))
        new = drop_consecutive_duplicates(both, ["source"], order, columns).where("not _known").drop("_known")
        parts.write("changes", new, F.lit(str(generation)), generation)
        top = Window.partitionBy("source").orderBy(*[F.desc(c) for c in order])
        parts.write("last", both.drop("_known").withColumn("_n", F.row_number().over(top)).where("_n = 1").drop("_n"), by_source, generation)
        parts.publish(generation, {"changes": [str(generation)], "last": sources})

    return commit

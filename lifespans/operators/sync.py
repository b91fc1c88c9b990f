"""Table maintenance as DataFrames: every operator returns the table after the change, or what the change is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.values import any_distinct


def side_by_side(current: DataFrame, incoming: DataFrame, key: str, in_range: Column) -> DataFrame:
    """Full outer join of both sides as structs l and r, with the action on each key."""
    left = current.select(F.col(key).alias("_key"), F.struct(*current.columns).alias("l"), F.coalesce(in_range, F.lit(False)).alias("_in"))
    right = incoming.select(F.col(key).alias("_rkey"), F.struct(*incoming.columns).alias("r"))
    both = left.join(right, F.col("_key") == F.col("_rkey"), "full_outer")
    differs = any_distinct([F.col(f"l.{c}") for c in incoming.columns], [F.col(f"r.{c}") for c in incoming.columns])
    action = (
        F.when(F.col("r").isNull(), F.when(F.col("_in"), "delete").otherwise("keep"))
        .when(F.col("l").isNull(), "insert").when(differs, "update").otherwise("unchanged")
    )
    return both.select("l", "r", action.alias("action"))


def after_side_by_side(both: DataFrame, current: DataFrame, incoming: DataFrame) -> DataFrame:
    """The table after the actions of ``side_by_side``."""
    given = set(incoming.columns)
    new = F.col("action").isin("insert", "update")
    columns = [
        (F.when(new, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")) if c in given else F.col(f"l.{c}")).alias(c) for c in current.columns
    ]
    return both.where("action <> 'delete'").select(*columns)


def reconcile_range(current: DataFrame, incoming: DataFrame, key: str, in_range: Column) -> tuple[DataFrame, DataFrame]:
    """Replace a completely re-acquired range: (table after, changes).  ``sources.parts`` does it on stored days only.

    ``in_range`` is a predicate on ``current``.  Rows in range that are not incoming go; new keys and rows of which an
    incoming column differs are written; identical rows are left alone; a key may come in from outside the range.  Only
    the incoming columns are compared, so the same acquisition twice changes nothing.  Changes: key, action.
    """
    both = side_by_side(current, incoming, key, in_range)
    changes = both.where("action in ('insert', 'update', 'delete')").select(F.coalesce(f"r.{key}", f"l.{key}").alias(key), "action")
    return after_side_by_side(both, current, incoming), changes


def reconcile_children(
    parents: DataFrame, incoming_parents: DataFrame, in_range: Column, children: DataFrame, incoming_children: DataFrame, parent_key: str, child_key: str
) -> tuple[DataFrame, DataFrame]:
    """Children of every parent that is incoming or was in range are replaced by the incoming children."""
    scope = incoming_parents.select(parent_key).union(parents.where(in_range).select(parent_key)).distinct().withColumn("_scope", F.lit(True))
    marked = children.join(scope, parent_key, "left").select(*children.columns, F.coalesce("_scope", F.lit(False)).alias("_scope"))
    both = side_by_side(marked, incoming_children, child_key, F.col("_scope"))
    changes = both.where("action in ('insert', 'update', 'delete')").select(F.coalesce(f"r.{child_key}", f"l.{child_key}").alias(child_key), "action")
    return after_side_by_side(both, children, incoming_children), changes


def upsert_distinct(current: DataFrame, incoming: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Insert new keys and overwrite rows that differ; nothing is deleted.  (table after, changes)"""
    return reconcile_range(current, incoming, key, F.lit(False))


def patch_columns(current: DataFrame, incoming: DataFrame, key: str, fields: list[str], metrics: list[str], in_range: Column) -> DataFrame:
    """Overwrite one group of columns over a range of keys.

    Within the range, days that are not incoming lose the group's values; days outside it that are incoming get them;
    a row whose ``metrics`` are all null afterwards goes.
    """
    left = current.select(*current.columns, F.coalesce(in_range, F.lit(False)).alias("_in"))
    right = incoming.select(F.col(key), F.struct(*fields).alias("_new"))
    both = left.join(right, key, "full_outer")

    def value(c: str) -> Column:
        if c not in fields:
            return F.col(c)
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).when(F.col("_in"), None).otherwise(F.col(c)).alias(c)

    return both.select(*[value(c) for c in current.columns]).where(F.coalesce(*[F.col(c).cast("string") for c in metrics]).isNotNull())


def invalidate(current: DataFrame, keys: DataFrame, adopted: DataFrame, key: str = "event_key") -> tuple[DataFrame, DataFrame]:
    """Set is_valid to false for listed keys that were not adopted again; (table after, the rows it changed)."""
    gone = keys.select(key).distinct().join(adopted.select(key), key, "left_anti").withColumn("_gone", F.lit(True))
    marked = current.join(gone, key, "left").withColumn("_hit", F.coalesce("_gone", F.lit(False)) & F.col("is_valid"))
    columns = [F.when(F.col("_hit"), False).otherwise(F.col("is_valid")).alias("is_valid") if c == "is_valid" else F.col(c) for c in current.columns]
    return marked.select(*columns), marked.where("_hit").select(key)


def invalidation_candidates(refs: DataFrame, before: DataFrame, after: DataFrame, adopted: DataFrame, segment: str = "segment_key", key: str = "event_key") -> DataFrame:
    """Keys that a re-parse disproves: referenced by that segment alone, same content, another parser, not adopted again."""
    old = before.select(segment, F.col("content_sha256").alias("_h0"), F.col("parser_version").alias("_p0"))
    new = after.select(segment, F.col("content_sha256").alias("_h1"), F.col("parser_version").alias("_p1"))
    reparsed = old.join(new, segment).where("_h0 = _h1 and _p0 <> _p1").select(segment)
    sole = refs.groupBy(key).agg(F.min(segment).alias(segment), F.max(segment).alias("_last")).where(F.col(segment) == F.col("_last")).drop("_last")
    return sole.join(reparsed, segment, "left_semi").join(adopted.select(key), key, "left_anti").select(segment, key)


def replace_references(refs: DataFrame, segments: DataFrame, incoming: DataFrame, segment: str = "segment_key") -> DataFrame:
    """The references with those of ``segments`` replaced by ``incoming``."""
    return refs.join(segments.select(segment).distinct(), segment, "left_anti").select(*refs.columns).unionByName(incoming.select(*refs.columns)).distinct()


def adoptable() -> Column:
    """Records that count as events: written, checksum not failed, and complete."""
    complete = F.col("event_key").isNotNull() & F.col("bundle_id").isNotNull() & F.col("event_at").isNotNull() & F.col("in_foreground").isNotNull()
    return (F.col("record_state") == "WRITTEN") & F.coalesce(F.col("crc_passed"), F.lit(True)) & (F.col("record_kind") == "event") & complete


def latest_slots(records: DataFrame, slot: list[str], version: str) -> DataFrame:
    """The row of the highest version in every slot, and whether two rows claim it."""
    w = Window.partitionBy(*slot).orderBy(F.desc(version))
    top = records.withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")
    claims = Window.partitionBy(*slot)
    return top.withColumn("duplicate_slot", F.count("*").over(claims) > 1)


def adopt_records(records: DataFrame, slot: tuple[str, ...] = ("segment_key", "record_offset"), version: str = "record_metadata_offset") -> DataFrame:
    """Events to adopt: per slot the latest record decides, then each event once; a deleted slot hides only itself."""
    latest = latest_slots(records, list(slot), version).where("not duplicate_slot").where(adoptable())
    order = F.struct(*[F.col(c) for c in slot])
    w = Window.partitionBy("event_key").orderBy(order.desc())
    chosen = latest.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    return chosen.select("event_key", "device_key", "bundle_id", "event_at", F.when(F.col("in_foreground"), "start").otherwise("end").alias("state"))


def load_points(current: DataFrame, incoming: DataFrame, key: str, reprocess: bool = False) -> DataFrame:
    """The table after a load: existing keys win, unless ``reprocess`` overwrites what differs."""
    if reprocess:
        return upsert_distinct(current, incoming, key)[0]
    fresh = incoming.join(current.select(key), key, "left_anti").select(*current.columns)
    return current.unionByName(fresh)


def touched_buckets(changes: DataFrame, current: DataFrame, after: DataFrame, key: str, bucket: Column) -> DataFrame:
    """Buckets of a partitioned table that a change touches: old and new place of every changed key."""
    places = current.select(key, bucket.alias("bucket")).unionByName(after.select(key, bucket.alias("bucket")))
    return places.join(changes.select(key), key, "left_semi").select("bucket").distinct()

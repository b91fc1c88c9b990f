"""Temperature mixing of sources: shares to a power, bisected to a target, realised as budgeted block permutations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import Scratch

WORD = r"[^\x09-\x0d\x20]+"
SENT, SALTS = 100_000, 64  # sources whose plan goes to every task; parts of a source beyond that
FINE = 4096  # hash ranges a source is cut into


def token_count(text: Column) -> Column:
    """Words of a text, at least 1, so that every document costs budget."""
    return F.greatest(F.lit(1), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """A hash of id and text as 15 hex digits: the seed of a document's place in every block."""
    return F.substring(F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))).cast("binary")), 1, 15)


def place(seed: Column, block: Column) -> Column:
    """A document's place in a block's permutation, a number below 2**60."""
    hashed = F.md5(F.concat_ws(":", seed, block.cast("string")).cast("binary"))
    return F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """A key that tells a null source from an empty one."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


@dataclass(frozen=True)
class Target:
    """What the exponent is bisected for: at most ``repeats`` passes over any source, or an ``entropy`` in nats."""

    repeats: float | None = None
    entropy: float | None = None

    def met(self, row) -> bool:
        return row["repeats"] <= self.repeats if self.repeats is not None else row["entropy"] <= self.entropy


def exponent(sources: DataFrame, target: Target, cells: int = 16, rounds: int = 6) -> float:
    """The least exponent in [0, 1] (flattest mix) that meets the target, to six places.

    Each round evaluates a grid over the bracket in one aggregation over ``sources`` (key, tokens) and keeps one cell,
    so only ``cells`` numbers reach the driver however many sources there are.  Repeats and entropy both fall as the
    exponent rises; if even exponent 1 misses the target, 1 is returned.
    """
    if (target.repeats is None) == (target.entropy is None):
        raise ValueError("give repeats or entropy")
    scale = sources.agg(F.max("tokens").alias("most")).first()["most"]
    if not scale:
        return 1.0
    lo, hi = 0.0, 1.0
    for _ in range(rounds):
        grid = [lo + (hi - lo) * i / cells for i in range(cells + 1)]
        ratio = F.ln(F.col("tokens") / F.lit(float(scale)))
        rows = (
            sources.select(ratio.alias("l"), F.explode(F.array(*map(F.lit, grid))).alias("a"))
            .groupBy("a")
            .agg(
                F.sum(F.exp(F.col("a") * F.col("l"))).alias("z"),
                F.sum(F.exp(F.col("a") * F.col("l")) * F.col("a") * F.col("l")).alias("zl"),
                F.max(F.exp((F.col("a") - 1) * F.col("l"))).alias("repeats"),
            )
            .select("a", F.round("repeats", 9).alias("repeats"), F.round(F.ln("z") - F.col("zl") / F.col("z"), 9).alias("entropy"))
            .collect()
        )
        met = {r["a"]: target.met(r) for r in rows}
        if met[grid[0]]:
            return math.ceil(round(grid[0] * 1e6, 3)) / 1e6
        if not met[grid[-1]]:
            return 1.0
        k = next(i for i, a in enumerate(grid) if met[a])
        lo, hi = grid[k - 1], grid[k]
    return min(1.0, math.ceil(round(hi * 1e6, 3)) / 1e6)


def plan_mix(weighed: DataFrame, target: Target, scratch: Scratch, budget: int | None = None) -> DataFrame:
    """Per source key: tokens, weight, epochs, blocks (whole passes) and cut, the last place taken in the next pass.

    ``weighed`` has key, seed, tokens.  Without ``budget`` the mix is as large as it takes for no source to fall below
    one whole pass.  The cut comes from sums over hash ranges of a source, which combine before the shuffle, and then
    from the rows of the one range that it falls into: no source, however large, is sorted as a whole.
    """
    sums = scratch.table(weighed.groupBy("key").agg(F.sum("tokens").alias("tokens")), "sources")
    alpha = exponent(sums, target)
    top = sums.agg(F.max("tokens").alias("most"), F.sum("tokens").alias("all")).first()
    most = float(top["most"] or 1)
    power = F.pow(F.col("tokens") / F.lit(most), F.lit(alpha))
    z = sums.agg(F.sum(power)).first()[0] or 1.0
    whole = float(budget) if budget is not None else most * z
    aim = sums.select("key", "tokens", (power / F.lit(z)).alias("weight"), F.floor(power / F.lit(z) * F.lit(whole) + 0.5).cast("long").alias("aim"))
    aim = aim.withColumn("blocks", F.floor(F.col("aim") / F.col("tokens")).cast("int"))
    aim = scratch.table(aim.withColumn("rest", F.col("aim") - F.col("blocks") * F.col("tokens")), "aims")

    placed = weighed.join(aim.where("rest > 0").select("key", "blocks", "rest"), "key").select(
        "key", "tokens", "rest", place(F.col("seed"), F.col("blocks")).alias("place")
    )
    placed = placed.withColumn("range", F.floor(F.col("place") / F.lit((1 << 60) // FINE)).cast("int"))
    ranges = placed.groupBy("key", "rest", "range").agg(F.sum("tokens").alias("t"))
    before = F.sum("t").over(Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("t")
    ranges = ranges.withColumn("before", before)
    split = ranges.where("before < rest and before + t > rest").select("key", "range", "before")
    split = scratch.table(split, "split")
    whole_ranges = ranges.where("before + t <= rest").groupBy("key").agg(F.max("range").alias("range"))
    inside = placed.join(split, ["key", "range"])
    running = F.sum("tokens").over(Window.partitionBy("key").orderBy("place").rangeBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("running", F.col("before") + running).where("running <= rest")
    cuts = whole_ranges.select("key", ((F.col("range") + 1) * F.lit((1 << 60) // FINE) - 1).alias("cut")).unionByName(
        inside.select("key", F.col("place").alias("cut"))
    ).groupBy("key").agg(F.max("cut").alias("cut"))
    epochs = (F.col("aim") / F.col("tokens")).alias("epochs")
    return scratch.table(
        aim.join(cuts, "key", "left").select("key", "tokens", "weight", epochs, "blocks", F.coalesce("cut", F.lit(-1)).cast("long").alias("cut")),
        "plan",
    )


def realise(rows: DataFrame, plan: DataFrame, key: Column, seed: Column) -> DataFrame:
    """``rows`` once for every block it is taken in, with _block and _position (0 to 1: order of the whole mix).

    The plan has one row a source and is sent to all tasks up to ``SENT`` sources; with more of them rows are shuffled by
    source and one of ``SALTS`` numbers, so that no task gets a large source whole.
    """
    chosen = plan.select(F.col("key").alias("_key"), F.col("blocks").alias("_blocks"), F.col("cut").alias("_cut"), F.col("epochs").alias("_epochs"))
    seeded = rows.withColumn("_seed", seed)
    if plan.count() <= SENT:
        joined = seeded.join(F.broadcast(chosen), key == F.col("_key"))
    else:
        chosen = chosen.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = seeded.withColumn("_own", F.pmod(F.xxhash64("_seed"), F.lit(SALTS)).cast("int"))
        joined = salted.join(chosen, (key == F.col("_key")) & (F.col("_own") == F.col("_salt"))).drop("_own", "_salt")
    each = joined.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks")))).withColumn("_place", place(F.col("_seed"), F.col("_block")))
    taken = each.where((F.col("_block") < F.col("_blocks")) | (F.col("_place") <= F.col("_cut")))
    position = (F.col("_block") + F.col("_place") / F.lit(float(1 << 60))) / F.col("_epochs")
    return taken.withColumn("_position", F.round(position, 12)).drop("_seed", "_key", "_blocks", "_cut", "_epochs", "_place")


def _weighed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    narrow = docs.select(
        "doc_id", "source", source_key(F.col("source")).alias("key"),
        document_hash(F.col("doc_id"), F.col("text")).alias("seed"), token_count(F.col("text")).alias("tokens"),
    )
    return scratch.table(narrow, "weighed")


def mixture(docs: DataFrame, target: Target, budget: int | None = None) -> DataFrame:
    """The realised mixture: doc_id, source, n_tokens, block, position, weight and epochs of each document taken.

    Block b of a source is a permutation of its documents by a hash; whole blocks take every document once, the last
    one takes its permutation's longest prefix within the budget.  Sorting by position interleaves the sources by
    weight.  A null source is a source of its own, an empty or null text counts as one token, repeated rows are taken
    or left together, an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    narrow = _weighed(docs, scratch)
    plan = plan_mix(narrow, target, scratch, budget)
    rows = realise(narrow, plan, F.col("key"), F.col("seed")).join(plan.select("key", "weight", "epochs"), "key")
    return rows.select(
        "doc_id", "source", F.col("tokens").alias("n_tokens"), F.col("_block").alias("block"), F.col("_position").alias("position"),
        F.round("weight", 9).alias("weight"), F.round("epochs", 9).alias("epochs"),
    )


def mixed_documents(docs: DataFrame, target: Target, budget: int | None = None) -> DataFrame:
    """The mixture as rows of ``docs``, all its columns: a document taken in k blocks appears k times.

    The plan comes from a narrow table and each document decides by itself; texts are shuffled only beyond ``SENT`` sources.
    ``docs`` needs the columns doc_id, text and source, once each; others may have any names.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    plan = plan_mix(_weighed(docs, scratch), target, scratch, budget)
    packed = docs.select(
        F.struct("*").alias("row"), source_key(F.col("source")).alias("key"), document_hash(F.col("doc_id"), F.col("text")).alias("seed")
    )
    return realise(packed, plan, F.col("key"), F.col("seed")).select("row.*")

"""Mixing sources to target weights by a splitting tree of block quotas. DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermaquilt.llm.common import stage_table

#: Blocks that each source's permuted order is cut into, and the finer blocks inside the one that the quota cuts.
BLOCKS, FINER = 4096, 4096
#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: Sources of one splitting tree.
GROUP = 1024
#: A plan with a row for each source is broadcast up to so many rows; beyond, the join is by source and salt.
BROADCAST_ROWS, SALTS = 50_000, 64
_HEX = 13
_SPAN = 16**_HEX


def unit(seed: int, epoch: Column | int, key: Column) -> Column:
    """A whole number below 16**13, the same on every run: a row's place in its source's permuted order."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(epoch).cast("string") if isinstance(epoch, int) else epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _HEX), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, total_share: float, most_passes: float, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size, target, weight) of each source: shares by weight, none above most_passes times its size.

    What a full source cannot take is shared by weight among the others until
    none is above. In order of size by weight the full sources come first, so
    running sums find the level at which the rest stand.
    `sizes` has one row per source: source, source_size.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("rank"))
    everything = Window.partitionBy()
    t = (
        sizes.withColumn("rank", rank)
        .withColumn("weight", w)
        .withColumn("cap", F.col("source_size") * F.lit(float(most_passes)))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(total_share)))
        .withColumn("before_cap", F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("rest_weight", F.sum("weight").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.coalesce("before_cap", F.lit(0.0))) / F.col("rest_weight"))
        .withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
        .withColumn("final_level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(everything))
    )
    target = F.coalesce(F.least(F.col("cap"), F.col("final_level.level") * F.col("weight")), F.col("cap"))
    return t.select("source", "source_size", target.alias("target"), "weight")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which stands in the expression once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, exact to about 1e-10 from 0 on (shifted up by 8)."""

    def of(m: Column) -> Column:
        x = m + 9.0
        series = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
        for i in range(1, 9):
            series = series - F.log(m + float(i))
        return series

    return _let(n.cast("double"), of)


def split_quota(good: Column, total: Column, drawn: Column, u: Column) -> Column:
    """A hypergeometric number by inversion, at chance u: how many of `good` are among `drawn` of `total`."""
    share = good / F.greatest(total, F.lit(1))
    low, high = F.greatest(F.lit(0).cast("long"), drawn + good - total), F.least(good, drawn)
    reach = F.ceil(9 * F.sqrt(F.greatest(F.lit(0.25), drawn * share * (1 - share)))) + 4
    begin = F.greatest(low, F.floor(drawn * share - reach).cast("long"))
    end = F.least(high, F.ceil(drawn * share + reach).cast("long"))
    pick = lambda n, r: _log_factorial(n) - _log_factorial(r) - _log_factorial(n - r)
    ratio = lambda a, k: (a["good"] - k) * (a["drawn"] - k) / ((k + 1.0) * (a["total"] - a["good"] - a["drawn"] + k + 1))
    fixed = lambda a: [a[c].alias(c) for c in ("good", "total", "drawn", "u")]

    def search(w: Column) -> Column:
        at_begin = F.exp(pick(good, w["begin"]) + pick(total - good, drawn - w["begin"]) - pick(total, drawn))
        start = F.struct(good.alias("good"), total.alias("total"), drawn.alias("drawn"), u.alias("u"), at_begin.alias("p"), F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("k"))
        last = F.greatest(w["begin"], w["end"])
        found = F.aggregate(
            F.sequence(w["begin"], last),
            start,
            lambda a, k: F.struct(*fixed(a), F.when(k < F.least(a["good"], a["drawn"]), a["p"] * ratio(a, k)).otherwise(0.0).alias("p"), (a["sum"] + a["p"]).alias("sum"), F.coalesce(a["k"], F.when(a["sum"] + a["p"] >= a["u"], k)).alias("k")),
        )
        return F.coalesce(found["k"], last)

    return F.when(high <= low, low).otherwise(_let(F.struct(begin.alias("begin"), end.alias("end")), search)).cast("long")


def splitting_tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(rank, ends): each source's block quota dealt exactly to 2**levels shards.

    `quotas` has a row per source: rank, quota (blocks it sends). At a node half
    of its blocks go left; the sources' parts of that half are drawn one after
    the other, each hypergeometric given those before. A shard's blocks of a
    source are the run up to its entry of `ends`, in permuted order. Sources are
    dealt in groups of GROUP by rank, each group by a tree of its own, so a
    node's list is bounded.
    """
    nodes = quotas.groupBy(F.floor(F.col("rank") / GROUP).alias("set"), F.lit(0).alias("shard")).agg(F.sort_array(F.collect_list(F.struct("rank", "quota"))).alias("parts"))
    for level in range(levels):
        total = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["quota"])
        drawn = F.floor((total + F.pmod(F.col("shard"), F.lit(2))) / 2).cast("long")
        odds = F.transform("parts", lambda p, level=level: F.struct(p["rank"].alias("rank"), p["quota"].alias("quota"), ((unit(seed + 1, level, F.concat_ws("/", p["rank"], F.col("shard"))).cast("double") + 0.5) / float(_SPAN)).alias("u")))
        walked = F.aggregate(
            odds,
            F.struct(total.alias("total"), drawn.alias("drawn"), F.expr("cast(array() as array<long>)").alias("left")),
            lambda a, p: F.element_at(
                F.transform(F.array(split_quota(p["quota"], a["total"], a["drawn"], p["u"])), lambda k: F.struct((a["total"] - p["quota"]).alias("total"), (a["drawn"] - k).alias("drawn"), F.concat(a["left"], F.array(k)).alias("left"))), 1
            ),
        )
        cut = nodes.select("set", "shard", "parts", walked["left"].alias("left"))
        side = lambda take: F.zip_with("parts", "left", lambda p, k: F.struct(p["rank"].alias("rank"), take(p["quota"], k).alias("quota")))
        children = F.array(F.struct((F.col("shard") * 2).alias("shard"), side(lambda q, k: k).alias("parts")), F.struct((F.col("shard") * 2 + 1).alias("shard"), side(lambda q, k: q - k).alias("parts")))
        nodes = cut.select("set", F.explode(children).alias("c")).select("set", "c.shard", "c.parts")
    dealt = nodes.select("shard", F.explode("parts").alias("p")).select("p.rank", F.struct("shard", "p.quota").alias("q"))
    counts = dealt.groupBy("rank").agg(F.sort_array(F.collect_list("q")).alias("q"))
    ends = F.aggregate("q", F.struct(F.lit(0).cast("long").alias("sum"), F.expr("cast(array() as array<long>)").alias("ends")), lambda a, q: F.struct((a["sum"] + q["quota"]).alias("sum"), F.concat(a["ends"], F.array(a["sum"] + q["quota"])).alias("ends")))
    return counts.select("rank", ends["ends"].alias("ends"))


def join_plan(rows: DataFrame, plan: DataFrame, source: str, spread: Column) -> DataFrame:
    """rows with the columns of plan's row for their source: broadcast up to BROADCAST_ROWS plan rows, else by source and salt."""
    if plan.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(plan), rows[source].eqNullSafe(plan["mix_source"]), "left")
    salted = plan.withColumn("mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("mix_row_salt", F.pmod(spread, F.lit(SALTS)))
    return rows.join(salted, rows[source].eqNullSafe(salted["mix_source"]) & (rows["mix_row_salt"] == salted["mix_salt"]), "left").drop("mix_row_salt", "mix_salt")


def draw_mix(docs: DataFrame, *, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, total_share: float = 1.5, most_passes: float = 2.0, shard_levels: int = 4, seed: int = 20240501) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_draws.

    mix_draws is an array of (epoch, shard, place), one entry for each time the
    mix takes the row: shards hold disjoint runs of permuted blocks, and `place`
    orders a shard's rows in its local shuffle. Whole epochs take every row; the
    partial one takes blocks in permuted order until the target is met, a finer
    order inside the block that the target cuts, and whole rows inside the last
    finer block, to the count nearest the target. So a source's taken words miss
    its target by at most half of a row.

    Every source has at most BLOCKS block sums an epoch, whatever its rows: a
    source with a third of all rows is summed before the shuffle as any other.
    Only rows of the one finer block that a target cuts are put in order.

    The splitting tree decides what is drawn: a source's blocks are its quota,
    dealt exactly to the shards, and a shard takes the rows of its run of blocks.

    Null sources are a source of their own, last in order. Rows with the same id
    share their place and go together. Null and empty texts have size 0 and go
    with their block. No rows give no rows. Extra columns are kept; columns
    named mix_* are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    epochs = max(1, math.ceil(most_passes))
    step, finer_step = _SPAN // BLOCKS, _SPAN // BLOCKS // FINER
    places = F.array(*[unit(seed, e, F.col(id_col)) for e in range(epochs)])
    slim = stage_table(docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), places.alias("places")), "mix-rows")

    by_block = slim.select("source", "size", F.posexplode("places").alias("epoch", "place")).groupBy("source", "epoch", F.floor(F.col("place") / step).alias("block")).agg(F.sum("size").alias("words"))
    sums = stage_table(by_block, "mix-blocks")
    sizes = sums.where("epoch = 0").groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = source_targets(sizes, total_share=total_share, most_passes=most_passes, weights=weights)
    goal = goal.withColumn("full", F.when(F.col("source_size") > 0, F.least(F.lit(epochs), F.floor(F.col("target") / F.col("source_size") + 1e-12))).otherwise(0).cast("int"))
    goal = goal.withColumn("left", F.when(F.col("full") < epochs, F.col("target") - F.col("full") * F.col("source_size")).otherwise(0.0))

    def cut(parts: DataFrame, goal: DataFrame, unit_col: str, name: str) -> DataFrame:
        """goal with the first unit at which the running words reach what is left (null: none), less the words before it."""
        run = parts.withColumn("sum", F.sum("words").over(Window.partitionBy("source").orderBy(unit_col)))
        j = goal.select(F.col("source").alias("s"), F.col("left").alias("l"))
        first = run.join(j, run["source"].eqNullSafe(j["s"])).where((F.col("l") > 0) & (F.col("sum") >= F.col("l") - 0.5)).groupBy("s").agg(F.min(F.struct(unit_col, (F.col("sum") - F.col("words")).alias("before"))).alias("c"))
        return goal.join(first, goal["source"].eqNullSafe(first["s"]), "left").withColumn(name, F.col("c")[unit_col]).withColumn("left", F.col("left") - F.coalesce(F.col("c.before"), F.lit(0))).drop("s", "c")

    at = sums.join(goal.select(F.col("source").alias("g"), "full"), sums["source"].eqNullSafe(F.col("g")) & (sums["epoch"] == F.col("full")))
    goal = stage_table(cut(at.select("source", "block", "words"), goal, "block", "block_cut"), "mix-cut")
    plan = goal.select(F.col("source").alias("mix_source"), "full", "block_cut")
    inside = join_plan(slim.where(F.size("places") > 0), plan, "source", F.element_at("places", 1)).withColumn("place", F.element_at("places", F.col("full") + 1)).where(F.floor(F.col("place") / step) == F.col("block_cut")).select("source", "size", "place", F.floor(F.pmod("place", F.lit(step)) / finer_step).alias("finer"))
    inside = stage_table(inside, "mix-inside")
    goal = stage_table(cut(inside.groupBy("source", "finer").agg(F.sum("size").alias("words")), goal, "finer", "finer_cut"), "mix-finer")
    g = goal.where("finer_cut is not null").select(F.col("source").alias("g"), "finer_cut", "left")
    last = inside.join(g, inside["source"].eqNullSafe(g["g"]) & (inside["finer"] == g["finer_cut"]))
    ordered = last.withColumn("sum", F.sum("size").over(Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    best = ordered.groupBy(F.col("source").alias("b")).agg(F.min(F.struct(F.abs(F.col("sum") - F.col("left")).alias("miss"), F.col("place").alias("place"))).alias("best"), F.first("left").alias("none"))
    best = best.select("b", F.when(F.col("none") <= F.col("best.miss"), F.lit(None)).otherwise(F.col("best.place")).alias("best"))
    goal = goal.join(best, goal["source"].eqNullSafe(best["b"]), "left")
    # Rows of the partial epoch go up to this place: the best row's, else all before the finer block.
    upto = F.when(F.col("block_cut").isNull(), F.lit(-1)).otherwise(F.coalesce("best", F.col("block_cut") * step + F.coalesce("finer_cut", F.lit(0)) * finer_step - 1)).cast("long")
    goal = goal.withColumn("upto", upto).withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    goal = goal.withColumn("quota", (F.col("full") * BLOCKS + F.when(F.col("upto") >= 0, F.floor(F.col("upto") / step) + 1).otherwise(0)).cast("long"))
    goal = stage_table(goal.select("source", "source_size", "target", "full", "upto", "rank", "quota"), "mix-goal")
    tree = splitting_tree(goal.select("rank", "quota"), shard_levels, seed)
    plan = stage_table(goal.join(tree, "rank").select(F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), "full", "upto", "ends"), "mix-plan")

    rows = join_plan(docs.withColumn("mix_size", word_count(F.col(text_col))).withColumn("mix_places", places), plan.select("mix_source", "mix_source_size", "mix_target", F.struct("full", "upto", "ends").alias("mix_plan")), source_col, F.element_at(places, 1))
    # What a shard draws is what the tree has dealt to it: blocks beyond the last shard's run go nowhere. Only the last block is taken in part.
    number = lambda t: t["epoch"] * BLOCKS + F.floor(t["place"] / step)
    taken = F.filter(F.transform("mix_places", lambda p, e: F.struct(e.alias("epoch"), p.alias("place"))), lambda t: (number(t) < F.element_at("mix_plan.ends", -1)) & ~((t["epoch"] == F.col("mix_plan.full")) & (t["place"] > F.col("mix_plan.upto"))))
    shard = lambda t: F.size(F.filter(F.col("mix_plan.ends"), lambda e: e <= number(t)))
    local = lambda t: F.pmod(F.xxhash64(F.lit(seed), t["place"], t["epoch"]), F.lit(1 << 52))
    draws = F.transform(taken, lambda t: F.struct(t["epoch"].alias("epoch"), shard(t).alias("shard"), local(t).alias("place")))
    return rows.withColumn("mix_draws", draws).drop("mix_places", "mix_plan", "mix_source")

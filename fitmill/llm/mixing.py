"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each document gets a rate between 0 and `most`. Among all rates that give every source its target
number of words, those of the highest entropy relative to rate 1 have odds tilted exponentially by
size: rate = most / (1 + (most - 1) * exp(-theta * size / scale)), one theta a source. The thetas
solve the convex dual by Newton iterations, each one aggregation over (source, size) counts, kept in
a bracket so that a long step can't run away. Rates are rounded to whole copies in small groups of a
source, largest document first, each making up for what the larger ones left over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitmill.llm.shared import WORD, text_key, written

#: Documents that are rounded together, about; a source of any size is cut into such groups.
GROUP = 256
ITERATIONS = 80
TOLERANCE = 1e-9


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """source, sid, source_size, scale, n, target: what each source is to give.

    Sources go by code point, null last, and take the weights in turn. A target stops at `most` times its
    source; the excess is dealt again by weight. Sorted by most * size / weight the stopped ones come first,
    so two running sums over the list of sources give the level that the others reach.
    """
    by_name, by_room = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("room", "sid")
    before = by_room.rowsBetween(W.unboundedPreceding, -1)
    size = F.col("size").cast("double")
    one = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"),
        (F.sum(size * size) / F.greatest(F.sum(size), F.lit(1.0))).alias("scale"))
    ranked = (one.withColumn("sid", F.row_number().over(by_name))
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1))
              .withColumn("total", share * F.sum("source_size").over(W.partitionBy()))
              .withColumn("room", most * F.col("source_size") / F.col("weight")))
    stopped = F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0))
    left = F.sum("weight").over(by_room.rowsBetween(W.currentRow, W.unboundedFollowing))
    levelled = ranked.withColumn("level", (F.col("total") - stopped) / left)
    free = F.min(F.when(F.col("room") > F.col("level"), F.struct("room", "sid", "level"))).over(W.partitionBy())["level"]
    return levelled.select(
        "source", "sid", "source_size", "scale", "n",
        F.when(F.col("room") <= F.col("level"), most * F.col("source_size").cast("double"))
        .otherwise(F.col("weight") * free).alias("target"))


def _rate(theta: Column, size: Column, scale: Column, most: int) -> Column:
    return most / (1 + (most - 1) * F.exp(-theta * size / scale))


def solve(sizes: DataFrame, goal: DataFrame, most: int) -> DataFrame:
    """sid, theta: the dual's solution; null where a source is empty or taken not at all or in full."""
    counts = written(sizes.where("size > 0").groupBy("sid", "size").agg(F.count(F.lit(1)).alias("n")))
    ratio = F.col("target") / F.col("source_size")
    inner = goal.where((F.col("target") > 0) & (F.col("target") < most * F.col("source_size") * (1 - 1e-12)))
    state = written(inner.select(
        "sid", "target", "scale", F.log(ratio * (most - 1) / (most - ratio)).alias("theta"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        F.lit(1.0).alias("gap")))
    for _ in range(ITERATIONS):
        rate, theta = _rate(F.col("theta"), F.col("size"), F.col("scale"), most), F.col("theta")
        words = F.col("n") * F.col("size")
        step = (counts.join(state.select("sid", "theta", "scale"), "sid").groupBy("sid").agg(
            F.sum(words * rate).alias("got"),
            F.sum(words * rate * (1 - rate / most) * F.col("size") / F.col("scale")).alias("slope")))
        over = F.col("got") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(theta), F.when(over, theta).otherwise(F.col("high"))
        newton = theta - (F.col("got") - F.col("target")) / F.col("slope")
        inside = (F.col("slope") > 0) & F.coalesce(newton > low, F.lit(True)) & F.coalesce(newton < high, F.lit(True))
        reach = 2 * F.abs(theta) + 1  # beyond the bracket, or half of it
        other = (F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2)
                 .when(over, theta - reach).otherwise(theta + reach))
        state = written(state.join(step, "sid").select(
            "sid", "target", "scale",
            F.when(F.abs(F.col("got") / F.col("target") - 1) <= TOLERANCE, theta)
            .when(inside & (F.abs(newton - theta) <= reach), newton).otherwise(other).alias("theta"),
            low.alias("low"), high.alias("high"), F.abs(F.col("got") / F.col("target") - 1).alias("gap")))
        if (state.agg(F.max("gap")).first()[0] or 0) <= TOLERANCE:
            break
    return state.select("sid", "theta")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """One row per row of docs(doc_id, text, source): doc_id, text_key, source, size, source_size, target, copies, taken.

    A null text has no words; empty documents and sources take nothing; a null source is one of its own,
    the last. Rows alike in doc_id and text are rounded one after the other. An empty table gives no rows.
    Other columns are not read. The outcome depends on the rows alone, not on their order.
    """
    sizes = written(docs.select(
        "doc_id", text_key().alias("text_key"), "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    goal = written(targets(sizes, weights, share, most))
    names = goal.select(F.col("source").alias("named"), "sid", "source_size", "scale", "n", "target")
    sized = sizes.join(names, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    thetas = solve(sized.select("sid", "size"), goal, most)
    rate = (F.when(F.col("theta").isNotNull(), _rate(F.col("theta"), F.col("size"), F.col("scale"), most))
            .when(F.col("target") > 0, F.lit(float(most))).otherwise(F.lit(0.0)))
    group = F.pmod(F.xxhash64("doc_id", "text_key", F.lit(7)), F.ceil(F.col("n") / GROUP))
    rated = sized.join(thetas, "sid", "left").withColumn("rate", rate).withColumn("grp", group)
    lists = rated.groupBy("sid", "source", "source_size", "target", "grp").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("size")).alias("order"), "doc_id", "text_key", "size", "rate"))).alias("docs"))

    def rounded(so_far: Column, doc: Column) -> Column:
        due = so_far["due"] + doc["rate"] * doc["size"]
        copies = F.when(doc["size"] > 0, F.greatest(F.lit(0), F.least(F.lit(most), F.floor(due / doc["size"] + 0.5))))
        copies = F.coalesce(copies, F.lit(0)).cast("int")
        return F.struct((due - copies * doc["size"]).alias("due"),
                        F.concat(so_far["copies"], F.array(copies)).alias("copies"))

    start = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<int>").alias("copies"))
    return (lists.withColumn("copies", F.aggregate("docs", start, rounded)["copies"])
            .select("source", "source_size", "target", F.explode(F.arrays_zip("docs", "copies")).alias("one"))
            .select("one.docs.doc_id", "one.docs.text_key", "source", "one.docs.size", "source_size", "target",
                    "one.copies", (F.col("one.copies") * F.col("one.docs.size")).alias("taken")))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it takes them; all columns are kept."""
    names = ["id", "key", "source"]
    nth = F.row_number().over(W.partitionBy(*names).orderBy(F.lit(0)))  # rows alike in all three, if any
    plan = mix(docs, weights, share, most).select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "source", "copies").withColumn("nth", nth)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"),
                       text_key().alias("key"), "source").withColumn("nth", nth)
    r, m = rows.alias("r"), plan.alias("m")
    same = F.col("r.nth") == F.col("m.nth")
    for name in names:
        same &= F.col(f"r.{name}").eqNullSafe(F.col(f"m.{name}"))
    taken = r.join(m, same).where("m.copies > 0")
    return taken.select("r.row", F.explode(F.sequence(F.lit(1), F.col("m.copies"))).alias("copy")).select("row.*")

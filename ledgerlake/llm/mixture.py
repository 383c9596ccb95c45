"""Mixing sources to target weights by a splitting tree (operator 4).

Each source's documents are dealt to ``BLOCKS`` blocks by a hash (a random
permutation). A source's target in words becomes a quota of its blocks: every
block once per full epoch, then blocks in order until the target is met, the
last one cut. The vector of quotas is split among the output shards by a
binary tree; each node gives its left child a multivariate hypergeometric
draw of half its blocks, so shards are disjoint, the counts add up exactly
and every shard is a fair sample. Inside a shard rows follow a hash order.

Only DataFrame functions. All rows of a source never meet: sums are
pre-aggregated by (source, block), documents join on (source, block), and
rows are ordered only inside the one cut block of a source.

Defined results: null text has size 0; null source is a source, last in
order; equal rows are interchangeable; a source of size 0 has target 0; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.llm.common import broadcast_if_small, landed, take_columns

# The weights repeat over the sources, the mix is 150 % of all
# words and a source is used at most twice.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
BLOCKS = 1024        # per source
LEVELS = 6           # of the tree: 2 ** LEVELS output shards
SEED = 20260
SMALL_PLAN = 200_000  # rows of the block plan that may be broadcast
WORD = r"[^\x20\x09-\x0D]+"


def _with_blocks(docs: DataFrame) -> DataFrame:
    """size, key (hash of the row), block and skey (source with null marked)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.xxhash64(F.lit(SEED), F.col("doc_id"), text)
    return docs.withColumns({
        "_size": F.regexp_count(text, F.lit(WORD)).cast("long"), "_key": key,
        "_block": F.pmod(key, F.lit(BLOCKS)).cast("int"),
        "_skey": F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))})


def targets(per_block: DataFrame, share: float = SHARE, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: size, weight and target words. Water filling:
    sources in order of the level at which they reach their cap; those that
    the common level reaches stop there."""
    src = per_block.groupBy("_skey").agg(F.sum("words").alias("source_size"), F.max("source").alias("source"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    src = src.withColumn("rank", F.row_number().over(by_name) - 1)
    src = src.withColumn("weight", F.element_at(F.lit(list(weights)), F.col("rank") % len(weights) + 1).cast("double"))
    src = src.withColumn("cap", F.col("source_size") * float(epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left_words = share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    src = src.withColumn("level", left_words / left_weight)
    src = src.withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    level = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(every)
    return src.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * level)) \
        .select("_skey", "rank", "source_size", "weight", "target")


def _quotas(per_block: DataFrame, goal: DataFrame, epochs: int) -> DataFrame:
    """Drawn blocks: (source, block, epoch, rest); ``rest`` is null for whole
    blocks, else the words that the cut block may still give."""
    run = Window.partitionBy("_skey").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    b = per_block.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    b = b.join(goal, "_skey").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    need = F.round("target").cast("long") - F.col("epoch") * F.col("source_size")
    b = b.withColumn("rest", need - F.col("before")).where("rest > 0 AND words > 0")
    return b.select("_skey", "rank", "_block", "epoch",
                    F.when(F.col("rest") < F.col("words"), F.col("rest")).alias("rest"))


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) / float(1 << 53)


TREE = "array<struct<rank:int,n:int>>"


def _left_half(level: int) -> Column:
    """The left child's vector: a multivariate hypergeometric draw of half of
    the node's blocks, block by block - left with probability need / pool."""
    def draw(acc: Column, s: Column) -> Column:
        def one(a: Column, i: Column) -> Column:
            goes = (_uniform(F.lit(level), F.col("node"), s["rank"], i) * a["pool"] < a["need"]).cast("int")
            return F.struct((a["pool"] - 1).alias("pool"), (a["need"] - goes).alias("need"),
                            a["left"].alias("left"), (a["x"] + goes).alias("x"))

        def end(a: Column) -> Column:
            drawn = F.struct(s["rank"].alias("rank"), a["x"].alias("n"))
            return F.struct(a["pool"].alias("pool"), a["need"].alias("need"),
                            F.concat(a["left"], F.array(drawn)).alias("left"))
        start = F.struct(acc["pool"].alias("pool"), acc["need"].alias("need"), acc["left"].alias("left"),
                         F.lit(0).alias("x"))
        return F.aggregate(F.sequence(F.lit(1), s["n"]), start, one, end)

    pool = F.aggregate("q", F.lit(0), lambda a, s: a + s["n"])
    start = F.struct(pool.alias("pool"), F.ceil(pool / 2).cast("int").alias("need"), F.array().cast(TREE).alias("left"))
    return F.aggregate("q", start, draw, lambda a: a["left"])


def split_tree(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(shard, rank, n): blocks of each source for each shard. ``quotas`` has
    one row per source (rank, n); a node is one row holding its vector."""
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("rank", F.col("n").cast("int").alias("n")))).alias("q")) \
        .select(F.lit(0).alias("node"), "q")
    for level in range(levels):
        nodes = nodes.select("node", F.filter("q", lambda s: s["n"] > 0).alias("q"))
        nodes = nodes.select("node", "q", _left_half(level).alias("l"))
        right = F.zip_with("q", "l", lambda a, b: F.struct(a["rank"].alias("rank"), (a["n"] - b["n"]).alias("n")))
        nodes = nodes.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("l").alias("q")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("q")))).alias("c")).select("c.node", "c.q")
    return nodes.select(F.col("node").alias("shard"), F.explode("q").alias("s")) \
        .select("shard", "s.rank", "s.n").where("n > 0")


def plan_mixture(sized: DataFrame, share: float = SHARE, weights=WEIGHTS, epochs: int = EPOCHS,
                 levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(targets by source, draws by (source, block)). ``sized`` has _skey,
    source, _block, _size. A draw is (epoch, rest, shard)."""
    per_block = landed(sized.groupBy("_skey", "_block").agg(F.sum("_size").alias("words"),
                                                           F.max("source").alias("source")), "mix-blocks")
    goal = landed(targets(per_block, share, weights, epochs), "mix-targets")
    drawn = landed(_quotas(per_block, goal, epochs), "mix-quotas")
    tree = split_tree(drawn.groupBy("rank").agg(F.count("*").alias("n")), levels)
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    slots = tree.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long")) \
        .select("rank", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    permuted = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(SEED), "rank", "_block", "epoch"), "_block", "epoch")
    drawn = drawn.withColumn("slot", (F.row_number().over(permuted) - 1).cast("long")).join(slots, ["rank", "slot"])
    draws = drawn.groupBy("_skey", "_block").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "rest", "shard"))).alias("draws"))
    return goal, landed(draws, "mix-draws")


def _cut_rows(rows: DataFrame) -> DataFrame:
    """``_before``: words of the cut block ahead of the row (0 elsewhere).
    Only rows of cut blocks, at most 1/BLOCKS of a source, are ordered."""
    is_cut = F.exists(F.coalesce("draws", F.array().cast("array<struct<epoch:int,rest:bigint,shard:int>>")),
                      lambda d: d["rest"].isNotNull())
    order = Window.partitionBy("_skey", "_block").orderBy("_key", "doc_id", "_size")
    ahead = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.where(~is_cut).withColumn("_before", F.lit(0).cast("long")).unionByName(
        rows.where(is_cut).withColumn("_before", ahead))


def mixture_report(docs: DataFrame) -> DataFrame:
    """Per row: its size, its source's size and target, and the words taken
    (the cut block's last document gives a part)."""
    sized = landed(_with_blocks(take_columns(docs, "doc_id", "text", "source")).drop("text"), "mix-sizes")
    goal, draws = plan_mixture(sized)
    rows = _cut_rows(sized.join(draws, ["_skey", "_block"], "left"))
    words = F.aggregate("draws", F.lit(0).cast("long"), lambda acc, d: acc + F.when(
        d["rest"].isNull(), F.col("_size")).otherwise(F.greatest(F.lit(0), F.least(
            F.col("_size"), d["rest"] - F.col("_before")))))
    rows = rows.withColumn("taken", F.coalesce(words, F.lit(0).cast("long")))
    rows = rows.withColumn("shards", F.transform("draws", lambda d: d["shard"]))
    rows = rows.drop("source").join(broadcast_if_small(goal, SMALL_PLAN), "_skey")
    return rows.select("doc_id", F.col("_size").alias("size"), "source_size", "target", "taken", "shards")


def mix_documents(docs: DataFrame, share: float = SHARE, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The mix itself: whole rows of ``docs``, once per epoch that takes them,
    grouped by shard and shuffled inside it. The document at the cut is taken
    when at least half of it fits."""
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"),
                       *[F.col(f"`{c}`") for c in ("doc_id", "text", "source")])
    blocked = _with_blocks(held)
    sized = landed(blocked.select("doc_id", "source", "_skey", "_block", "_size", "_key"), "mix-sizes")
    _, draws = plan_mixture(sized, share, weights, epochs)
    # sizes are needed per row only in cut blocks
    rows = _cut_rows(blocked.drop("text", "source").join(broadcast_if_small(draws, SMALL_PLAN), ["_skey", "_block"]))
    taken = F.filter("draws", lambda d: d["rest"].isNull() | (F.col("_before") + F.col("_size") / 2 <= d["rest"]))
    copies = rows.select("_row", "_key", F.explode(taken).alias("d"))
    order = F.xxhash64(F.lit(SEED), "_key", "d.epoch")
    shuffled = copies.select("_row", F.col("d.shard").alias("_shard"), order.alias("_order"))
    shuffled = shuffled.repartition(F.col("_shard")).sortWithinPartitions("_shard", "_order")
    return shuffled.select("_row.*")

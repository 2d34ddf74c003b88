"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents fall into blocks of their source by a hash. A source's target is filled with whole rounds over all its blocks,
then with blocks in a hashed order, then, inside the one block that the target ends in, with documents in a hashed order.
The chosen (block, copy) tickets of all sources then go down a binary tree: at each node a random half of its tickets
goes left, so a node's counts of each source are a multivariate-hypergeometric draw and every source's quota is met
exactly. The leaves are the output shards; each shuffles its documents locally. Only DataFrame functions are used.

Everything is decided on counts: one row per source, and at most MAX_BLOCKS blocks plus one per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2.0
ROWS_PER_BLOCK = 512
#: Blocks hold more rows beyond it, so that what one task orders stays bounded.
MAX_BLOCKS = 1_000_000
#: Words of an output shard, unless the number of shards is given; a shard has several blocks even so.
SHARD_WORDS = 4_000_000
MIN_SHARDS, MAX_SHARDS = 32, MAX_BLOCKS // 8
SEED = 20240607


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _mark() -> Column:
    """A hash of a row's id and text; ids of any width give the same."""
    return F.xxhash64(F.lit(SEED), F.col("doc_id").cast("long"), F.col("text"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """From a row per source (source, source_size, n): those columns and target.

    Weights repeat along the sources in code point order, null last. A source's target is at most max_repeat times its
    size; what it can't take is shared among the others by weight, until none is above. That level is the largest of
    (total - caps of the sources that fill up first) / (weights of the rest), in order of cap / weight.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_source) - 1) % len(weights) + 1).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(max_repeat))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(filling), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0)))
    leveled = ranked.withColumn("level", level)
    return leveled.withColumn("target", F.least("cap", F.max("level").over(everything) * F.col("weight"))).select(*sizes.columns, "target")


def split(tickets: DataFrame, shards: int) -> DataFrame:
    """Add shard: the tickets at each node of a binary tree are halved at random, level by level."""
    levels = max(0, (shards - 1).bit_length())
    out = tickets.withColumn("node", F.lit(0))
    for level in range(levels):
        order = Window.partitionBy("node").orderBy(F.xxhash64("source", "block", "copy", F.lit(level), F.lit(SEED)), F.col("source").asc_nulls_last(), "block", "copy")
        # of the 2 ** level nodes here each splits the shards below it, left the larger part
        width = shards / 2 ** (level + 1)
        low = F.col("node") * 2
        left = F.floor(F.lit(width) * (low + 1)) - F.floor(F.lit(width) * low)
        both = F.floor(F.lit(width) * (low + 2)) - F.floor(F.lit(width) * low)
        goes_right = F.row_number().over(order) * both > F.count(F.lit(1)).over(Window.partitionBy("node")) * left
        out = out.withColumn("goes_right", F.when(both > 0, goes_right).otherwise(False)).withColumn("node", F.col("node") * 2 + F.col("goes_right").cast("int")).drop("goes_right")
    return out.withColumn("shard", F.floor(F.col("node") * F.lit(shards / 2**levels)).cast("int")).drop("node")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT, shards: int | None = None) -> DataFrame:
    """A row per input row: doc_id, mark, size, source_size, target, shards (the output shard of each copy taken).

    Sizes are words; null and empty texts have none. A null source is a source. mark is a hash of the row's id and text
    that orders rows; repeated rows with one id and one text share it. Reruns give the same rows. An empty table gives
    none. Of the input only doc_id, text and source are read. The number of shards grows with the words, unless given.
    """
    base = common.durable(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(common.text_or_empty()).alias("size"), _mark().alias("mark")))
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = targets(sizes, weights, share, max_repeat)
    per_block = F.greatest(F.lit(ROWS_PER_BLOCK), F.ceil(F.sum("n").over(Window.partitionBy()) / F.lit(MAX_BLOCKS)))
    sources = common.durable(sources.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("n") / per_block))).drop("n"))
    if shards is None:
        words = sources.agg(F.sum("source_size")).first()[0] or 0  # one number
        shards = min(MAX_SHARDS, max(MIN_SHARDS, round(words * share / SHARD_WORDS)))
    named = sources.withColumnRenamed("source", "its_source")
    rows = base.join(named, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source").withColumn("block", F.pmod("mark", "n_blocks"))

    blocks = rows.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    drawn = Window.partitionBy("source").orderBy(F.xxhash64("block", F.lit(SEED)), "block").rowsBetween(Window.unboundedPreceding, -1)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    blocks = blocks.withColumn("rounds", rounds).withColumn("left", F.col("target") - F.col("rounds") * F.col("source_size") - F.coalesce(F.sum("words").over(drawn), F.lit(0)))
    blocks = blocks.withColumn("ends_here", (F.col("left") > 0) & (F.col("left") < F.col("words")))
    blocks = blocks.withColumn("copies", F.col("rounds") + F.when((F.col("left") > 0) & (F.col("words") > 0), 1).otherwise(0)).select("source", "block", "left", "ends_here", "copies")
    blocks = common.durable(blocks)
    tickets = blocks.filter("copies > 0").select("source", "block", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    dealt = split(tickets, shards).groupBy("source", "block").agg(F.transform(F.sort_array(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("shards"))
    blocks = blocks.join(dealt.select(F.col("source").alias("s"), F.col("block").alias("b"), "shards"), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left").select(F.col("source").alias("s"), F.col("block").alias("b"), "left", "ends_here", F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))

    placed = rows.join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    kept = ["doc_id", "mark", "size", "source_size", "target"]
    whole = placed.filter(~F.col("ends_here")).select(*kept, "shards")
    # the rows of one block for each source
    inside = Window.partitionBy("source").orderBy(F.xxhash64("mark", F.lit(SEED)), "mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    part = placed.filter("ends_here").withColumn("taken_so_far", F.sum("size").over(inside))
    part = part.select(*kept, F.when(F.col("taken_so_far") - F.col("size") / 2 <= F.col("left"), F.col("shards")).otherwise(F.slice("shards", F.lit(1), F.size("shards") - 1)).alias("shards"))
    return whole.unionByName(part)


def materialise(docs: DataFrame, plan: DataFrame, shards: int | None = None) -> DataFrame:
    """The mixed rows: each document as often as its plan says, with mix_shard and mix_copy, shuffled inside its shard.

    Each shard is a task by itself. All columns of the input pass unchanged, null and empty texts among them; where one
    has the name of a new column, that is common.fresh(docs.columns, name). Rows that repeat one id and text share the
    plan of the one that is taken most often. An empty table gives no rows. shards: how many the plan deals to, counted
    from the plan unless given.
    """
    mark, dealt, copy, shard = (common.fresh(docs.columns, x) for x in ("mix_mark", "mix_shards", "mix_copy", "mix_shard"))
    # by the id as well: different documents of one mark keep their own copies
    key = lambda of: F.struct(F.col("doc_id").cast("long").alias("doc_id"), of.alias("mark"))  # noqa: E731  equal where both are, nulls too
    keyed = docs.withColumn(mark, key(_mark()))
    if shards is None:
        plan = common.stored(plan.select("doc_id", "mark", "shards"), "mix-plan")
    # rows that repeat one id and text share each plan row; a plan row serves one of them
    taken = plan.groupBy(key(F.col("mark")).alias(mark)).agg(F.max("shards").alias(dealt))
    if shards is None:
        shards = (plan.agg(F.max(F.array_max("shards"))).first()[0] or 0) + 1  # one number
    copies = keyed.join(taken, mark).select("*", F.posexplode(dealt).alias(copy, shard))
    return copies.repartitionById(shards, F.col(shard)).sortWithinPartitions(F.xxhash64(f"{mark}.mark", copy, F.lit(SEED))).drop(mark, dealt)


def op4_source_mixing(spark, sf_dir: str) -> DataFrame:
    plan = mix(common.documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")

"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is made of blocks of equal numbers of words. Sources compete for
blocks by the quotients target / (2k + 1), k being the blocks they
hold already; the highest quotients win, which gives each source an integer
quota. A block is one word by default, so that the smallest source gets its share; whole
rounds of larger blocks for the shards are counted off a quota afterwards. A source lays its documents
end to end in a seeded order and cuts that
stream into blocks; its quota takes the blocks from the front, and goes round
again once the stream is used up. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import keyed, prefix_sums, row_keys, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
#: Words of a block that sources compete for, and of one that goes to a shard.
BLOCK_WORDS, SHARD_WORDS = 1, 16
SHARDS = 8
SEED = 23
#: Prices tried in a pass of the search for the last winning quotient, and quotients ranked one by one beside one a source.
GRID, LISTED = 64, 1000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """Adds rank, weight and target to a table of sources (source, source_size).

    Weights repeat over the sources in code point order, null last. The targets share ``share`` of
    all words by weight; none exceeds ``repeats`` times its source, and the excess is shared again by
    weight until none does: targets are the lesser of that limit and weight times a level, which is
    found by passing the sources in order of limit / weight."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", cycle[F.pmod(F.col("rank") - 1, F.lit(len(weights)))].cast("double"))
    limit = F.col("source_size") * F.lit(float(repeats))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    levels = ranked.withColumn("limit", limit).withColumns({
        "spent": F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "open": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
        "place": F.row_number().over(by_ratio),
        "whole": F.sum("source_size").over(everything) * F.lit(share)})
    levels = levels.withColumn("level", (F.col("whole") - F.col("spent")) / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("place", "level"))
    water = F.min(fits).over(everything)["level"]
    target = F.coalesce(F.least(F.col("limit"), F.col("weight") * water), F.col("limit"))
    return levels.withColumn("target", target).select("source", "source_size", "rank", "weight", "target")


def prices(sources: DataFrame, blocks: int) -> tuple[float, float]:
    """A range of quotients (low, high) that holds the price of a block, the least quotient that wins one of ``blocks``.

    The quotients of a source from a price on are counted without listing them: target / (2k + 1) >= price for
    k < (target / price + 1) / 2. Each pass counts at GRID prices, in proportion to one another, and goes on between the
    two that enclose ``blocks``, until hardly more quotients than sources are left in between."""
    first = sources.agg(F.count("*").alias("n"), (2 * F.max("target")).alias("high"),
                        F.min(F.col("target") / (2 * F.col("most") + 1)).alias("low"), F.sum("most").alias("all")).first()
    low, high, below, above = first.low, first.high, first["all"], 0
    while below - above > first.n + LISTED and high / low > 1 + 1e-12:
        grid = [low * (high / low) ** (i / GRID) for i in range(1, GRID)]
        won = sources.agg(*[F.sum(_wins(price)) for price in grid]).first()
        for price, n in zip(grid, won):
            if n >= blocks:
                low, below = price, n
            else:
                high, above = price, n
                break
    return low, high


def _wins(price: float) -> Column:
    """Blocks that a source holds if all its quotients from ``price`` on win."""
    return F.least("most", F.floor((F.col("target") / F.lit(price) + 1) / 2).cast("long"))


def quotas(sources: DataFrame, block: int, repeats: int) -> DataFrame:
    """Adds quota, the blocks that a source gets by the highest quotients target / (2k + 1).

    No quota takes more than ``repeats`` times a source; equal quotients win by rank. All quotients of all sources
    compete: ``prices`` counts those that surely win and surely lose, and those in between are listed and
    ranked, a few for each source. ``sources`` is read several times, so should be written."""
    able = sources.withColumn("most", F.floor(F.col("source_size") * repeats / float(block)).cast("long"))
    rivals = able.where("most > 0 and target > 0")
    total = sources.agg(F.round(F.sum("target") / float(block)).cast("long")).first()[0] or 0
    blocks = min(total, rivals.agg(F.sum("most")).first()[0] or 0)
    if not blocks:
        return sources.withColumn("quota", F.lit(0).cast("long"))
    low, high = prices(rivals, blocks)
    # a quotient more to both sides, as divisions round
    near = rivals.withColumns({"sure": F.greatest(F.lit(0), _wins(high) - 1), "most": F.least("most", _wins(low) + 1)})
    near = near.withColumn("open", F.lit(blocks) - F.sum("sure").over(Window.partitionBy()))
    tried = near.where("most > sure").select(
        "rank", "target", "open", F.explode(F.sequence(F.col("sure"), F.col("most") - 1)).alias("k"))
    place = F.row_number().over(Window.orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), "rank"))
    won = (tried.withColumn("place", place).where("place <= open")
           .groupBy("rank").agg(F.count("*").alias("won")))
    return sources.join(near.select("rank", "sure"), "rank", "left").join(won, "rank", "left").select(
        "source", "source_size", "rank", "weight", "target",
        (F.coalesce("sure", F.lit(0)) + F.coalesce("won", F.lit(0))).cast("long").alias("quota"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
        block: int = BLOCK_WORDS, shards: int = SHARDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """How many words of every row of ``docs`` (doc_id, text, source; others are ignored) the mix takes.

    Returns doc_id, size (words), source_size, target (its source's), taken (repeats counted, at most
    ``repeats`` times the size), quota (the blocks of ``shard_words`` words that each of ``shards`` shards gets of its source;
    less than one a shard is left over), source and text_hash. The words taken of a source are within a
    block of its target, also where that is a few words. A null source is a
    source of its own, ranked last; a null or empty text has size 0 and gives nothing. Rows equal in
    all columns are interchangeable. Same rows, same result. An empty table gives an empty result.

    The text is reduced to its word count in the scan. A source may hold a third of all rows: its
    stream is laid out by two-level prefix sums. Only the table of sources is ever sorted as a whole."""
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        word_count(F.col("text")).alias("size"),
                        F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), "text").alias("order"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    light = written(light, "mix-rows")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = written(targets(sizes, weights, share, repeats), "mix-targets")
    plan = written(quotas(aims, block, repeats), "mix-sources")
    keys = {"source_key": F.coalesce("source", F.lit("")), "no_source": F.col("source").isNull()}
    placed = prefix_sums(light.withColumns(keys), list(keys), "order", ["size"],
                         plan.withColumns(keys).drop("source"))
    words = F.col("quota") * block
    rounds = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    rest = words - rounds * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before_size")))
    return placed.select("doc_id", "size", "source_size", "target",
                         (rounds * F.col("size") + part).cast("long").alias("taken"),
                         F.floor(words / (shards * shard_words)).alias("quota"), "source",
                         "text_hash")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns as they are, each row as many times as the mix takes it: whole documents, so
    taken / size is rounded (only the last document of a source's quota is ever taken in part). Rows that
    the mix doesn't take, those without words among them, go."""
    rows, keys = row_keys(docs)
    rows = rows.withColumn("row_source", F.col("row.source").cast("string"))
    plan = keyed(mix(docs, **options)).withColumnRenamed("source", "row_source")
    plan = plan.withColumn("times", F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int"))
    # rows equal in id, text and source are told apart by their turn
    by = {"row_no_source": F.col("row_source").isNull(), "row_source": F.coalesce("row_source", F.lit(""))}
    keys = [*keys, *by]
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy("row_hash"))
    rows = rows.withColumns(by).withColumn("turn", turn)
    plan = plan.withColumns(by).select(*keys, "times").withColumn("turn", turn).where("times > 0")
    both = rows.join(plan, [*keys, "turn"])
    return both.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")

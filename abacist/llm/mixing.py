"""Mix sources to target weights.

Documents are cut into blocks of at most ``block_words`` words. A source's blocks are put into a random
order by range partitioning on (source, hash), so a block's place in its source is an exact rank and a
source that holds most rows lies in many partitions. The target gives every source an exact quota of
draws: whole repeats of all its blocks, then the first places of the random order. A splitting tree
shares the quotas among the output shards: each node halves its draws, and the left half takes a
multivariate hypergeometric part of every source's quota, from the first draws on. A shard's draws of
a source are therefore one interval; the intervals are merged with those of the partitions, and a block
looks its shard up among the few intervals of its own partition. The shards draw disjoint places, and
rows are put in hash order inside their shard.

Only DataFrame functions are used. Side tables hold a row per source, a row per (source, partition) and
one per (source, shard); a node of the tree is a row with one number per source.

Defined cases: null text counts as empty, a document without words is never drawn, null is a source of
its own (last), equal rows are separate documents, an empty table gives an empty mix.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.llm.common import SPACES, let, n_words, uniform
from abacist.session import materialise

BLOCK_WORDS = 512
SHARD_WORDS = 8_000_000
LEAST_SHARDS = 16
"""A mix has so many shards at least, however few its words."""
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 20_240_501
TRIES = 48
"""Candidates of one rejection draw; all fail with a probability below 1e-18, then the mode is taken."""

R, S, N = "__mix_row", "__mix_source", "__mix_size"


def log_factorial(n: Column) -> Column:
    """Stirling's series at n + 8, less the logarithms of the eight factors."""
    z = n.cast("double") + 8.0
    head = (z + 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (12 * z) - 1 / (360 * z * z * z)
    return head - F.log(reduce(lambda a, b: a * b, (n.cast("double") + float(i) for i in range(1, 9))))


def hypergeometric(good: Column, bad: Column, sample: Column, key: Column) -> Column:
    """Number of good ones among ``sample`` drawn without replacement, by ratio of uniforms."""
    low, high = F.greatest(F.lit(0), sample - bad), F.least(good, sample)

    def drawn(p: Column) -> Column:
        g, b, s = p["g"].cast("double"), p["b"].cast("double"), p["s"].cast("double")
        total = g + b
        share = g / total
        mode = F.floor((s + 1) * (g + 1) / (total + 2))
        spread = F.sqrt(s * share * (1 - share) * (total - s) / F.greatest(total - 1, F.lit(1.0)) + 0.5)
        width = 2 * math.sqrt(2 / math.e) * spread + (3 - 2 * math.sqrt(3 / math.e))

        def log_mass(k: Column) -> Column:
            return -(log_factorial(k) + log_factorial(p["g"] - k) + log_factorial(p["s"] - k)
                     + log_factorial(p["b"] - p["s"] + k))

        def search(c: Column) -> Column:
            def attempt(state: Column, i: Column) -> Column:
                u = uniform(p["key"], i, F.lit("u")) + F.lit(2.0**-54)
                k = F.floor(s * share + 0.5 + c["width"] * (uniform(p["key"], i, F.lit("v")) - 0.5) / u)
                fits = k.between(p["low"], p["high"]) & (log_mass(k) - c["peak"] >= 2 * F.log(u))
                return F.when(state.isNotNull(), state).when(fits, k)

            found = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("long"), attempt)
            return F.coalesce(found, mode)

        return F.when(p["low"] >= p["high"], p["low"]).otherwise(
            let(F.struct(log_mass(mode).alias("peak"), width.alias("width")), search))

    parts = {"g": good, "b": bad, "s": sample, "key": key, "low": low, "high": high}
    return let(F.struct(*[(c if n == "key" else c.cast("long")).alias(n) for n, c in parts.items()]), drawn)


def left_part(quotas: Column, node: Column, seed: int) -> Column:
    """Multivariate hypergeometric share of the quotas that goes to a node's left half."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x)
    start = F.struct(total.alias("rest"), F.floor(total / 2).cast("long").alias("want"), F.array().cast("array<long>").alias("left"))

    def take(state: Column, quota: Column) -> Column:
        key = F.xxhash64(F.lit(seed), node, F.size(state["left"]))
        k = hypergeometric(quota, state["rest"] - quota, state["want"], key)
        return let(k, lambda x: F.struct(
            (state["rest"] - quota).alias("rest"), (state["want"] - x).alias("want"),
            F.concat(state["left"], F.array(x)).alias("left")))

    return F.aggregate(quotas, start, take, lambda state: state["left"])


def targets(rows: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target): weights by code point order of the sources, capped and reshared.

    A target is the smaller of ``most`` times its source's size and its weight times a common factor.
    Sorted by cap over weight, the factor is the first that no later source's cap falls below. One row
    per source meets in one window.
    """
    sizes = rows.groupBy(S).agg(F.sum(N).alias("source_size"), F.sum("__mix_blocks").alias("blocks"))
    order = Window.orderBy(F.col(S).asc_nulls_last())
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    listed = sizes.select(S, "source_size", "blocks", place.cast("long").alias("place"), weight.alias("weight"))
    cap = F.col("source_size").cast("double") * most
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "place")
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    tried = listed.withColumn("cap", cap).withColumns({
        "total": F.sum("source_size").over(everything),
        "spent": F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "weights": F.sum("weight").over(rest),
    }).withColumn("factor", (F.col("total") - F.col("spent")) / F.col("weights"))
    fits = F.when(F.col("factor") <= F.col("cap") / F.col("weight"), F.col("factor"))
    level = F.min_by(fits, F.when(fits.isNotNull(), F.col("cap") / F.col("weight"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return tried.select(S, "source_size", "blocks", "place", target.alias("target"))


def rows_of(documents: DataFrame, keep: list[str], block_words: int) -> DataFrame:
    """Written rows with a row number, their size in words and their number of blocks."""
    size = n_words(F.col("text"))
    rows = documents.select(*keep, F.col("source").alias(S), size.alias(N))
    return materialise(rows.withColumns({
        R: F.monotonically_increasing_id(),
        "__mix_blocks": F.ceil(F.col(N) / block_words).cast("long"),
    }))


def block_words_of(j: Column) -> Column:
    """Words before block ``j``: a document's blocks differ by one word at most."""
    return F.floor(j * F.col(N) / F.col("__mix_blocks")).cast("long")


def draws(rows: DataFrame, wanted: DataFrame, shard_words: int, seed: int,
          least_shards: int = LEAST_SHARDS) -> tuple[DataFrame, int]:
    """One row per drawn block: row, copy, block, words, shard, order; and the number of shards."""
    j = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__mix_blocks") - 1)).alias("block")
    cut = rows.where(F.col("__mix_blocks") > 0).select(R, S, N, "__mix_blocks", j)
    cut = cut.select(R, S, "block", (block_words_of(F.col("block") + 1) - block_words_of(F.col("block"))).alias("words"),
                     F.xxhash64(F.lit(seed), R, "block").alias("random"))
    order = [S, "random", R, "block"]
    ranked = cut.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranked = materialise(ranked.withColumn("part", F.shiftright("at", 33)))

    cells = ranked.groupBy(S, "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("words").alias("w"), F.min("at").alias("first"))
    by_source = Window.partitionBy(S).orderBy("part")
    before = by_source.rowsBetween(Window.unboundedPreceding, -1)
    cells = materialise(cells.withColumns({
        "n_before": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "w_before": F.coalesce(F.sum("w").over(before), F.lit(0)),
    }))

    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST_REPEATS)).cast("long")
    wanted = wanted.where(F.col("source_size") > 0).withColumn("whole", whole)
    wanted = wanted.withColumn("part_words", F.col("target") - F.col("whole") * F.col("source_size"))
    crossing = cells.join(wanted.select(F.col(S).alias("s"), "part_words"), F.col(S).eqNullSafe(F.col("s")))
    crossing = crossing.where((F.col("w_before") < F.col("part_words")) & (F.col("w_before") + F.col("w") >= F.col("part_words")))
    crossing = crossing.select(F.col("part").alias("p"), "s", "n_before", "w_before", "part_words")
    inside = ranked.join(crossing, (F.col("part") == F.col("p")) & F.col(S).eqNullSafe(F.col("s")))
    sofar = F.col("w_before") + F.sum("words").over(Window.partitionBy("p", "s").orderBy("at")) - F.col("words") / 2
    taken = inside.withColumn("in", (sofar < F.col("part_words")).cast("long")).groupBy("s").agg(
        (F.max("n_before") + F.sum("in")).alias("extra"))
    quotas = wanted.join(taken, F.col(S).eqNullSafe(F.col("s")), "left").drop("s")
    quotas = materialise(quotas.withColumn(
        "quota", F.col("whole") * F.col("blocks") + F.coalesce("extra", F.lit(0))))

    words = quotas.agg(F.sum("source_size")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(least_shards, words / shard_words))))
    pieces = cell_pieces(cells, quotas, shard_starts(quotas, depth, seed))
    # a row per (source, partition): a partition holds one source, or the few that end or begin in it
    found = ranked.join(pieces, (F.col("part") == F.col("p")) & F.col(S).eqNullSafe(F.col("s")))
    place = F.col("at") - F.col("first") + F.col("n_before")
    copies = F.floor((F.col("quota") - place - 1) / F.col("in_source")).cast("long")
    drawn = found.withColumn("place", place).where(F.col("quota") > F.col("place")).select(
        R, "block", "words", "place", "in_source", "pieces", F.explode(F.sequence(F.lit(0).cast("long"), copies)).alias("copy"))
    shard = shard_at(F.col("pieces"), F.col("copy") * F.col("in_source") + F.col("place"), depth)
    drawn = drawn.select(R, "copy", "block", "words", shard.alias("shard"))
    return drawn.withColumn("order", F.xxhash64(F.lit(seed), "shard", R, "copy")), 2**depth


def shard_starts(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(place, shard, draw): the first draw of every shard that takes draws of a source, by the splitting tree.

    A left half takes the first draws of its node, so a shard's draws of a source are one interval.
    """
    listed = F.array_sort(F.collect_list(F.struct("place", "quota")))
    level = quotas.agg(listed.alias("l")).where(F.size("l") > 0).select(
        F.lit(1).cast("long").alias("node"), F.col("l.quota").alias("quotas"), F.col("l.place").alias("places"))
    for _ in range(depth):
        cut = materialise(level.withColumn("left", left_part(F.col("quotas"), F.col("node"), seed)))
        right = F.zip_with("quotas", "left", lambda q, k: q - k)
        halves = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
                         F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")))
        level = cut.select("places", F.explode(halves).alias("h")).select("h.node", "h.quotas", "places")
    leaves = level.select((F.col("node") - F.lit(2**depth)).alias("shard"), F.inline(F.arrays_zip(
        F.col("places").alias("place"), F.col("quotas").alias("n"))))
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = leaves.withColumn("draw", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return starts.where(F.col("n") > 0).select("place", "shard", "draw")


def cell_pieces(cells: DataFrame, quotas: DataFrame, starts: DataFrame) -> DataFrame:
    """Per (source, partition) the pieces of its draws: an array of (first draw, shard) in order.

    The draws of a source are a line; it is cut where a shard begins and where a copy of a partition's
    blocks begins. Both kinds of cuts are merged by draw number, a row each.
    """
    side = quotas.select(F.col(S).alias("s"), F.col("place").alias("source_place"), F.col("blocks").alias("in_source"), "quota")
    listed = cells.join(side, F.col(S).eqNullSafe(F.col("s"))).where(F.col("quota") > F.col("n_before")).select(
        F.col("part").alias("p"), "s", "first", "n_before", "in_source", "quota", "source_place")
    last = F.floor((F.col("quota") - F.col("n_before") - 1) / F.col("in_source")).cast("long")
    copies = listed.select("source_place", "p", "n_before", "in_source", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("copy"))
    none = F.lit(None).cast("long")
    cuts = copies.select("source_place", (F.col("copy") * F.col("in_source") + F.col("n_before")).alias("draw"),
                         F.col("p").cast("long").alias("p"), none.alias("shard"))
    cuts = cuts.unionAll(starts.select("place", "draw", none, "shard"))
    cuts = cuts.groupBy("source_place", "draw").agg(F.max("p").alias("p"), F.max("shard").alias("shard"))
    sofar = Window.partitionBy("source_place").orderBy("draw")
    merged = cuts.select("source_place", "draw", F.last("p", ignorenulls=True).over(sofar).alias("piece_p"),
                         F.last("shard", ignorenulls=True).over(sofar).alias("shard"))
    arrays = merged.groupBy("source_place", "piece_p").agg(F.array_sort(F.collect_list(F.struct("draw", "shard"))).alias("pieces"))
    arrays = arrays.withColumnRenamed("source_place", "place")
    return listed.join(arrays, (F.col("source_place") == F.col("place")) & (F.col("p") == F.col("piece_p"))).select(
        "p", "s", "first", "n_before", "in_source", "quota", "pieces")


def shard_at(pieces: Column, draw: Column, depth: int) -> Column:
    """Shard of the last piece that begins at or before a draw, by halving."""
    steps = F.array(*[F.lit(2**i) for i in reversed(range(depth + MOST_REPEATS))])

    def step(at: Column, jump: Column) -> Column:
        inside = (at + jump <= F.size(pieces)) & (F.get(pieces, at + jump - 1)["draw"] <= draw)
        return at + F.when(inside, jump).otherwise(0)

    return F.get(pieces, F.aggregate(steps, F.lit(0), step) - 1)["shard"]


def mix_sizes(documents: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
              weights=WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED, least_shards: int = LEAST_SHARDS) -> DataFrame:
    """Per document the words that the mix takes, with its source's size and target."""
    rows = rows_of(documents, ["doc_id"], block_words)
    wanted = materialise(targets(rows, weights, most))
    drawn, _ = draws(rows, wanted, shard_words, seed, least_shards)
    per_row = drawn.groupBy(R).agg(F.sum("words").alias("taken"), F.min("shard").alias("first_shard"))
    out = rows.join(per_row, R, "left").join(
        wanted.select(F.col(S).alias("s"), "source_size", "target"), F.col(S).eqNullSafe(F.col("s")))
    return out.select("doc_id", F.col(N).alias("size"), "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard")


def mix_documents(documents: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
                  weights=WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED, least_shards: int = LEAST_SHARDS) -> DataFrame:
    """The mixed corpus with the columns of ``documents``: a row per document and copy, in shards.

    A copy whose blocks are all drawn keeps its text as it is; otherwise its text is the drawn blocks
    in their order. A copy lies in the shard of its first drawn block. ``n_chars``, where there is such
    a column, is counted anew.
    """
    names = documents.columns
    rows = rows_of(documents, names, block_words)
    wanted = materialise(targets(rows, weights, most))
    drawn, shards = draws(rows, wanted, shard_words, seed, least_shards)
    copies = drawn.groupBy(R, "copy").agg(
        F.array_sort(F.collect_list(F.struct("block", "shard", "order"))).alias("__mix_drawn"))
    copies = copies.select(F.col(R).alias("__mix_r"), "__mix_drawn")
    joined = rows.join(copies, F.col(R) == F.col("__mix_r"))
    pieces = F.regexp_extract_all("text", F.lit(rf"[{SPACES}]*[^{SPACES}]+"), F.lit(0))

    def block_text(p: Column) -> Column:
        of = F.transform("__mix_drawn", lambda b: F.array_join(F.slice(
            p, (block_words_of(b["block"]) + 1).cast("int"),
            (block_words_of(b["block"] + 1) - block_words_of(b["block"])).cast("int")), ""))
        return F.array_join(of, "")

    whole = F.size("__mix_drawn") == F.col("__mix_blocks")
    text = F.when(whole, F.col("text")).otherwise(let(pieces, block_text))
    first = F.col("__mix_drawn")[0]
    mixed = joined.select(*[F.col(f"`{c}`") for c in names if c != "text"], text.alias("text"),
                          first["shard"].alias("__mix_shard"), first["order"].alias("__mix_order"))
    mixed = mixed.repartition(shards, "__mix_shard").sortWithinPartitions("__mix_shard", "__mix_order")
    return mixed.select(*[F.char_length("text").cast(documents.schema["n_chars"].dataType).alias("n_chars")
                          if c == "n_chars" else F.col(f"`{c}`") for c in names])

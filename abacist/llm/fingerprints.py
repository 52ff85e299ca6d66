"""Document fingerprints from closed syncmers.

A text's words are hashed in order. Of every run of ``K`` words
the hashes of its inner runs of ``S`` words are compared; the run is an anchor if the smallest
lies at its first or last place. Whether a run is chosen depends on nothing outside it, so passages
that two texts share have the same anchors wherever they stand. A fingerprint holds every anchor with
the place of its first word, in the order of the text: none is dropped, repeats are kept.

The n-th anchor with some hash in one text matches the n-th with that hash in the other. Likeness
is the part of both fingerprints' anchors that is matched, whatever the texts' lengths. Matches that follow each other at the same
distance of places form a passage: in a shared passage the next anchor is at most ``K - S`` places on.

Only DataFrame functions are used. Defined cases: null text counts as empty and has an empty
fingerprint; two empty fingerprints have likeness 1, an empty and a full one 0; documents with equal ids
follow each other by the hash of their text, null ids come last; equal rows share one result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.llm.common import SPACES, let
from abacist.session import materialise

K, S = 5, 2
TEXTS = ("text", "edited", "next")
MARK = "array<struct<hash:bigint,place:int>>"


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")


def fingerprint(symbols: Column) -> Column:
    """Hash and place of every closed syncmer, in the order of the text; fewer than ``K`` symbols make one anchor."""

    def chosen(hashes: Column) -> Column:
        def with_inner(inner: Column) -> Column:
            def one(i: Column) -> Column:
                at = [F.get(inner, i + j) for j in range(K - S + 1)]
                closed = (at[0] <= F.least(*at[1:])) | (at[-1] <= F.least(*at[:-1]))
                return F.when(closed, F.struct(F.xxhash64(*[F.get(hashes, i + j) for j in range(K)]).alias("hash"), i.alias("place")))

            places = F.sequence(F.lit(0), F.size(hashes) - K)
            return F.filter(F.transform(places, one), lambda x: x.isNotNull())

        next_ = F.slice(hashes, 2, F.size(hashes))
        inner = F.zip_with(hashes, next_, lambda a, b: F.xxhash64(a, b))
        whole = F.array(F.struct(F.xxhash64(hashes).alias("hash"), F.lit(0).alias("place")))
        short = F.when(F.size(hashes) > 0, whole).otherwise(F.array().cast(MARK))
        return F.when(F.size(hashes) < K, short).otherwise(let(inner, with_inner))

    return let(F.transform(symbols, lambda w: F.xxhash64(w)), chosen)


def as_text(mark: Column) -> Column:
    """24 hexadecimal digits for each anchor: 16 of its hash, 8 of its place."""
    return F.array_join(F.transform(mark, lambda x: F.concat(
        F.lpad(F.hex(x["hash"]), 16, "0"), F.lpad(F.hex(x["place"]), 8, "0"))), "")


def numbered(mark: Column, side: int) -> Column:
    """The anchors in the order of hashes; equal hashes are numbered in the order of the text."""

    def with_sorted(a: Column) -> Column:
        def with_starts(starts: Column) -> Column:
            ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(a)))
            nth = F.flatten(F.zip_with(starts, ends, lambda s, e: F.sequence(F.lit(0), e - s - 1)))
            return F.zip_with(a, nth, lambda x, n: F.struct(
                x["hash"].alias("hash"), n.alias("nth"), F.lit(side).alias("side"), x["place"].alias("place")))

        first = lambda x, i: (i == 0) | (x["hash"] != F.get(a, i - 1)["hash"])
        at = F.filter(F.transform(a, lambda x, i: F.when(first(x, i), i)), lambda i: i.isNotNull())
        none = F.array().cast("array<struct<hash:bigint,nth:int,side:int,place:int>>")
        return F.when(F.size(a) == 0, none).otherwise(let(at, with_starts))

    return let(F.sort_array(mark), with_sorted)


def matches(a: Column, b: Column) -> Column:
    """Matched anchors of two fingerprints: place in the first and distance to the place in the second, by place."""

    def paired(m: Column) -> Column:
        pair = F.zip_with(m, F.slice(m, 2, F.size(m)), lambda x, y: F.when(
            (x["hash"] == y["hash"]) & (x["nth"] == y["nth"]),
            F.struct(x["place"].alias("place"), (y["place"] - x["place"]).alias("shift"))))
        return F.sort_array(F.filter(pair, lambda p: p.isNotNull()))

    return let(F.sort_array(F.concat(numbered(a, 0), numbered(b, 1))), paired)


def likeness(a: Column, b: Column, matched: Column) -> Column:
    n = F.size(a) + F.size(b)
    return F.when(n == 0, F.lit(1.0)).otherwise(2 * F.size(matched) / n)


def passage(matched: Column, n_symbols: Column) -> Column:
    """Symbols of the longest passage in both texts: matches of equal shift, none more than ``K - S`` places on."""

    def turn(run: Column, m: Column) -> Column:
        goes_on = (m["shift"] == run["shift"]) & (m["place"] - run["place"] <= K - S)
        start = F.when(goes_on, run["start"]).otherwise(m["place"])
        return F.struct(m["place"].alias("place"), m["shift"].alias("shift"), start.alias("start"),
                        F.greatest(run["best"], m["place"] + K - start).alias("best"))

    none = F.struct(F.lit(-K).alias("place"), F.lit(0).alias("shift"), F.lit(0).alias("start"), F.lit(0).alias("best"))
    return F.least(F.aggregate(matched, none, turn, lambda run: run["best"]), n_symbols).cast("long")


def same(pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in pairs))


def neighbours(keys: DataFrame) -> DataFrame:
    """For each document the one before it in descending order of ids, in a circle: id and hash.

    Range partitions hold the order. Inside one the row before is a window's; a partition's first row
    follows the last row of the partition before, taken from a table with a row per partition.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]
    ranked = keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranked = materialise(ranked.withColumn("part", F.shiftright("at", 33)))
    row = F.struct("doc_id", "hash")
    parts = ranked.groupBy("part").agg(F.max_by(row, "at").alias("last"))
    every = Window.orderBy("part")
    final = F.last("last").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.lag("last").over(every), final).alias("edge"))
    inside = ranked.withColumn("before", F.lag(row).over(Window.partitionBy("part").orderBy("at")))
    joined = inside.join(parts, F.col("part") == F.col("p")).withColumn("to", F.coalesce("before", "edge"))
    return materialise(joined.select(
        F.col("doc_id").alias("own_id"), F.col("hash").alias("own_hash"), F.col("to.doc_id").alias("to_id"),
        F.col("to.hash").alias("to_hash"), "copies"))


def compared(both: DataFrame, one: str, other: str, name: str) -> DataFrame:
    """Add ``near_name`` and ``passage_name`` of two texts' fingerprints."""
    both = both.withColumn("__matched", matches(F.col(f"{one}_mark"), F.col(f"{other}_mark")))
    return both.withColumns({f"near_{name}": likeness(F.col(f"{one}_mark"), F.col(f"{other}_mark"), F.col("__matched")),
                             f"passage_{name}": passage(F.col("__matched"), F.size(f"{one}_words"))}).drop("__matched")


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose last third the next document's start replaces.

    Texts are shuffled once by their key; each is sent to the document before it in a second shuffle.
    Anchors are computed after it, as the hashes of a whole text take more room than the text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", text.alias("text")).withColumn("hash", F.xxhash64("text"))
    keys = rows.groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("copies"))
    links = neighbours(keys)
    if not links.where("copies > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "hash"])
    placed = rows.join(links, same([("doc_id", "own_id"), ("hash", "own_hash")]))
    given = placed.select("to_id", "to_hash", F.col("text").alias("next"))
    own = placed.select("doc_id", "hash", "text", "copies")
    both = own.join(given, same([("doc_id", "to_id"), ("hash", "to_hash")]))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - third), F.substr("next", F.lit(1), third))
    both = both.select("doc_id", "copies", n.cast("long").alias("n_chars"), "text", "next", edited.alias("edited"))
    both = both.withColumns({f"{t}_words": words(F.col(t)) for t in TEXTS})
    both = both.withColumns({f"{t}_mark": fingerprint(F.col(f"{t}_words")) for t in TEXTS})
    both = compared(compared(both, "text", "edited", "edited"), "text", "next", "next")
    out = both.select("doc_id", "copies", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      as_text(F.col("text_mark")).alias("fingerprint"), as_text(F.col("edited_mark")).alias("edited_fingerprint"),
                      "near_edited", "near_next", "passage_edited", "passage_next")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "copy")

"""Near-duplicate join on word 5-grams: MinHash candidates, Bayesian pruning, exact verification.

1. Every text becomes its set of hashed 5-grams. Texts with equal sets form a class; classes are what is
   compared from here on, so any number of copies costs one row.
2. A signature of ``BANDS * ROWS`` minima (one permutation, empty bins take the next full bin's value)
   is cut into bands. Classes that agree on a band meet in the smallest class of that bucket,
   never pair by pair: a class is joined to the smallest of its buckets' heads, and that one to the other heads.
   Connected components of these edges bound where links can be.
3. Components are compared in blocks: every pair of blocks is one task of bounded size. Within it
   signatures are compared ``STEP`` values at a time. After n values with m agreements the similarity has
   the posterior Beta(m + 1, n - m + 1) under a flat prior; a pair is dropped once the posterior
   probability of reaching the threshold is below ``TOLERANCE``. The rest is verified exactly on the sets.
4. A block task returns, per class, its number of linked documents and the smallest class it reaches,
   so no list of pairs is written. Components of those edges are the classes of near duplicates.

Large components are split by number of grams first: links need sets whose sizes differ by a factor of
at most the threshold, so only neighbouring size classes meet.

A pair at the threshold itself shares no band with probability (1 - 0.8^8)^64 = 8e-6, less above it.

Words are runs of characters other than white space, as they stand. Defined cases: a text of fewer
than five words has all its words as its one gram; texts without words (null, empty) are equal to nothing
and stay alone; rows with equal ids are counted as one document per row, null ids as unlinked rows.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import give_back, per_batch, per_slice
from abacist.llm.components import components
from abacist.llm.url_filter import BITS_PER_KEY, BROADCAST_BYTES, bit_of, block_of, bloom_filter
from abacist.llm.url_filter import WORDS as FILTER_WORDS
from abacist.session import materialise

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 64, 8
STEP = 16
COMPARED = 64
"""Independent minima for the incremental comparison, two bytes each."""
TOLERANCE = 1e-6
BLOCK_ROWS, BLOCK_GRAMS = 1024, 1 << 20
"""Classes and grams of one block; a single larger text stands alone."""
MIX = np.uint64(0x9E3779B97F4A7C15)
MOST_WORDS = 80_000
BINS = BANDS * ROWS
WALKS = np.random.default_rng(11).integers(0, BINS, (64, BINS))
MULTIPLIERS = np.random.default_rng(12).integers(0, 2**63, COMPARED, dtype="u8") * np.uint64(2) + np.uint64(1)


LARGE_TILE = 256
"""Classes of a tile after which a worker returns its memory."""


class WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        found = xxhash.xxh64_intdigest(word.encode())
        if len(word) <= 64:
            self[word] = found
        return found


HASHES = WordHash()


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the word 5-grams."""
    words = np.fromiter(map(HASHES.__getitem__, (text or "").split()), dtype="u8")
    n = min(WORDS, len(words))
    if not n:
        return words
    total = np.zeros(len(words) - n + 1, "u8")
    for i in range(n):
        total = total * MIX + words[i:len(words) - n + 1 + i]
    return np.unique(spread(total))


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum per bin of one random permutation; an empty bin takes the value of the first full bin on its
    own random walk, so equal sets have equal signatures and values stay spread over the bands."""
    bin_of = (found % np.uint64(BINS)).astype("i8")
    order = np.argsort(bin_of, kind="stable")  # grams are sorted, so each bin's first is its minimum
    full, first = np.unique(bin_of[order], return_index=True)
    values = np.zeros(BINS, "u8")
    values[full] = found[order[first]]
    filled = np.zeros(BINS, bool)
    filled[full] = True
    empty = np.flatnonzero(~filled)
    for walk in WALKS:
        if not len(empty):
            return values
        source = walk[empty]
        hit = filled[source]
        values[empty[hit]] = values[source[hit]]
        empty = empty[~hit]
    if len(empty):
        at = np.searchsorted(full, empty)
        values[empty] = values[full[np.where(at == len(full), 0, at)]]
    return values


def bands(values: np.ndarray) -> np.ndarray:
    """A hash per band, for a matrix with one signature per row."""
    cut = values.reshape(-1, BANDS, ROWS)
    total = np.zeros(cut.shape[:2], "u8")
    for i in range(ROWS):
        total = spread(total * MIX + cut[:, :, i])
    return spread(total + np.arange(BANDS, dtype="u8") * MIX).view("i8")


def compared(found: np.ndarray) -> bytes:
    """Two bytes of each of ``COMPARED`` independent minima."""
    least = np.concatenate([(found * m[:, None] + MIX).min(axis=1) for m in MULTIPLIERS.reshape(-1, STEP)])
    return (spread(least) & np.uint64(0xFFFF)).astype("u2").tobytes()


def sketched(texts: DataFrame) -> DataFrame:
    """(text_key, class_key, n_grams, signature, bands) of texts with words."""

    def run(batch: pa.RecordBatch) -> list:
        rows, values = [], []
        for key, text in zip(*(batch.column(c).to_pylist() for c in ("text_key", "text"))):
            found = grams(text)
            if len(found):
                values.append(signature(found))
                rows.append((key, xxhash.xxh128_hexdigest(found.tobytes()), len(found), compared(found)))
        HASHES.clear()
        return [*(list(c) for c in zip(*rows)), list(bands(np.stack(values)))] if rows else [[]] * 5

    return per_slice(texts, run, "text_key string, class_key string, n_grams long, signature binary, bands array<long>")


@lru_cache(maxsize=None)
def least_agreement(threshold: float) -> tuple[int, ...]:
    """Per number of compared values the least number of agreements that a pair must have to go on."""
    least = []
    for n in range(STEP, COMPARED + 1, STEP):
        m = 0
        # P(Beta(m+1, n-m+1) >= s) = P(Binomial(n+1, s) <= m)
        tail = (1 - threshold) ** (n + 1)
        while tail < TOLERANCE:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least.append(m)
    return tuple(least)


def links_between(left, right, threshold: float):
    """Index pairs of linked classes; each side is (sizes, signatures, grams), right may be left itself."""
    same = right is left
    sizes_l, signs_l, grams_l = left
    sizes_r, signs_r, grams_r = right
    for i in range(len(sizes_l)):
        begin = i + 1 if same else 0
        keep = np.flatnonzero((sizes_r[begin:] >= threshold * sizes_l[i] - 1e-9)
                              & (sizes_r[begin:] * threshold <= sizes_l[i] + 1e-9)) + begin
        agreed = np.zeros(len(keep), "i4")
        for step, least in enumerate(least_agreement(threshold)):
            if not len(keep):
                break
            part = slice(step * STEP, (step + 1) * STEP)
            agreed += (signs_r[keep, part] == signs_l[i, part]).sum(axis=1)
            keep, agreed = keep[agreed >= least], agreed[agreed >= least]
        if not len(keep):
            continue
        mine = grams_l[i]
        theirs = [grams_r[j] for j in keep]
        flat = np.concatenate(theirs)
        at = np.searchsorted(mine, flat)
        at[at == len(mine)] = 0
        common = np.add.reduceat((mine[at] == flat).astype("i8"), np.concatenate([[0], np.cumsum(sizes_r[keep])[:-1]]))
        linked = common >= threshold * (sizes_l[i] + sizes_r[keep] - common) - 1e-9
        yield i, keep[linked]


def side_of(rows: pd.DataFrame):
    sizes = rows["n_grams"].to_numpy("i8")
    signs = np.frombuffer(b"".join(rows["signature"]), "u2").reshape(-1, COMPARED)
    return sizes, signs, [np.frombuffer(g, "u8") for g in rows["grams"]]


def compare_block(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links inside one tile: per class the linked documents and the smallest class reached."""
    parts = [p.reset_index(drop=True) for _, p in rows.sort_values(["side", "node"]).groupby("side")]
    left, right = (parts[0], parts[-1])
    if rows["pair"].iloc[0] and len(parts) < 2:
        return pd.DataFrame({"node": [], "linked": [], "head": []})
    a = side_of(left)
    b = a if right is left else side_of(right)
    ids = np.concatenate([left["node"], right["node"]]) if b is not a else left["node"].to_numpy("i8")
    counts = np.concatenate([left["copies"], right["copies"]]) if b is not a else left["copies"].to_numpy("i8")
    shift = 0 if b is a else len(left)
    linked = np.zeros(len(ids), "i8")
    parent = np.arange(len(ids))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, found in links_between(a, b, threshold):
        found = found + shift
        linked[i] += counts[found].sum()
        linked[found] += counts[i]
        roots = {root(i), *(root(j) for j in np.unique(parent[found]).tolist())}
        parent[list(roots)] = min(roots, key=lambda r: ids[r])
    heads = ids[[root(x) for x in range(len(ids))]]
    keep = linked > 0
    return pd.DataFrame({"node": ids[keep], "linked": linked[keep], "head": heads[keep]})


def tiles(members: DataFrame) -> DataFrame:
    """Rows of the members for every block comparison they take part in: tile, pair, side."""
    size_class = F.floor(F.log(F.col("n_grams").cast("double")) / math.log(1 / THRESHOLD)).cast("long")
    totals = members.groupBy("component").agg(F.count(F.lit(1)).alias("rows_"), F.sum("n_grams").alias("grams_"))
    large = (F.col("rows_") > BLOCK_ROWS) | (F.col("grams_") > BLOCK_GRAMS)
    members = members.join(totals, "component").withColumn("level", F.when(large, size_class).otherwise(F.lit(-9))).drop("rows_", "grams_")
    blocks = members.groupBy("component", "level").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n_grams") / BLOCK_GRAMS)).cast("long").alias("blocks"))
    blocks = materialise(blocks)
    named = {"blocks_below": -1, "blocks_own": 0, "blocks_above": 1}
    for name, d in named.items():
        side = blocks.select(F.col("component").alias("c"), (F.col("level") - d).alias("l"), F.col("blocks").alias(name))
        members = members.join(side, (F.col("component") == F.col("c")) & (F.col("level") == F.col("l")), "left").drop("c", "l")
    own = F.pmod(F.xxhash64("node"), F.col("blocks_own"))
    none = F.array().cast("array<struct<level:long,a:long,other:long,b:long,side:int>>")

    def tile(level, a, other, b, side):
        return F.struct(level.alias("level"), a.alias("a"), other.alias("other"), b.alias("b"), side.cast("int").alias("side"))

    def with_level(column: str, make):
        steps = F.sequence(F.lit(0).cast("long"), F.col(column) - 1)
        return F.when(F.col(column).isNotNull(), F.transform(steps, make)).otherwise(none)

    level = F.col("level")
    inside = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks_own") - 1), lambda b: tile(
        level, F.least(F.col("own"), b), level, F.greatest(F.col("own"), b), F.when(F.col("own") <= b, 0).otherwise(1)))
    above = with_level("blocks_above", lambda b: tile(level, F.col("own"), level + 1, b, F.lit(0)))
    below = with_level("blocks_below", lambda a: tile(level - 1, a, level, F.col("own"), F.lit(1)))
    placed = members.withColumn("own", own).withColumn("t", F.explode(F.concat(inside, above, below)))
    return placed.select("component", "t.level", "t.a", "t.other", "t.b", "t.side", "node", "copies", "n_grams", "signature", "grams").withColumn(
        "pair", (F.col("level") != F.col("other")) | (F.col("a") != F.col("b")))


def asked(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Add ``__maybe``: whether a row's key passes a blocked Bloom filter of the keys, so that few rows are shuffled.

    Up to ``BROADCAST_BYTES`` of filter; beyond, every row may be a hit.
    """
    keys = keys.select(F.col(keys.columns[0]).alias("__bloom_key"))
    blocks = keys.count() * BITS_PER_KEY // (64 * FILTER_WORDS) + 1
    if blocks * (FILTER_WORDS + 1) * 8 > BROADCAST_BYTES:
        return rows.withColumn("__maybe", F.lit(True))
    bloom = F.broadcast(bloom_filter(keys, "__bloom_key", blocks))
    passes = reduce(lambda a, b: a & b, (F.col(f"w{i}").bitwiseAND(bit_of(F.col(key), i)) != 0 for i in range(FILTER_WORDS)))
    joined = rows.join(bloom, block_of(F.col(key), blocks) == F.col("__block"), "left")
    return joined.select(*rows.columns, F.coalesce(passes, F.lit(False)).alias("__maybe"))


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents' ``doc_id`` with ``text_key``, ``class_id`` (smallest id of the class of near duplicates) and ``n_links``.

    ``text_key`` is the text's digest; ``n_links`` counts all other documents at or above the threshold.
    """
    rows = documents.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_key"), "text")
    sketches = materialise(sketched(rows.select("text_key", "text")).dropDuplicates(["text_key"]))
    ids = materialise(rows.select("doc_id", "text_key"))
    counted = ids.where(F.col("doc_id").isNotNull()).groupBy("text_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"))
    texts = materialise(sketches.select("text_key", "class_key").join(counted, "text_key"))
    classes = texts.groupBy("class_key").agg(
        F.min("least").alias("least"), F.sum("n").alias("copies"), F.min("text_key").alias("text_key"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()))

    keyed = materialise(sketches.drop("class_key").join(classes.select("node", "copies", "text_key"), "text_key"))
    buckets = keyed.select("node", F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    own = buckets.join(heads, "band").groupBy("node").agg(F.sort_array(F.collect_set("head")).alias("heads"))  # at most BANDS
    first = F.col("heads")[0]
    pairs = F.transform(F.col("heads"), lambda h: F.struct(F.when(h == first, F.col("node")).otherwise(h).alias("a"), first.alias("b")))
    edges = own.select(F.explode(pairs).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
    bounded = components(edges).withColumnsRenamed({"node": "n", "root": "component"})
    members = materialise(keyed.drop("bands").join(bounded, F.col("node") == F.col("n")).drop("n"))

    def sets(batch: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame({"key": batch["text_key"], "grams": [grams(t).tobytes() for t in batch["text"]]})
        HASHES.clear()
        return found

    wanted = asked(rows.select("text_key", "text"), members.select("text_key"), "text_key").where("__maybe").drop("__maybe")
    # an inner join, since a semi join would be pushed below the filter; the members' keys are distinct
    wanted = wanted.join(members.select("text_key"), "text_key")
    gram_sets = per_batch(wanted, sets, "key string, grams binary").groupBy("key").agg(F.first("grams").alias("grams"))
    members = materialise(members.join(gram_sets, F.col("text_key") == F.col("key")).drop("key", "text_key"))
    tile = ["component", "level", "a", "other", "b"]
    def compare(part: pd.DataFrame) -> pd.DataFrame:
        found = compare_block(part, threshold)
        if len(part) >= LARGE_TILE:
            give_back()
        return found

    reached = materialise(tiles(members).repartition(*tile).groupBy(*tile).applyInPandas(
        compare, "node long, linked long, head long"))
    links = reached.groupBy(F.col("node").alias("l_node")).agg(F.sum("linked").alias("linked"))
    joined = components(reached.where(F.col("node") != F.col("head")).select(F.col("node").alias("a"), F.col("head").alias("b")))
    joined = joined.select(F.col("node").alias("j_node"), "root")
    rooted = classes.join(joined, F.col("node") == F.col("j_node"), "left").join(links, F.col("node") == F.col("l_node"), "left")
    rooted = materialise(rooted.select("class_key", "least", F.coalesce("root", "node").alias("root"),
                                       (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = rooted.groupBy("root").agg(F.min("least").alias("class_id"))
    final = rooted.join(named, "root").select("class_key", "class_id", "n_links")
    per_text = texts.join(final, "class_key").select(F.col("text_key").alias("key"), "class_id", "n_links")
    with_id = F.when(F.col("doc_id").isNotNull(), F.col("text_key"))
    return ids.join(per_text, with_id == F.col("key"), "left").select(
        "doc_id", "text_key", F.coalesce("class_id", "doc_id").alias("class_id"), F.col("class_id").isNotNull().alias("has_words"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class of near duplicates: the row with the smallest id, then the smallest
    digest of its text; of equal ones one. Rows without words or without id stay."""
    names = documents.columns
    found = near_duplicates(documents, threshold).where("has_words")
    best = F.struct("doc_id", "text_key")
    kept = found.groupBy("class_id").agg(F.min(best).alias("best")).select("best.*")
    per_row = found.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    kept = kept.select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_key"))
    marks = per_row.join(kept, (F.col("doc_id") == F.col("k_id")) & (F.col("text_key") == F.col("k_key")), "left").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("k_id").isNotNull().alias("__stays"), (F.col("n") > 1).alias("__again"))
    marks = materialise(marks.where(~F.col("__stays") | F.col("__again")))
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    row = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col("doc_id").alias("__doc"), key.alias("__text"))

    def without(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(right, (F.col("__doc") == F.col("__id")) & (F.col("__text") == F.col("__key")), how)

    row = asked(row, marks.select("__key"), "__text")
    out = row.where(~F.col("__maybe")).unionAll(without(row.where("__maybe"), marks, "left_anti"))
    again = marks.where("__stays")
    if not again.isEmpty():
        out = out.unionAll(without(row, again, "left_semi").dropDuplicates(["__doc", "__text"]))
    return out.select(*[F.col("__row").getField(c).alias(c) for c in names])

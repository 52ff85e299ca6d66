"""Judge urls by rules and by a list of canonical urls.

Rules with a host and a path come first, the longest that fits wins. Urls that no rule fits are blocked
if their canonical form is listed. A blocked Bloom filter of the list is asked first: one row of eight
64-bit words per block, a key sets one bit in every word of its block. Only possible hits go on to the
exact hash join with the list, which removes false positives. The filter is built by grouped
aggregation. It is sent to every task while its size, known from the key count, stays within
``BROADCAST_BYTES``; a larger one is joined by block number, where adaptive execution splits hot blocks.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule and is allowed;
equal rows are judged each; an empty list blocks nothing; other columns stay, whatever their names, but
``host``, ``path``, ``rule`` and ``verdict`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.session import materialise

BITS_PER_KEY = 16
WORDS = 8
BROADCAST_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
# Parameters that only say where a visitor came from.
TRACKING = r"(?:utm_[^=&]*|ref|gclid|fbclid)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host in lower case without ``www.``, path without closing slash, query without tracking fields."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_replace(F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")), rf"([?&]){TRACKING}=[^&]*", "$1")
    query = F.regexp_replace(F.regexp_replace(query, r"&{2,}", "&"), r"\?&", "?")
    return F.concat(host, path, F.regexp_replace(query, r"[?&]+$", ""))


def rule_of(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = rule.fits(host, path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bit_of(key: Column, word: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(key, F.lit(word)), F.lit(64)).cast("int"))


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row per block that has keys: the block's number and its eight words."""
    cols = [bit_of(F.col(key), i).alias(f"w{i}") for i in range(WORDS)]
    words = [F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]
    return keys.select(block_of(F.col(key), blocks).alias("__block"), *cols).groupBy("__block").agg(*words)


def judge(urls: DataFrame, listed: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict``; ``listed`` has one column of canonical urls."""
    keys = materialise(listed.toDF("key").where(F.col("key").isNotNull()).distinct())
    blocks = max(1, keys.count() * BITS_PER_KEY // (64 * WORDS) + 1)
    bloom = bloom_filter(keys, "key", blocks)
    if blocks * (WORDS + 1) * 8 <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)

    added = ["host", "path", "rule", "verdict"]
    kept = [c for c in urls.columns if c not in added]
    host, path = F.col("host"), F.col("path")
    name, verdict = rule_of(rules, host, path)
    # the caller's columns travel in one struct, so none can clash with the working columns
    parsed = urls.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row"), host_of(F.col(url)).alias("host"),
                         path_of(F.col(url)).alias("path"), canonical(F.col(url)).alias("__canonical"))
    judged = parsed.select("__row", host, path, name.alias("rule"), verdict.alias("verdict"), "__canonical")
    open_ = F.col("verdict").isNull()
    asked = judged.join(bloom, open_ & (block_of(F.col("__canonical"), blocks) == F.col("__block")), "left")
    possible = reduce(lambda a, b: a & b, (F.col(f"w{i}").bitwiseAND(bit_of(F.col("__canonical"), i)) != 0 for i in range(WORDS)))
    asked = asked.withColumn("__maybe", F.coalesce(possible, F.lit(False)))
    plain = [*[F.col("__row").getField(c).alias(c) for c in kept], host, path, F.col("rule")]
    sure = asked.where(~F.col("__maybe")).select(*plain, F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    exact = asked.where(F.col("__maybe")).join(keys, F.col("__canonical") == F.col("key"), "left")
    return sure.unionAll(exact.select(*plain, F.when(F.col("key").isNotNull(), "block").otherwise("allow").alias("verdict")))

"""Reversible line deduplication: sharded cuckoo filters in front of exact reference counts.

An index has three tables in the shared folder:

* ``postings``: one row per line that is long enough, in the order of the documents: digest of its key, document,
  place of the line, and whether it is the document's first line with that key;
* ``counts``: a ledger of (digest, number of documents); an insertion adds a segment, a deletion one with negative
  numbers, and the sum over a digest's rows is its exact reference count;
* ``filters``: per shard of the digests a cuckoo filter of those held by at least ``least`` documents. A change
  of the ledger inserts the digests that reach ``least`` and deletes those that fall below it, so an insertion followed
  by the deletion of the same documents leaves the filters' answers as they were.

To deduplicate, the postings are asked against the filters; only possible hits go to the exact join with the
counts, which removes false positives. Filters are sent to every task while their size stays within
``BROADCAST_BYTES``; beyond it all postings go to the exact join.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased; digests have 128 bits. Defined
cases: a null text counts as empty and has one empty line; rows with equal ids count as a document each, are all the
holder if theirs is the largest id, and are deleted together; null ids are below all others; other columns stay as
they are, whatever their names, except ``text``, ``n_lines`` and ``n_dropped``, which the result sets. A text of any
length is one row of the documents and of no other table. Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.llm.common import SLICE
from abacist.session import materialise

LEAST_CHARS, LEAST_DOCS = 20, 3
SPACE = b" \t\n\x0b\x0c\r"
SLOTS, LOAD, ROUNDS = 4, 0.8, 400
"""Places of a bucket, filling at which a filter is built anew, and rounds of moves before it is made larger."""
SHARDS, SHARD_KEYS = 16, 1 << 19
"""Shards at least, and digests a shard that make the shards more."""
BROADCAST_BYTES = 64 << 20
FILTER = "shard long, filter binary"


class Cuckoo:
    """A cuckoo filter of 64-bit numbers: 16-bit prints, two buckets of four places for each."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), "u2"))

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        made = cls.sized(len(keys))
        while not made.insert(keys):
            made = cls(np.zeros((2 * len(made.table), SLOTS), "u2"))
        return made

    @classmethod
    def read(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, "u2").reshape(-1, SLOTS).copy())

    def bytes(self) -> bytes:
        return self.table.tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First bucket and print of each key."""
        keys = keys.astype("u8")
        prints = np.maximum(keys >> np.uint64(48), np.uint64(1)).astype("u2")
        return (keys >> np.uint64(16) & np.uint64(len(self.table) - 1)).astype("i8"), prints

    def other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        mixed = prints.astype("u8") * np.uint64(0x5BD1E9955BD1E995)
        return bucket ^ ((mixed >> np.uint64(20)) & np.uint64(len(self.table) - 1)).astype("i8")

    def settle(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Put prints into free places of their buckets; True where one found a place."""
        order = np.argsort(bucket, kind="stable")
        sorted_ = bucket[order]
        turn = np.arange(len(order)) - np.searchsorted(sorted_, sorted_)
        free = self.table[sorted_] == 0
        fits = turn < free.sum(axis=1)
        rows = np.flatnonzero(fits)
        slot = (np.cumsum(free[rows], axis=1) == turn[rows, None] + 1).argmax(axis=1)
        self.table[sorted_[rows], slot] = prints[order[rows]]
        placed = np.zeros(len(order), bool)
        placed[order[rows]] = True
        return placed

    def insert(self, keys: np.ndarray) -> bool:
        """Add the keys; False if they do not all find a place (the filter is then of no more use)."""
        bucket, prints = self.places(keys)
        for attempt in range(ROUNDS):
            for _ in range(2):
                left = ~self.settle(bucket, prints)
                bucket, prints = bucket[left], prints[left]
                if not len(bucket):
                    return True
                bucket = self.other(bucket, prints)
            # one print of each full bucket gives way and goes on to its other bucket
            at, first = np.unique(bucket, return_index=True)
            slot = (attempt + at) % SLOTS
            out = self.table[at, slot].copy()
            self.table[at, slot] = prints[first]
            bucket[first], prints[first] = self.other(at, out), out
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        bucket, prints = self.places(keys)
        found = (self.table[bucket] == prints[:, None]).any(axis=1)
        return found | (self.table[self.other(bucket, prints)] == prints[:, None]).any(axis=1)

    def delete(self, keys: np.ndarray) -> None:
        """Take out one print for each key, all of which must have been inserted."""
        bucket, prints = self.places(keys)
        for at, mark in zip(bucket.tolist(), prints.tolist()):
            for b in (at, int(self.other(np.array([at]), np.array([mark], "u2"))[0])):
                held = np.flatnonzero(self.table[b] == mark)
                if len(held):
                    self.table[b, held[0]] = 0
                    break


def shard_of(shards: int):
    return F.pmod(F.col("lo"), F.lit(shards))


@dataclass(frozen=True)
class LineIndex:
    postings: DataFrame
    counts: tuple[DataFrame, ...]
    filters: DataFrame
    shards: int
    least: int

    @classmethod
    def empty(cls, spark: SparkSession, id_type: str = "bigint", least: int = LEAST_DOCS) -> LineIndex:
        postings = spark.createDataFrame([], posting_schema(id_type))
        return cls(postings, (), spark.createDataFrame([], FILTER), SHARDS, least)

    def totals(self) -> DataFrame:
        """(hi, lo, n): exact number of documents of every digest."""
        if not self.counts:
            return self.postings.sparkSession.createDataFrame([], "hi long, lo long, n long")
        if len(self.counts) == 1:
            return self.counts[0]
        return reduce(DataFrame.unionAll, self.counts).groupBy("hi", "lo").agg(F.sum("n").alias("n"))

    def repeated(self) -> DataFrame:
        return self.totals().where(F.col("n") >= self.least)

    def insert(self, documents: DataFrame) -> LineIndex:
        """The index with these documents added."""
        added = materialise(postings_of(documents))
        return self.changed(added, replace(self, postings=self.postings.unionAll(added)), 1)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents whose ``doc_id`` is among ``ids``."""
        ids = ids.select(F.col("doc_id").alias("__gone")).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("__gone"))
        removed = materialise(self.postings.join(ids, same, "left_semi"))
        return self.changed(removed, replace(self, postings=materialise(self.postings.join(ids, same, "left_anti"))), -1)

    def compact(self) -> LineIndex:
        """The same index with one segment of counts."""
        return replace(self, counts=(materialise(self.totals().where("n > 0")),))

    def changed(self, postings: DataFrame, after: LineIndex, sign: int) -> LineIndex:
        """Enter a change into the ledger, then insert into or delete from the filters what crosses ``least``."""
        segment = materialise(postings.where("first").groupBy("hi", "lo").agg((F.count(F.lit(1)) * sign).alias("n")))
        after = replace(after, counts=(*self.counts, segment))
        if self.counts:
            moved = segment.withColumnRenamed("n", "change").join(after.totals(), ["hi", "lo"])
            before = F.col("n") - F.col("change")
            crossing = moved.where((F.col("n") >= self.least) != (before >= self.least))
        else:
            crossing = after.repeated()
        crossing = materialise(crossing.select("lo"))
        shards = self.shards
        if sign > 0:
            while crossing.count() > shards * SHARD_KEYS:
                shards *= 2
        if shards > self.shards:
            return after.built(shards)
        return after.updated(crossing.withColumn("shard", shard_of(shards)), sign)

    def built(self, shards: int) -> LineIndex:
        """All filters made anew from the exact counts, dealt over so many shards."""
        return replace(self, filters=materialise(filters_of(self.repeated(), shards)), shards=shards)

    def updated(self, crossing: DataFrame, sign: int) -> LineIndex:
        """The filters with the crossing digests in or out; a shard that is too full is made anew from the counts."""

        def change(key, held: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            lo = keys["lo"].to_numpy("i8").view("u8")
            data = held["filter"].iloc[0] if len(held) else None
            if sign > 0 and data is None:
                data = Cuckoo.of(lo).bytes()
            elif len(lo):
                cuckoo = Cuckoo.read(data)
                if sign < 0:
                    cuckoo.delete(lo)
                room = cuckoo.table.size * LOAD - np.count_nonzero(cuckoo.table)
                fits = sign < 0 or len(lo) <= room and cuckoo.insert(lo)
                data = cuckoo.bytes() if fits else b""
            return pd.DataFrame({"shard": [key[0]], "filter": [data]})

        filters = materialise(self.filters.groupBy("shard").cogroup(crossing.groupBy("shard")).applyInPandas(change, FILTER))
        full = filters.where(F.length("filter") == 0).select("shard")
        if full.isEmpty():
            return replace(self, filters=filters)
        anew = filters_of(self.repeated(), self.shards, full)
        return replace(self, filters=materialise(filters.where(F.length("filter") > 0).unionAll(anew)))

    def possible(self) -> DataFrame:
        """Postings whose digest the filters know."""
        size = self.filters.agg(F.coalesce(F.sum(F.length("filter")), F.lit(0))).first()[0]
        if size > BROADCAST_BYTES:
            return self.postings
        tables = self.postings.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in self.filters.collect()})
        shards = self.shards

        def ask(batches):
            cuckoos = {s: Cuckoo.read(data) for s, data in tables.value.items()}
            for batch in batches:
                lo = batch.column("lo").to_numpy()
                found = np.zeros(len(lo), bool)
                for s, cuckoo in cuckoos.items():
                    mine = np.flatnonzero(lo % shards == s)
                    found[mine] = cuckoo.contains(lo[mine].view("u8"))
                yield batch.filter(pa.array(found))

        return self.postings.mapInArrow(ask, self.postings.schema)

    def dropped(self) -> DataFrame:
        """(doc_id, text_key, lines): places of the lines that go."""
        hits = materialise(self.possible().select("hi", "lo", "doc_id", "text_key", "line"))
        holder = hits.groupBy("hi", "lo").agg(F.max("doc_id").alias("holder"))
        holder = materialise(holder.join(self.repeated().select("hi", "lo"), ["hi", "lo"]))
        gone = hits.join(holder, ["hi", "lo"]).where(~F.col("doc_id").eqNullSafe(F.col("holder")))
        return gone.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("lines"))

    def deduplicate(self, documents: DataFrame) -> DataFrame:
        """Documents of the index without their repeated lines; sets ``text``, ``n_lines`` and ``n_dropped``."""
        set_ = ("text", "n_lines", "n_dropped")
        names = [c for c in documents.columns if c not in set_[1:]]
        row = F.struct(*[F.col(f"`{c}`") for c in names])
        text = F.coalesce(F.col("text"), F.lit(""))
        rows = documents.select(row.alias("__row"), F.col("doc_id").alias("__doc"), F.xxhash64(text).alias("__key"))
        gone = self.dropped().select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"), F.col("lines").alias("__gone"))
        joined = rows.join(gone, (F.col("__key") == F.col("__text")) & F.col("__doc").eqNullSafe(F.col("__id")), "left")
        lines = F.split(F.coalesce(F.col("__row.text"), F.lit("")), "\n")
        split = joined.select("__row", "__gone", F.when(F.col("__gone").isNotNull(), lines).alias("__lines"), F.size(lines).alias("__n"))
        stay = F.array_except(F.sequence(F.lit(0), F.col("__n") - 1), F.col("__gone"))
        kept = F.array_join(F.transform(stay, lambda i: F.col("__lines")[i]), "\n")
        kept = F.when(F.col("__gone").isNull(), F.col("__row.text")).otherwise(kept)
        return split.select(
            *[kept.alias(c) if c == "text" else F.col("__row").getField(c).alias(c) for c in names],
            F.col("__n").cast("long").alias("n_lines"), F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias("n_dropped"))


def posting_schema(id_type: str) -> str:
    return f"hi long, lo long, doc_id {id_type}, text_key long, line int, first boolean"


def keys_of(text: str | None) -> list[tuple[int, bytes]]:
    """Place and key of every line that is long enough."""
    found = []
    for i, line in enumerate((text or "").encode().lower().split(b"\n")):
        key = line.strip(SPACE)
        if len(key) >= LEAST_CHARS and (key.isascii() or len(key.decode()) >= LEAST_CHARS):
            found.append((i, key))
    return found


def postings_of(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = documents.select("doc_id", F.xxhash64(text).alias("text_key"), "text")
    schema = posting_schema(dict(documents.dtypes)["doc_id"])

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                rows, lines, digests, first = [], [], [], []
                for n, text in enumerate(batch.column("text").to_pylist()):
                    seen = set()
                    for i, key in keys_of(text):
                        digest = xxhash.xxh128_digest(key)
                        rows.append(n)
                        lines.append(i)
                        digests.append(digest)
                        first.append(digest not in seen)
                        seen.add(digest)
                both = np.frombuffer(b"".join(digests), ">i8").astype("i8").reshape(-1, 2)
                own = [batch.column(c).take(pa.array(rows, "int64")) for c in ("doc_id", "text_key")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0]), pa.array(both[:, 1]), *own, pa.array(lines, "int32"), pa.array(first, "bool")],
                    ["hi", "lo", "doc_id", "text_key", "line", "first"])

    return texts.mapInArrow(run, schema)


def filters_of(repeated: DataFrame, shards: int, only: DataFrame | None = None) -> DataFrame:
    """One filter per shard that has digests."""
    keys = repeated.select("lo", shard_of(shards).alias("shard"))
    if only is not None:
        keys = keys.join(F.broadcast(only), "shard", "left_semi")  # one row a shard

    def build(key, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [key[0]], "filter": [Cuckoo.of(rows["lo"].to_numpy("i8").view("u8")).bytes()]})

    return keys.groupBy("shard").applyInPandas(build, FILTER)


def dedup_lines(documents: DataFrame) -> DataFrame:
    """All documents through a new index: ``text`` without repeated lines, ``n_lines`` and ``n_dropped``."""
    index = LineIndex.empty(documents.sparkSession, dict(documents.dtypes)["doc_id"]).insert(documents)
    return index.deduplicate(documents)

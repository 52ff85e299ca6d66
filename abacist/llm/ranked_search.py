"""Ranked lexical search by the Best Position Algorithm over impact lists.

1. Every text becomes its number of terms and the counts of the terms that some item asks for. Document
   frequencies, the number of documents and of terms are grouped sums of these.
2. Documents are cut into shards of bounded size inside each task. A shard keeps, for each asked term, its
   documents in falling order of impact (weight times saturated count), and every item is searched in it:
   sorted accesses go down all lists of the item together; each new document is scored by direct accesses
   to the other lists, which also mark its places there as seen. The best position of a list is the end
   of the run of places seen from its top without a gap; the impacts right behind the best positions add
   up to the most that an unseen document can score. Best positions are never above the last places read,
   so this bound is at least as tight as theirs. The search stops when the bound is strictly below the
   kth score, so documents of equal score are never missed.
3. The best of every shard meet in one window per item; a shard sends at most k rows an item, so what meets
   grows with the number of shards; they are first cut to k per item and group of tasks.

Items are asked in blocks of ``BLOCK`` with all their terms, so what tasks hold of them is bounded.

Defined cases: null and empty texts have no terms, are not counted and never found; items without terms find
nothing; rows with equal ids are ranked each, null ids last; items with equal ids are searched each, and
rows of the same item id repeat; other columns are not read. A text of any length is counted whole in
one step of one task.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abacist.llm.common import SLICE
from abacist.session import materialise

K = 10
BLOCK = 2000
"""Items searched together; their terms go to every task."""
SHARD_ROWS, SHARD_POSTINGS = 16_384, 1 << 21
"""Documents and postings of a shard; a document is never split."""
DEPTH = 32
"""Places read from every list before the bound is looked at again; the step grows by half each time."""
GROUPS = 64
SCALE, PERCENT, LENGTH_SHARE = 1_000_000_000, 100, 75
# Fixed value: what separates terms, all ASCII characters but digits and letters.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").encode().lower().decode())


def counted(documents: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of documents with terms: the asked ones' numbers and counts."""
    known = documents.sparkSession.sparkContext.broadcast(vocabulary)
    id_type = dict(documents.dtypes)["doc_id"]

    def run(batches):
        number = known.value
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                rows, sizes, terms, tfs = [], [], [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    found = terms_of(text)
                    if found:
                        counts = Counter(found)
                        asked = [t for t in counts if t in number]
                        rows.append(i)
                        sizes.append(len(found))
                        terms.append([number[t] for t in asked])
                        tfs.append([counts[t] for t in asked])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, "int64")), pa.array(sizes, "int64"),
                     pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n long, terms array<int>, tfs array<long>")


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


class Shard:
    """Impact lists of one shard; documents are numbered in the order of their ids."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, -impact, term))
        doc, term, impact = doc[order], term[order], impact[order]
        cuts = np.flatnonzero(np.diff(term)) + 1
        starts = [0, *cuts] if len(term) else []
        self.lists = {}
        for a, b in zip(starts, [*cuts, len(term)]):
            by_doc = np.argsort(doc[a:b])
            self.lists[int(term[a])] = doc[a:b], impact[a:b], doc[a:b][by_doc], by_doc

    def search(self, item: dict[int, int], k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and documents of the k best with scores above 0, equal ones by number; documents scored."""
        lists = [(*self.lists[t], times) for t, times in item.items() if t in self.lists]
        seen = [np.zeros(len(docs) + 1, bool) for docs, *_ in lists]
        best = [0] * len(lists)
        known, all_scores = np.zeros(0, "i8"), np.zeros(0, "i8")
        depth, step, longest, total = 0, DEPTH, max((len(docs) for docs, *_ in lists), default=0), 0
        while depth < longest:
            new = np.setdiff1d(np.concatenate([docs[depth:depth + step] for docs, *_ in lists]), known)
            depth, step = depth + step, step * 3 // 2
            scores = np.zeros(len(new), "i8")
            for marks, (_, impacts, by_doc, places, times) in zip(seen, lists):
                at = np.minimum(np.searchsorted(by_doc, new), len(by_doc) - 1)
                held = by_doc[at] == new
                place = places[at[held]]
                scores[held] += times * impacts[place]
                marks[place] = True
            known, all_scores, total = np.concatenate([known, new]), np.concatenate([all_scores, scores]), total + len(new)
            kth = np.partition(all_scores, -k)[-k] if len(all_scores) >= k else 0
            bound = 0
            for i, (marks, (_, impacts, _, _, times)) in enumerate(zip(seen, lists)):
                best[i] += int(marks[best[i]:].argmin())  # the mark behind the last place is never set
                bound += times * int(impacts[best[i]]) if best[i] < len(impacts) else 0
            if bound < max(kth, 1):
                break
        order = np.lexsort((known, -all_scores))[:k]
        order = order[all_scores[order] > 0]
        return all_scores[order], known[order], total


def shards_of(batches):
    """Record batches joined or cut into shards."""
    held, rows, postings = [], 0, 0
    for batch in batches:
        start, sizes = 0, pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False)
        for i, size in enumerate(sizes):
            if rows and (rows >= SHARD_ROWS or postings + size > SHARD_POSTINGS):
                yield pa.Table.from_batches([*held, batch.slice(start, i - start)])
                held, rows, postings, start = [], 0, 0, i
            rows, postings = rows + 1, postings + int(size)
        held.append(batch.slice(start))
    if rows:
        yield pa.Table.from_batches(held)


def flat(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(column).to_numpy()


def searched(counts: DataFrame, items: list[dict[int, int]], weights: np.ndarray, n_documents: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): each shard's best documents of every item."""
    id_type = dict(counts.dtypes)["doc_id"]
    shared = counts.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches):
        items, weights = shared.value
        for table in shards_of(batches):
            ids = table.column("doc_id").combine_chunks()
            by_id = pc.array_sort_indices(ids, null_placement="at_end").to_numpy()
            number = np.empty(len(by_id), "i8")
            number[by_id] = np.arange(len(by_id))
            sizes = table.column("n").to_numpy()
            row = np.repeat(np.arange(len(sizes)), pc.list_value_length(table.column("terms")).to_numpy())
            term, tf = flat(table.column("terms")), flat(table.column("tfs"))
            length = PERCENT - LENGTH_SHARE + LENGTH_SHARE * sizes * n_documents // n_terms
            impact = weights[term] * (SCALE * tf // (1000 * tf + 8 * length[row]))
            asked = impact > 0
            shard = Shard(number[row[asked]], term[asked], impact[asked])
            found = [(i, *shard.search(item, k)) for i, item in enumerate(items)]
            item = np.repeat(np.arange(len(items), dtype="i4"), [len(scores) for _, scores, _, _ in found])
            score = np.concatenate([scores for _, scores, _, _ in found])
            doc = ids.take(pa.array(by_id[np.concatenate([docs for _, _, docs, _ in found])]))
            yield pa.RecordBatch.from_arrays([pa.array(item), doc, pa.array(score)], ["item", "doc_id", "score"])

    return counts.mapInArrow(run, f"item int, doc_id {id_type}, score long")


def best_of(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def blocks_of(rows: Iterator, size: int) -> Iterator[list]:
    while block := list(islice(rows, size)):
        yield block


def ranked(documents: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    id_type = dict(items.dtypes)["item_id"]
    schema = f"item_id {id_type}, rank int, doc_id {dict(documents.dtypes)['doc_id']}, score long"
    found = documents.sparkSession.createDataFrame([], schema)
    for asked in blocks_of(items.select("item_id", "text").toLocalIterator(), BLOCK):
        found = found.unionAll(ranked_block(documents, asked, id_type, k))
    return found


def ranked_block(documents: DataFrame, asked: list, id_type: str, k: int) -> DataFrame:
    spark = documents.sparkSession
    wanted = [Counter(terms_of(row["text"])) for row in asked]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    counts = materialise(counted(documents, vocabulary))
    n_documents, n_terms = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), "i8")
    for row in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the block's terms at most
        weights[row["term"]] = weight(n_documents, row["count"])
    numbers = [{vocabulary[t]: times for t, times in item.items()} for item in wanted]
    best = searched(counts, numbers, weights, n_documents, max(1, n_terms), k)
    best = best_of(best.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS))), ["item", "group"], k)
    best = best_of(best.drop("rank", "group"), ["item"], k)
    names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(asked)], f"number int, item_id {id_type}")
    return materialise(best.join(F.broadcast(names), F.col("item") == F.col("number")).select("item_id", "rank", "doc_id", "score"))

"""Spelling variants: the vocabulary's acceptor composed with a one-edit transducer and the acceptor again.

1. Texts become runs of letters, some of which lose a letter by a rule of their document, and these are counted.
2. Two words are near if exactly one code point is inserted, deleted or replaced. With m code points in the shorter
   one, the place of the edit (behind the longest common prefix) lies either in its first half, and then they share the
   second, or behind it, and they share the first. So the composition falls apart by initial states: a
   partition holds the words of m and m + 1 code points that share a half, and each near pair is accepted in exactly
   one. Partitions of more than ``PARTITION_ROWS`` words are split again in the same way, on the half of what is left in
   the middle, until they fit; a middle of one code point is bounded by the alphabet.
3. Within a partition the middles become two minimised acceptors over common states, one for the shorter words
   and one for the longer. States number their words, so a pair of words is a pair of numbers. Composition walks pairs
   of states: replacements meet in the intersection of two arcs' targets, insertions in that of a state with a
   target of the other acceptor, and results are kept per pair of states, so a shared ending is intersected once.
4. A partition returns one row per word: its near words and the most frequent one. No list of pairs is written.
5. Forms have at least twice their word's count, so chains of forms end; roots are found by pointer jumping.

Defined cases: null texts have no runs; runs of texts without id keep all letters; rows with equal ids count each;
other columns are not read; empty tables give no words. Words and texts of any length are taken whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.session import materialise

LEAST_CHARS, LEAST_COUNT = 5, 3
RATIO = 2
"""How many times a word's count its form must have."""
DELETED_OF = 97
RUN = re.compile("[a-zÀ-ÿ]+")
HELD_WORDS = 200_000
"""Counts that a task gathers before it passes them on."""
PARTITION_ROWS = 1 << 17


def delete_letter(doc_id, word: str, start: int) -> str:
    found = zlib.crc32(word.encode(), start)
    if found % DELETED_OF:
        return word
    at = found % len(word)
    return word[:at] + word[at + 1:]


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n) of the words with enough code points and occurrences."""

    def run(batches):
        totals: Counter = Counter()

        def out():
            words = pa.array(list(totals.keys()), "string")
            return pa.RecordBatch.from_arrays([words, pa.array(list(totals.values()), "int64")], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                runs = Counter(RUN.findall((text or "").encode().lower().decode()))
                if doc_id is not None:
                    start = zlib.crc32(f"{doc_id}:".encode())
                    for word in [w for w in runs if not zlib.crc32(w.encode(), start) % DELETED_OF]:
                        n = runs[word]
                        totals[delete_letter(doc_id, word, start)] += n
                        totals[word] -= n
                totals.update(runs)
                if len(totals) > HELD_WORDS:
                    yield out()
                    totals.clear()
        yield out()

    counted = documents.select("doc_id", "text").mapInArrow(run, "word string, n long")
    counted = counted.where((F.char_length("word") >= LEAST_CHARS) & (F.col("n") != 0))
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Acceptors:
    """Minimised acceptors of sorted lists of words, with common states.

    A state is its arcs {character: (target, number of its first word)}; targets come before their sources. Words of a
    state are numbered in order, the empty one first.
    """

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.ends: list[bool] = []
        self.size: list[int] = []
        self.common: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def state(self, end: bool, targets: list[tuple[str, int]]) -> int:
        key = end, *targets
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.arcs)
            arcs, n = {}, int(end)
            for c, target in targets:
                arcs[c] = target, n
                n += self.size[target]
            self.arcs.append(arcs)
            self.ends.append(end)
            self.size.append(n)
        return found

    def add(self, words: Iterable[str]) -> int:
        """The initial state of the words, which come sorted and once each."""
        ends, open_, before = [False], [[]], ""
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            for at in range(len(before), shared, -1):
                open_[-2].append((before[at - 1], self.state(ends.pop(), open_.pop())))
            for _ in range(len(word) - shared):
                ends.append(False)
                open_.append([])
            ends[-1] = True
            before = word
        for at in range(len(before), 0, -1):
            open_[-2].append((before[at - 1], self.state(ends.pop(), open_.pop())))
        return self.state(ends[0], open_[0])

    def shared(self, x: int, y: int) -> list[tuple[int, int]]:
        """Numbers of the words that two states have in common."""
        todo = [(x, y)]
        while todo:
            pair = todo[-1]
            if pair in self.common:
                todo.pop()
                continue
            x, y = pair
            if x == y:
                self.common[pair] = [(i, i) for i in range(self.size[x])]
                continue
            theirs = self.arcs[y]
            both = [(a, theirs[c]) for c, a in self.arcs[x].items() if c in theirs]
            missing = [(a[0], b[0]) for a, b in both if (a[0], b[0]) not in self.common]
            if missing:
                todo += missing
                continue
            found = [(0, 0)] if self.ends[x] and self.ends[y] else []
            for (a, i), (b, j) in both:
                found += [(i + k, j + l) for k, l in self.common[a, b]]
            self.common[pair] = found
        return self.common[pair]

    def replaced(self, start: int) -> list[tuple[int, int]]:
        """Pairs of one state's words that differ in one replaced character, each once."""
        found: dict[int, list] = {}
        for x in self.reached([start]):
            arcs = list(self.arcs[x].values())
            pairs = [(i + k, i + l) for a, i in arcs for k, l in found[a]]
            for n, (a, i) in enumerate(arcs):
                for b, j in arcs[n + 1:]:
                    pairs += [(i + k, j + l) for k, l in self.shared(a, b)]
            found[x] = pairs
        return found[start]

    def reached(self, starts: list[int]) -> list[int]:
        seen, todo = set(starts), list(starts)
        while todo:
            for target, _ in self.arcs[todo.pop()].values():
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
        return sorted(seen)

    def inserted(self, short: int, long: int, at_end: bool) -> list[tuple[int, int]]:
        """Pairs of a word of ``short`` and one of ``long`` that has one character more, each once.

        The character counts as inserted behind the longest common prefix, so it differs from the one that follows
        it; ``at_end`` says whether it may come behind the whole shorter word.
        """
        seen, todo = {(short, long)}, [(short, long)]
        while todo:
            x, y = todo.pop()
            theirs = self.arcs[y]
            for c, (a, _) in self.arcs[x].items():
                if c in theirs and (a, theirs[c][0]) not in seen:
                    seen.add((a, theirs[c][0]))
                    todo.append((a, theirs[c][0]))
        found: dict[tuple[int, int], list] = {}
        for x, y in sorted(seen):
            mine, theirs = self.arcs[x], self.arcs[y]
            pairs = []
            for c, (a, i) in mine.items():
                if c in theirs:
                    b, j = theirs[c]
                    pairs += [(i + k, j + l) for k, l in found[a, b]]
            for b, (target, j) in theirs.items():
                if at_end and self.ends[x] and self.ends[target]:
                    pairs.append((0, j))
                further = self.arcs[target]
                for c, (a, i) in mine.items():
                    if c != b and c in further:
                        last, first = further[c]
                        pairs += [(i + k, j + first + l) for k, l in self.shared(a, last)]
            found[x, y] = pairs
        return found[short, long]


def near_in(rows: list[tuple[str, int]], m: int, i: int, j: int, at_end: bool) -> list[tuple[str, int, int, str]]:
    """(word, near words, count and name of the most frequent near word) of one partition."""
    words = sorted(rows)
    short = [w for w in words if len(w[0]) == m]
    long = [w for w in words if len(w[0]) != m]
    if not short or len(words) < 2:
        return []
    acceptors = Acceptors()
    first = acceptors.add(w[i:m - j] for w, _ in short)
    pairs = [(short[a], short[b]) for a, b in acceptors.replaced(first)]
    if long:
        second = acceptors.add(w[i:m + 1 - j] for w, _ in long)
        pairs += [(short[a], long[b]) for a, b in acceptors.inserted(first, second, at_end)]
    near: Counter = Counter()
    best: dict[str, tuple[int, str]] = {}
    for a, b in pairs:
        for (word, _), (other, n) in ((a, b), (b, a)):
            near[word] += 1
            known = best.get(word)
            if known is None or n > known[0] or n == known[0] and other < known[1]:
                best[word] = n, other
    return [(word, near[word], *best[word]) for word in near]


def split(rows: DataFrame) -> DataFrame:
    """Each partition's rows in its two halves; ``i`` and ``j`` are the shared code points at both ends."""
    middle = F.col("m") - F.col("i") - F.col("j")
    half = F.floor(middle / 2).cast("int")
    sides = F.array(F.struct((F.col("i") + half).alias("i"), F.col("j"), F.col("at_end")),
                    F.struct(F.col("i"), (F.col("j") + middle - half).alias("j"), F.lit(False).alias("at_end")))
    rows = rows.withColumn("side", F.explode(sides)).select("word", "n", "m", "side.i", "side.j", "side.at_end")
    ends = F.substring("word", F.lit(1), F.col("i")), F.substring("word", F.char_length("word") - F.col("j") + 1, F.col("j"))
    return rows.withColumn("part", F.concat_ws(":", "m", "i", "j", F.col("at_end").cast("string"), *ends))


def partitioned(words: DataFrame, most: int) -> DataFrame:
    """Rows of the words for every partition they are in, none of which has more than ``most`` unless its middle is one
    code point."""
    chars = F.char_length("word")
    lengths = F.when(chars > LEAST_CHARS, F.array(chars, chars - 1)).otherwise(F.array(chars))
    rows = split(words.select("word", "n", F.explode(lengths).alias("m"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(True).alias("at_end")))
    done = []
    while True:
        large = rows.where(F.col("m") - F.col("i") - F.col("j") > 1).groupBy("part").count().where(F.col("count") > most)
        large = materialise(large.select("part"))
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows])
        done.append(rows.join(large, "part", "left_anti"))
        rows = split(rows.join(large, "part", "left_semi").drop("part"))


def near_words(words: DataFrame, most: int = PARTITION_ROWS) -> DataFrame:
    """(word, n_near, form_n, form): number of near words and the most frequent of them; words without any are left out."""

    def run(batches):
        part, held = None, []

        def found():
            m, i, j, at_end = part[1:]
            return near_in(held, m, i, j, at_end)

        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("part", "m", "i", "j", "at_end", "word", "n")]
            for *key, word, n in zip(*columns):
                if part is None or key[0] != part[0]:
                    if len(held) > 1:
                        out += found()
                    part, held = key, []
                held.append((word, n))
            yield batch_of(out)
        if len(held) > 1:
            yield batch_of(found())

    def batch_of(rows: list) -> pa.RecordBatch:
        word, near, n, form = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(word, "string"), pa.array(near, "int64"), pa.array(n, "int64"), pa.array(form, "string")],
                                          ["word", "near", "n", "form"])

    rows = partitioned(words, most).repartition("part").sortWithinPartitions("part")
    near = rows.mapInArrow(run, "word string, near long, n long, form string")
    best = F.min(F.struct((-F.col("n")).alias("n"), "form"))
    near = near.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return near.select("word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form")


def rooted(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each word's chain."""
    roots = materialise(links.select("word", F.col("form").alias("root")))
    while True:
        further = roots.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = materialise(roots.join(further, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def variants(documents: DataFrame, most: int = PARTITION_ROWS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents."""
    words = materialise(word_counts(documents))
    near = materialise(near_words(words, most))
    strong = F.col("form_n") >= RATIO * F.col("n")
    words = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("form")).alias("form"), F.when(strong, F.col("form_n")).alias("form_n"))
    words = materialise(words)
    roots = rooted(words.where(F.col("form").isNotNull()))
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Line deduplication, ranked search and spelling variants against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from abacist.llm import line_dedup, ranked_search, spelling

SCHEMA = "doc_id long, text string, n_lines string, key string, word string, n int, score double"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "k", "w", 1, 0.5) for i, t in zip(ids, texts)], SCHEMA)


# Lines

COMMON = "  The Same Long Line Again\t"
LINES = [None, "", "\n\n", COMMON, f"{COMMON}\nshort\n{COMMON.upper()}", f"a\n{COMMON.strip()}\n", "é" * 19, "é" * 20, f"x\n{'é' * 20}", f"\v{'é' * 20}\f\r\n",
         "z" * 30000 + "\n" + COMMON, "only here and nowhere else\n" * 5]


def plain_lines(rows):
    holders = defaultdict(list)
    key_of = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
    for i, text in rows:
        for key in {key_of(line) for line in (text or "").split("\n")}:
            if len(key) >= 20:
                holders[key].append(i)
    none_last = lambda i: (i is not None, i)
    last = {k: max(v, key=none_last) for k, v in holders.items() if len(v) >= 3}
    out = Counter()
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if key_of(line) not in last or last[key_of(line)] == i]
        out[(i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    return out


def digests(df):
    return Counter((r.doc_id, int(r.n_lines), r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in df.collect())


def test_lines_like_plain_python(spark):
    ids = [*range(len(LINES)), 3, None, None, 10**17 + 1]
    texts = [*LINES, f"{COMMON}\nother text of id three", f"{COMMON}\nno id", "é" * 20, "é" * 20 + "\n" + "last"]
    docs = frame(spark, texts, ids)
    out = line_dedup.dedup_lines(docs)
    assert digests(out) == plain_lines(list(zip(ids, texts)))
    assert out.columns == ["doc_id", "text", "key", "word", "n", "score", "n_lines", "n_dropped"]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_text_ids_stay_text(spark):
    docs = spark.createDataFrame([("a", COMMON), ("b", COMMON), ("c", COMMON)], "doc_id string, text string")
    assert {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(docs).collect()} == {"a": 1, "b": 1, "c": 0}


def test_insertions_and_deletions_are_reversible(spark):
    rng = random.Random(5)
    lines = [f"a line of some length, number {i}" for i in range(40)]
    texts = ["\n".join(rng.choices(lines, k=rng.randrange(6))) for _ in range(60)]
    rows = list(enumerate(texts))
    first, second, third = (frame(spark, [t for _, t in part], [i for i, _ in part]) for part in (rows[:25], rows[25:45], rows[45:]))
    empty = line_dedup.LineIndex.empty(spark)
    one = empty.insert(first)
    two = one.insert(second)
    all_ = two.insert(third)
    assert digests(all_.deduplicate(first.unionAll(second).unionAll(third))) == plain_lines(rows)
    back = all_.delete(third.select("doc_id"))
    assert digests(back.deduplicate(first.unionAll(second))) == plain_lines(rows[:45])
    known = lambda index: {(r.hi, r.lo) for r in index.repeated().collect()}
    assert known(back) == known(two) and known(back.compact()) == known(two)
    prints = lambda index: Counter(int(x) for r in index.filters.collect() for x in np.frombuffer(r["filter"], "u2") if x)
    assert prints(back) == prints(two)
    # the largest holder goes: the next one keeps the line
    gone = back.delete(second.select("doc_id"))
    assert digests(gone.deduplicate(first)) == plain_lines(rows[:25])
    assert prints(gone) == prints(one)
    assert prints(gone.delete(first.select("doc_id"))) == Counter()


def test_filters_made_larger_and_unsent(spark, monkeypatch):
    texts = [f"this line has the number {i // 3:08d}" for i in range(900)]
    docs = frame(spark, texts)
    expected = plain_lines(list(enumerate(texts)))
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 4)
    index = line_dedup.LineIndex.empty(spark).insert(docs.where("doc_id < 9")).insert(docs.where("doc_id >= 9"))
    assert index.shards > line_dedup.SHARDS and digests(index.deduplicate(docs)) == expected
    monkeypatch.undo()
    grown = line_dedup.LineIndex.empty(spark).insert(docs.where("doc_id < 300")).insert(docs.where("doc_id >= 300"))
    assert grown.possible().count() == 900 and digests(grown.deduplicate(docs)) == expected
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    assert digests(grown.deduplicate(docs)) == expected


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**31))
def test_cuckoo_filter_knows_what_it_holds(n, seed):
    rng = np.random.default_rng(seed)
    keys = rng.integers(0, 2**64, n, dtype="u8")
    held = line_dedup.Cuckoo.of(keys)
    assert held.contains(keys).all() and np.count_nonzero(held.table) == n
    out, stay = keys[: n // 2], keys[n // 2:]
    held.delete(out)
    assert held.contains(stay).all() and np.count_nonzero(held.table) == len(stay)
    assert held.contains(rng.integers(0, 2**64, 20000, dtype="u8")).mean() < 0.002
    again = line_dedup.Cuckoo.read(held.bytes())
    again.delete(stay)
    assert not again.table.any()


# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranking(documents, items):
    found = [(i, Counter(terms(t))) for i, t in documents]
    found = [(i, c) for i, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = Counter()
    for item, text in items:
        rows = []
        for i, c in found:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, times in Counter(terms(text)).items() if t in c)
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(rows, key=lambda r: r[:3])[:10]):
            out[(item, rank + 1, i, -score)] += 1
    return out


@pytest.fixture(scope="module")
def ranking_rows():
    rng = random.Random(2)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(20000)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(500)]
    texts += [texts[0]] * 40 + [None, "", "-- !!", "É é Éa", "w1 " * 5000, "W1.w2,W3"]
    documents = list(enumerate(texts)) + [(7, texts[7]), (None, texts[3]), (None, "w5 w9")]
    rng.shuffle(documents)
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(25)] + [(25, texts[0]), (25, "w1 w1 W2 é"), (None, "w5"), (30, None), (31, "unheard"), (32, "")]
    return documents, items


@pytest.mark.parametrize("rows, block", [(16384, 2000), (40, 7)])
def test_ranking_like_plain_python(spark, ranking_rows, monkeypatch, rows, block):
    monkeypatch.setattr(ranked_search, "SHARD_ROWS", rows)
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    monkeypatch.setattr(ranked_search, "DEPTH", 4)
    documents, items = ranking_rows
    docs = frame(spark, [t for _, t in documents], [i for i, _ in documents])
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(tuple(r) for r in ranked_search.ranked(docs, asked).collect())
    assert got == plain_ranking(documents, items)
    assert ranked_search.ranked(docs.limit(0), asked.limit(3)).count() == 0 and ranked_search.ranked(docs, asked.limit(0)).count() == 0


def test_search_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(4)
    n = 5000
    doc = np.concatenate([rng.permutation(n) for _ in range(3)])
    impact = np.concatenate([np.sort((rng.pareto(1.2, n) * 1000).astype("i8"))[::-1] for _ in range(3)])
    shard = ranked_search.Shard(doc, np.repeat(np.arange(3), n), impact)
    scores, docs, scored = shard.search({0: 1, 1: 2, 2: 1}, 10)
    full = np.zeros(n, "i8")
    np.add.at(full, doc, impact * np.repeat([1, 2, 1], n))
    best = np.lexsort((np.arange(n), -full))[:10]
    assert (docs == best).all() and (scores == full[best]).all() and scored < n / 2


# Spelling

ALPHABET = "abcé"


def plain_near(words):
    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) > len(b):
            a, b = b, a
        return any((a[:k] + a[k + 1:] if len(a) == len(b) else a) == b[:k] + b[k + 1:] and (len(a) < len(b) or a[:k] == b[:k]) for k in range(len(b)))

    out = {}
    for a, n in words.items():
        others = [(-m, b) for b, m in words.items() if near(a, b)]
        form = None
        if others and -min(others)[0] >= 2 * n:
            form = min(others)[1]
        out[a] = [len(others), form, words[form] if form else None]
    return out


def plain_variants(documents):
    words = Counter()
    for i, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}
    near = plain_near(words)
    out = Counter()
    for w, (n_near, form, form_n) in near.items():
        root = w
        while near[root][1]:
            root = near[root][1]
        out[(w, form, root, words[w], n_near, form_n)] += 1
    return out


@pytest.mark.parametrize("most", [1 << 17, 20])
def test_variants_like_plain_python(spark, most):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices(ALPHABET, k=rng.randrange(4, 9))) for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, weights=[1 + 500 // (k + 1) for k in range(400)], k=80)) for _ in range(150)]
    long = "x" * 20000
    texts += [None, "", "Éa ÉCOLE École ecole É" * 3, f"{long} {long}a, {long}", long, f"{long}a {long}a-b{long}", texts[0].upper(), "aaaaa aaaaa1aaaaaa " * 9]
    documents = list(enumerate(texts)) + [(5, texts[5]), (None, texts[6]), (None, "Aaaab aaaab aaaab")]
    docs = frame(spark, [t for _, t in documents], [i for i, _ in documents])
    got = Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs, most).collect())
    assert got == plain_variants(documents)


def test_no_words(spark):
    assert spelling.variants(frame(spark, [None, "", "a b c"])).count() == 0
    assert spelling.variants(frame(spark, ["a"]).limit(0)).count() == 0


def test_large_partitions_are_split(spark):
    rng = random.Random(3)
    words = sorted({"prefixed" + "".join(rng.choices("abcdef", k=4)) + "ending" for _ in range(800)})
    rows = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    parts = spelling.partitioned(rows, 100)
    assert parts.where("m - i - j > 1").groupBy("part").count().where("count > 100").isEmpty()
    got = {r.word: r.n_near for r in spelling.near_words(rows, 100).collect()}
    assert got == {w: n for w, (n, _, _) in plain_near(dict.fromkeys(words, 3)).items() if n}


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("ab", min_size=3, max_size=3)), st.sets(st.text("ab", min_size=4, max_size=4)))
def test_acceptors_pair_words_once(short, long):
    short, long = sorted(short), sorted(long)
    acceptors = spelling.Acceptors()
    first = acceptors.add(short)
    second = acceptors.add(long)
    differ = lambda a, b: sum(x != y for x, y in zip(a, b)) == 1
    replaced = Counter(frozenset((short[i], short[j])) for i, j in acceptors.replaced(first))
    assert replaced == Counter({frozenset((a, b)): 1 for a in short for b in short if differ(a, b)})
    inserted = Counter((short[i], long[j]) for i, j in acceptors.inserted(first, second, True))
    assert inserted == Counter({(a, b): 1 for a in short for b in long if any(b[:k] + b[k + 1:] == a for k in range(4))})

"""The secret scan against plain patterns, whole-text Viterbi, finite differences, and planted forms held out of training."""

import hashlib
import re

import numpy as np
import pytest

from abacist.llm import secrets

SF = "/root/testdata/sf0.01"
HELD_OUT = ("clientauth: {mixed}", "unlock_code: {smooth}", "vault-phrase = {smooth}", "conn_pw='{mixed}'", "x-signature={small}",
            "Credential = {mixed}")
PLAIN = (
    ("assign", re.compile(r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 1, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def field(documents):
    return secrets.fit(documents.where("doc_id % 2 = 0"))


@pytest.fixture(scope="module")
def unseen(documents):
    return [r.text or "" for r in documents.where("doc_id % 2 = 1").orderBy("doc_id").collect()]


def added(field, text):
    """Spans of the field in one text, in bytes."""
    found = []
    for _, _, tokens in secrets.scanned([text]):
        found += field.tagged(*tokens).get(0, [])
    return found


def test_base_spans_equal_plain_patterns_on_whole_documents(documents, field):
    got = {r.doc_id: r for r in secrets.scan(documents, field).collect()}
    for row in documents.collect():
        spans = sorted(
            (m.start(), order, m.end(), kind)
            for order, (kind, pattern, group, least) in enumerate(PLAIN)
            for m in pattern.finditer(row.text or "") if len(m[group]) >= least
        )
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert got[row.doc_id].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(got[row.doc_id].spans.split(","))


def test_the_field_finds_forms_it_was_not_taught(field, unseen):
    rng = np.random.default_rng(9)
    letters = list("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789")
    hits = total = strange = 0
    for text in unseen[:200]:
        for form in HELD_OUT:
            mixed = "".join(rng.choice(letters, 18))
            smooth = "".join(rng.choice(["purple", "window", "garden", "copper", "silent", "walnut"], 3))
            value = {"mixed": mixed, "small": mixed.lower(), "smooth": smooth}
            words = text.split(" ")
            at = int(rng.integers(len(words) + 1))
            whole = " ".join(words[:at] + [form.format(**value)] + words[at:]).encode()
            secret = next(v for k, v in value.items() if "{" + k + "}" in form).encode()
            place = whole.index(secret)
            spans = added(field, whole.decode())
            total += 1
            hits += any(a <= place and place + len(secret) <= b for a, b in spans)
            base = [s for _, bases, _ in secrets.scanned([whole.decode()]) for s in bases[0]]
            strange += sum(not (a < place + len(secret) and place < b) and not any(s[0] < b and a < s[2] for s in base) for a, b in spans)
    assert hits >= 0.8 * total  # recall
    assert hits >= 0.95 * (hits + strange)  # precision


def test_clean_documents_stay_clean(documents, field):
    rows = secrets.scan(documents.where("doc_id % 2 = 1"), field).collect()
    assert sum("crf:" in r.spans for r in rows) <= 0.01 * len(rows)


def test_stretches_give_the_best_path_of_whole_texts(unseen):
    rng = np.random.default_rng(3)
    texts = unseen[:20]
    text, first, last, features, *_ = secrets.tokens([t.encode() for t in texts])
    emit = rng.normal(size=(int(secrets.STARTS[-1]), 3))
    emit[:, 0] += 0.25
    step = rng.normal(size=(3, 3))
    step[secrets.O, secrets.I] = -1e9
    field = secrets.Field(emit, step, step[secrets.O])
    assert 0 < len(field.open_tokens(text, features)) < len(text)
    got = field.tagged(text, first, last, features)
    for t in range(len(texts)):
        mine = np.flatnonzero(text == t)
        spans = []
        for i, tag in zip(mine, field.viterbi(features[mine], step[:, secrets.O]) if len(mine) else []):
            if tag == secrets.B:
                spans.append([int(first[i]), int(last[i])])
            elif tag == secrets.I:
                spans[-1][1] = int(last[i])
        assert got.get(t, []) == spans


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    emit, step = rng.normal(size=(12, 3)), rng.normal(size=(3, 3))
    data = [(rng.integers(0, 12, size=(3, n, 4)), rng.integers(0, 3, size=(3, n))) for n in (1, 2, 5)]

    def brute():
        """Sum over every path of every sequence."""
        value = 0.0
        for features, tags in data:
            for sequence, path in zip(features, tags):
                def score(p):
                    whole = [0, *p, 0]
                    return sum(emit[f].sum(axis=0)[g] for f, g in zip(sequence, p)) + sum(step[a, b] for a, b in zip(whole, whole[1:]))
                value += score(path) - np.logaddexp.reduce([score(p) for p in np.ndindex(*[3] * len(path))])
        return value

    value, g_emit, g_step = secrets.likelihood(emit, step, data)
    assert value == pytest.approx(brute())
    for weights, gradient in ((emit, g_emit), (step, g_step)):
        for at in np.ndindex(*weights.shape):
            weights[at] += 1e-5
            high = brute()
            weights[at] -= 2e-5
            low = brute()
            weights[at] += 1e-5
            assert gradient[at] == pytest.approx((high - low) / 2e-5, abs=1e-6)


def test_word_buckets_do_not_depend_on_place_or_case():
    text, first, last, features, *_ = secrets.tokens([b"alpha Beta beta", b"", b"x y BETA alpha"])
    own = features[:, 2].tolist()
    assert own[1] == own[2] == own[5] and own[0] == own[6] and own[0] != own[1] and text.tolist() == [0, 0, 0, 2, 2, 2, 2]
    assert first.tolist() == [0, 6, 11, 0, 2, 4, 9] and last.tolist() == [5, 10, 15, 1, 3, 8, 14]


def test_defined_cases(spark, field):
    value = "Zq8vT1kLmN4pX7wB2c"
    texts = [None, "", " \n", "é日本🙂 " * 2000 + f"clientauth: {value}", "x" * 300000, f"clientauth: {value}", f"clientauth: {value}"]
    rows = [(f"d{i % 6}", t, "k") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id string, text string, spans string")
    got = secrets.scan(df, field).collect()
    assert len(got) == 7 and dict(secrets.scan(df, field).dtypes)["doc_id"] == "string"
    by = {r.doc_id: r.spans for r in got}
    assert by["d0"].startswith("crf:") and by["d1"] == by["d2"] == by["d4"] == "" and by["d5"] == "crf:12:30"
    assert by["d3"].endswith(f"crf:{10000 + 12}:{10000 + 30}")
    none = secrets.fit(df.limit(0))
    assert [r.spans for r in secrets.scan(df, none).collect()] == [""] * 7 and secrets.scan(df.limit(0), field).count() == 0

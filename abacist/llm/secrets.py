"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds spans.

Tokens are runs of letters, digits and ``+/_.-``; every token of every text is tagged begin, inside or outside
by Viterbi from its shape, its own word, the words before it, the signs between, and features of its file. A
stretch of tokens matters only if it can lead the all-outside path: sums of each token's best lead bound that
from above, found for all tokens by array operations, and tokens in no such stretch are outside on the best path.
They cut the chain exactly, so Viterbi runs on the stretches between them and the tags are those of whole texts.

The model is trained on windows of ``WINDOW`` tokens by gradient ascent of the regularised likelihood. Its labels are the
fixed patterns' own values and secrets planted into the sample's texts in forms that no pattern names, among
look-alikes that are none; words before a token are hidden at random, so that shapes must carry weight of their own.
The sample is bounded: texts of the ``TRAIN_ROWS`` documents with the smallest hash, of which at most ``TRAIN_WINDOWS``
windows with, and as many without, planted text or matches reach the driver, again those of smallest hash.

Defined cases: null text counts as empty; offsets are code points, ends exclusive; equal rows are scanned
each; extra columns are ignored; without a training row, as for an empty table, the field adds nothing.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import per_batch
from abacist.session import materialise

TRAIN_ROWS = 1000
TRAIN_WINDOWS = 2000
WINDOW = 24
HIDDEN = 0.2
"""Share of training tokens whose words before are hidden."""
CHUNK_BYTES = 1 << 20
KINDS = ("assign", "access", "hex", "crf")
# The base patterns, with the least length of group 2 or of the match.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KEYS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")


def members(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


LOWER, UPPER, DIGIT = (members(bytes(range(a, b + 1))) for a, b in ((97, 122), (65, 90), (48, 57)))
SIGN = members(b"+/_.-")
TOKEN = LOWER | UPPER | DIGIT | SIGN
HEXLIKE = members(b"0123456789abcdef")
ASSIGNS, QUOTES, BREAKS = members(b":="), members(b"\"'"), members(b"\n")
CLASS = np.select([LOWER, UPPER, DIGIT, SIGN], [1, 2, 3, 4], 0).astype("i1")
LOWERED = np.array([c + 32 if UPPER[c] else c for c in range(256)], "u8")

O, B, I = range(3)
LEAST = np.array([2, 4, 8, 12, 16, 20, 32, 64])
FORMS, LENGTHS, TURNS, WORDS, GAPS, FILES = 10, len(LEAST) + 1, 6, 1 << 12, 10, 4
SIZES = (FORMS * LENGTHS, TURNS * LENGTHS, WORDS, WORDS, WORDS, WORDS, GAPS * FORMS, GAPS, FORMS, FORMS, FILES)
STARTS = np.concatenate([[0], np.cumsum(SIZES)])
"""Each feature has its own range of weights: form and length, turns and length, own word, word before, its last letters, word
before that, sign before and form, sign after, form before, form after, file."""
BEFORE = slice(3, 6)
ODD = 0x9E3779B97F4A7C15
"""Odd multiplier of word hashes; its inverse modulo 2^64 lets any range be hashed from one running sum."""


def base_spans(data: bytes) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) of the fixed patterns, in bytes."""
    low = data.lower()
    spans = []
    if any(k in low for k in KEYS):
        spans += [(m.start(), 0, m.end(), *m.span(2)) for m in ASSIGN.finditer(data) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in data:
        spans += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(data) if len(m[0]) >= ACCESS_LEAST]
    return spans


def hex_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of hexadecimal digits, 16 or more."""
    starts, ends = runs(HEXLIKE[data])
    keep = ends - starts >= 16
    return starts[keep], ends[keep]


def runs(member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(member.view("i1"), prepend=0, append=0))
    return edge[::2], edge[1::2]


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, "u8")
    out[0] = 1
    return np.multiply.accumulate(out)


def bucket(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of lower-cased bytes of many ranges at once, 1 to ``WORDS`` - 1."""
    sums = np.zeros(len(codes) + 1, "u8")
    np.cumsum((LOWERED[codes] + np.uint64(1)) * powers(ODD, len(codes)), out=sums[1:])
    value = (sums[ends] - sums[begins]) * powers(pow(ODD, -1, 1 << 64), len(codes) + 1)[begins]
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return 1 + ((value >> np.uint64(32)) % np.uint64(WORDS - 1)).astype("i4")


def tokens(texts: list[bytes]):
    """All tokens of some texts: text, start, end (in the text) and features, one row a token; with the joined bytes."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    begins = np.concatenate([[0], ends[:-1]])
    codes = np.frombuffer(b"\n".join([*texts, b""]), "u1")
    first, last = runs(TOKEN[codes])
    text = np.searchsorted(ends, first, side="right")
    n = len(first)
    if not n:
        return text, first, last, np.zeros((0, len(SIZES)), "i4"), codes, begins, ends

    def count(member: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(member, dtype="i4")])

    lower, upper, digit, sign, hexes = (count(m[codes]) for m in (LOWER, UPPER, DIGIT, SIGN, HEXLIKE))
    nl, nu, nd, ns, nh = (c[last] - c[first] for c in (lower, upper, digit, sign, hexes))
    size = last - first
    letters = nl + nu
    form = np.select(
        [nd == size, (nh == size) & (nd > 0), (nu == 0) & (nl == size), (nu == 1) & (letters == size) & UPPER[codes[first]],
         nu == size, letters == size, (ns == 0) & (nu == 0), (ns == 0) & (nl == 0), ns == 0],
        list(range(9)), 9)
    length = np.searchsorted(LEAST, size, side="right")
    kinds = CLASS[codes]
    turn = count(np.concatenate([kinds[1:] != kinds[:-1], [False]]))
    turns = np.searchsorted([1, 2, 3, 5, 8], turn[last - 1] - turn[first], side="right")
    own = bucket(codes, first, last)
    tail = bucket(codes, np.maximum(first, last - 4), last)
    alone = np.concatenate([[True], text[1:] != text[:-1]])  # the first of its text

    def before(values: np.ndarray, none: int = 0) -> np.ndarray:
        return np.where(alone, none, np.concatenate([[none], values[:-1]]))

    word, ending = before(own), before(tail)
    # what stands between a token and the one before it: 0 the text's edge, else 1 plus signs seen; 9 for other characters
    previous = np.where(alone, begins[text], np.concatenate([[0], last[:-1]]))
    signs = [np.minimum(c[first] - c[previous], 1) for c in (count(m[codes]) for m in (ASSIGNS, QUOTES, BREAKS))]
    plain = count((codes == 32) | ASSIGNS[codes] | QUOTES[codes] | BREAKS[codes])
    strange = (plain[first] - plain[previous] < first - previous) & (signs[0] == 0)
    gap = np.where(alone, 0, np.where(strange, 9, 1 + signs[0] + 2 * signs[1] + 4 * signs[2]))
    behind = np.concatenate([~alone[1:], [False]])

    def after(values: np.ndarray, none: int = 0) -> np.ndarray:
        return np.where(behind, np.concatenate([values[1:], [none]]), none)

    length_of = ends - 1 - begins
    share = (digit[ends - 1] - digit[begins]) / np.maximum(1, length_of)
    file = 2 * (length_of >= 400) + (share >= 0.02)
    values = [form * LENGTHS + length, turns * LENGTHS + length, own, word, ending, before(word), gap * FORMS + form, after(gap),
              before(form), after(form), file[text]]
    features = np.stack(values, axis=1).astype("i4") + STARTS[:-1].astype("i4")
    return text, first - begins[text], last - begins[text], features, codes, begins, ends


def chunks(texts: list[str | None]):
    """Groups of encoded texts of bounded size; a longer text stands alone."""
    group, size = [], 0
    for text in texts:
        data = (text or "").encode()
        if group and size + len(data) > CHUNK_BYTES:
            yield group
            group, size = [], 0
        group.append(data)
        size += len(data)
    if group:
        yield group


def scanned(texts: list[str | None]):
    """Groups of texts: their bytes, base spans of each, and all their tokens with (text, start, end, features)."""
    for group in chunks(texts):
        text, first, last, features, codes, begins, ends = tokens(group)
        starts, stops = hex_spans(codes)
        owner = np.searchsorted(ends, starts, side="right")
        hexes: dict[int, list] = {}
        for t, a, b in zip(owner.tolist(), starts.tolist(), stops.tolist()):
            a, b = a - int(begins[t]), b - int(begins[t])
            hexes.setdefault(t, []).append((a, 2, b, a, b))
        yield group, [sorted(base_spans(data) + hexes.get(t, [])) for t, data in enumerate(group)], (text, first, last, features)


class Field:
    """Weights of the chain: one per feature and tag, one per pair of neighbouring tags. A text's edges count as outside."""

    def __init__(self, emit: np.ndarray, step: np.ndarray, start: np.ndarray):
        self.emit, self.step, self.start = emit, step, start

    def viterbi(self, sequence: list[list[int]], end: np.ndarray | None = None) -> list[int]:
        score = self.start + self.emit[sequence[0]].sum(axis=0)
        back = []
        for features in sequence[1:]:
            options = score[:, None] + self.step
            back.append(options.argmax(axis=0))
            score = options.max(axis=0) + self.emit[features].sum(axis=0)
        tags = [int((score if end is None else score + end).argmax())]
        for choice in reversed(back):
            tags.append(int(choice[tags[-1]]))
        return tags[::-1]

    def open_tokens(self, text: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Tokens that the best path may tag as part of a secret; all others are outside on it."""
        local = self.emit[features[:, 0]].copy()
        for k in range(1, features.shape[1]):
            local += self.emit[features[:, k]]
        rest = self.step[O, O]
        inner = self.step[1:, 1:].max() - rest
        edge = self.step[O, 1:].max() + self.step[1:, O].max() - 2 * rest - inner
        lead = local[:, 1:].max(axis=1) - local[:, O] + inner
        # the best stretch through a token ends with its best prefix and starts with its best suffix
        lead = np.maximum(lead, -1e3)
        total = np.cumsum(np.where(np.concatenate([[False], text[1:] != text[:-1]]), lead - 1e4, lead))
        best = np.maximum.accumulate(total[::-1])[::-1] - np.minimum.accumulate(total - lead)
        return np.flatnonzero(best + edge > -1e-6)

    def tagged(self, text: np.ndarray, first: np.ndarray, last: np.ndarray, features: np.ndarray) -> dict[int, list[list[int]]]:
        """Per text the (start, end) of tagged spans."""
        found: dict[int, list[list[int]]] = {}
        if not len(text):
            return found
        at = self.open_tokens(text, features)
        cuts = np.flatnonzero((np.diff(at) > 1) | (np.diff(text[at]) > 0)) + 1
        for stretch in np.split(at, cuts):
            if not len(stretch):
                continue
            for i, tag in zip(stretch.tolist(), self.viterbi(features[stretch], self.step[:, O])):
                spans = found.setdefault(int(text[i]), [])
                if tag == B:
                    spans.append([int(first[i]), int(last[i])])
                elif tag == I:
                    spans[-1][1] = int(last[i])
        return found


def untrained() -> Field:
    step = np.zeros((3, 3))
    step[O, B:] = -1e3
    step[O, I] = -1e9
    return Field(np.zeros((int(STARTS[-1]), 3)), step, step[O])


def likelihood(emit: np.ndarray, step: np.ndarray, data: list[tuple[np.ndarray, np.ndarray]]):
    """Log-likelihood of tagged sequences, grouped by length, and its gradients; the tag before and after each is outside."""
    value, g_emit, g_step = 0.0, np.zeros_like(emit), np.zeros_like(step)
    high = step.max()
    move = np.exp(step - high)
    for features, tags in data:
        n, length, width = features.shape
        local = emit[features].sum(axis=2)
        top = local.max(axis=2, keepdims=True)
        weight = np.exp(local - top)
        fore, scale, aft = np.empty((n, length, 3)), np.empty((n, length)), np.empty((n, length, 3))
        for t in range(length):
            now = (move[O] if t == 0 else fore[:, t - 1] @ move) * weight[:, t]
            scale[:, t] = now.sum(axis=1)
            fore[:, t] = now / scale[:, t, None]
        aft[:, -1] = move[:, O]
        for t in range(length - 2, -1, -1):
            aft[:, t] = (weight[:, t + 1] * aft[:, t + 1]) @ move.T / scale[:, t + 1, None]
        last = (fore[:, -1] * aft[:, -1]).sum(axis=1)
        norm = np.log(scale).sum(axis=1) + np.log(last) + top.sum(axis=(1, 2)) + (length + 1) * high
        path = np.concatenate([np.zeros((n, 1), int), tags, np.zeros((n, 1), int)], axis=1)
        value += np.take_along_axis(local, tags[:, :, None], 2).sum() + step[path[:, :-1], path[:, 1:]].sum() - norm.sum()
        chance = fore * aft / last[:, None, None]
        gap = (np.eye(3)[tags] - chance).reshape(-1, 3)
        flat = features.reshape(-1)
        for k in range(3):
            g_emit[:, k] += np.bincount(flat, np.repeat(gap[:, k], width), len(emit))
        np.add.at(g_step, (path[:, :-1], path[:, 1:]), 1.0)
        g_step[O] -= chance[:, 0].sum(axis=0)
        g_step[:, O] -= chance[:, -1].sum(axis=0)
        for t in range(1, length):
            ahead = weight[:, t] * aft[:, t] / (scale[:, t] * last)[:, None]
            g_step -= move * (fore[:, t - 1].T @ ahead)
    return value, g_emit, g_step


def train(examples: list[tuple[list[list[int]], list[int]]], steps: int = 120, rate: float = 0.5, ridge: float = 2e-5) -> Field:
    """Gradient ascent of the mean log-likelihood, all sequences of a length at once."""
    if not examples:
        return untrained()
    groups: dict[int, list] = {}
    for sequence, tags in examples:
        groups.setdefault(len(sequence), []).append((sequence, tags))
    data = [(np.array([s for s, _ in g]), np.array([t for _, t in g])) for _, g in sorted(groups.items())]
    total = sum(tags.size for _, tags in data)
    emit, step = np.zeros((int(STARTS[-1]), 3)), np.zeros((3, 3))
    step[O, I] = -1e9
    past = [np.zeros_like(emit), np.zeros_like(step)]
    for _ in range(steps):
        _, g_emit, g_step = likelihood(emit, step, data)
        for weights, gradient, seen in zip((emit, step), (g_emit, g_step), past):
            gradient = gradient / total - ridge * np.maximum(weights, -50)
            seen += gradient * gradient
            weights += rate * gradient / (np.sqrt(seen) + 1e-8)
        step[O, I] = -1e9
    return Field(emit, step, step[O])


# Names and words from which the training forms are put together.
NAMES = ("password", "passphrase", "pwd", "pass", "auth", "credentials", "client_secret", "private_key", "access_token", "bearer",
         "login", "pin", "key", "signature", "apikey", "passcode", "session_id", "auth_token", "db_pass", "encryption_key", "secret")
HARMLESS = ("version", "date", "page", "total", "name", "id", "ref", "phone", "order", "status", "title", "note", "key", "see", "call")
SIGNS_BETWEEN = (": ", "=", " = ", ":", '="', "='", ': "', " is ", " := ", " ")
SMALL, CAPITAL, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SYLLABLES = ("bra", "cor", "del", "ech", "fox", "gol", "hun", "ind", "jul", "kil", "lim", "mor", "nov", "osc", "pap", "que", "rom",
             "sie", "tan", "uni", "vic", "whi", "yan", "zul", "ter", "ho", "rse", "bat", "sta", "ple", "ta", "ver")


def planted(rng: np.random.Generator, words: list[str]) -> tuple[str, str, str]:
    """A secret or a look-alike: what stands before it, the secret (empty for a look-alike), and what stands after."""

    def draw(alphabet: str, low: int, high: int) -> str:
        return "".join(rng.choice(list(alphabet), int(rng.integers(low, high))))

    def one(options) -> str:
        return str(options[int(rng.integers(len(options)))])

    def smooth() -> str:
        return "".join(one(SYLLABLES) for _ in range(int(rng.integers(3, 7))))

    if rng.random() < 0.5:
        dates = f"{rng.integers(1990, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
        other = one([
            dates, draw(DIGITS, 1, 12), "v" + ".".join(draw(DIGITS, 1, 3) for _ in range(3)), draw(DIGITS, 16, 17),
            "+1-" + draw(DIGITS, 3, 4) + "-" + draw(DIGITS, 7, 8), one(words) + "." + one(words) + "/" + draw(DIGITS, 1, 4),
            one(words) + "-" + one(words), draw(CAPITAL, 2, 3) + draw(DIGITS, 14, 22), draw(DIGITS, 3, 4) + "." + draw(DIGITS, 1, 4),
            ".".join(draw(DIGITS, 1, 4) for _ in range(4)), one(words), one(words) + " " + one(words), one(words) + draw(DIGITS, 1, 3),
            one(words) + "@" + one(words) + ".com",
        ])
        return one([*HARMLESS, *NAMES, one(words)]) + one(SIGNS_BETWEEN) if rng.random() < 0.7 else "", "", other
    strong = one([
        draw(SMALL + CAPITAL + DIGITS, 14, 44), draw(SMALL + DIGITS, 14, 40), draw(CAPITAL + DIGITS, 16, 40),
        one(("sk", "pk", "ghp", "xox", "rk")) + "_" + draw(SMALL + CAPITAL + DIGITS, 16, 40), draw(SMALL + CAPITAL + DIGITS + "+/", 24, 60),
        "-".join(draw("0123456789abcdef", n, n + 1) for n in (8, 4, 4, 4, 12)),
        ".".join(draw(SMALL + CAPITAL + DIGITS + "-", 12, 40) for _ in range(3)),
    ])
    style = rng.random()
    if style < 0.6:
        name = one(NAMES) if rng.random() < 0.6 else one(words) if rng.random() < 0.5 else draw(SMALL, 3, 9)
        name = name.upper() if rng.random() < 0.2 else one((name, "client_" + name, "my" + name, name + "_prod"))
        return name + one(SIGNS_BETWEEN), strong, ""
    if style < 0.9:
        weak = smooth() if rng.random() < 0.6 else draw(SMALL, 10, 20) if rng.random() < 0.5 else smooth() + draw(DIGITS, 1, 5)
        name = one(NAMES)
        name = name.upper() if rng.random() < 0.3 else one((name, "user_" + name, "PRIVATE_" + name.upper(), name + " "))
        return name.strip() + one(SIGNS_BETWEEN[:7] if rng.random() < 0.8 else (" ",)), weak, ""
    lines = "\n".join(draw(SMALL + CAPITAL + DIGITS + "+/", 60, 65) for _ in range(int(rng.integers(2, 5))))
    return "-----BEGIN PRIVATE KEY-----\n", lines, "\n-----END PRIVATE KEY-----"


def plant(text: str, rng: np.random.Generator, maker=planted, every: int = 60) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]]]:
    """The text with made-up secrets and look-alikes between its words; byte ranges of the secrets, and of all that was put in."""
    words = [w for w in re.findall(r"[A-Za-z]{2,}", text)] or ["and"]
    parts = re.split(r"( +)", text)
    out, size, secrets, all_ = [], 0, [], []
    for part in parts:
        out.append(part)
        size += len(part.encode())
        if not part.isspace() and rng.random() < 2 / every:
            before, secret, after = maker(rng, words)
            piece = [" ", before, secret, after, one_of(rng, ("", '"', "'", ",", ".", "\n"))]
            begin = size + 1 + len(before.encode())
            if secret:
                secrets.append((begin, begin + len(secret.encode())))
            all_.append((size + 1, size + len("".join(piece).encode())))
            out += piece
            size += len("".join(piece).encode())
    return "".join(out), secrets, all_


def one_of(rng: np.random.Generator, options: tuple) -> str:
    return options[int(rng.integers(len(options)))]


def labelled(base: list[tuple], put: list[tuple[int, int]], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Tags of a text's tokens: begin at the first token of a value, inside at its later ones. Numbers of digits alone are
    not taught as secrets, whatever pattern takes them."""
    tags = np.zeros(len(first), int)
    for a, b in [*put, *((s[3], s[4]) for s in base)]:
        inside = np.flatnonzero((first < b) & (a < last))
        if len(inside):
            tags[inside] = I
            tags[inside[0]] = B
    return tags


def windows(text: str | None) -> list[tuple[int, bool, np.ndarray, np.ndarray]]:
    """Training windows of one text: hash, whether something was planted or matched in it, features and tags."""
    seed = zlib.crc32((text or "").encode())
    rng = np.random.default_rng(seed)
    changed, secrets, put = plant(text or "", rng)
    out = []
    for group, bases, (_, first, last, features) in scanned([changed]):
        base = [s for s in bases[0] if not group[0][s[3]:s[4]].isdigit()]
        tags = labelled(base, secrets, first, last)
        marked = tags > 0
        for a, b in put:
            marked |= (first < b) & (a < last)
        hidden = rng.random(len(first)) < HIDDEN
        features[hidden, BEFORE] = STARTS[:-1][BEFORE]
        for i in range(0, len(first), WINDOW):
            part = features[i:i + WINDOW]
            cut = tags[i:i + WINDOW].copy()
            if cut[0] == I:
                cut[0] = B
            out.append((zlib.crc32(part.tobytes(), seed), bool(marked[i:i + WINDOW].any()), part.ravel(), cut))
    return out


def fit(documents: DataFrame, rows: int = TRAIN_ROWS, most: int = TRAIN_WINDOWS) -> Field:
    """Train on windows of at most ``rows`` documents, those with the smallest hash of their id; at most ``most`` windows
    with, and as many without, planted text or matches: those with the smallest hash."""
    mark = F.xxhash64("doc_id")
    edge = documents.select(mark.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if edge is None:
        return untrained()

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        found = [w for text in batch["text"].tolist() for w in windows(text)]
        return pd.DataFrame(found, columns=["h", "marked", "features", "tags"])

    sample = documents.where(mark <= edge).select("text").distinct()
    made = materialise(per_batch(sample, run, "h long, marked boolean, features array<int>, tags array<int>"))
    examples = []
    for marked in (True, False):
        kept = made.where(F.col("marked") == marked).orderBy("h", "features", "tags").limit(most).collect()
        examples += [(np.array(r.features).reshape(len(r.tags), len(SIZES)), r.tags) for r in kept]
    return train(examples)


def code_points(data: bytes, offsets: list[int]) -> list[int]:
    """Characters before each byte offset; offsets lie between characters."""
    if data.isascii():
        return offsets
    marks = np.flatnonzero((np.frombuffer(data, "u1") & 0xC0) == 0x80)
    return (np.array(offsets) - np.searchsorted(marks, offsets)).tolist()


def scan(documents: DataFrame, field: Field) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, and all spans."""

    def joined(data: bytes, spans: list[tuple]) -> str:
        points = code_points(data, [x for s in spans for x in (s[0], s[2])])
        return ",".join(f"{KINDS[s[1]]}:{a}:{b}" for s, a, b in zip(spans, points[::2], points[1::2]))

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for group, bases, found in scanned(batch["text"].tolist()):
            added = field.tagged(*found)
            for t, data in enumerate(group):
                base = [s[:3] for s in bases[t]]
                kinds = [s[1] for s in base]
                more = [(a, 3, b) for a, b in added.get(t, []) if not any(s[0] < b and a < s[2] for s in base)]
                every = sorted(base + more)
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(joined(data, base).encode()).hexdigest(), joined(data, every)))
        out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
        out.insert(0, "doc_id", batch["doc_id"].to_numpy())
        return out

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return per_batch(documents.select("doc_id", "text"), run,
                     f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")

"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

A list of tokens is what the merges give for its bytes exactly when every two neighbours are (the merges
give the same two tokens for their joined bytes). So encoding is a path search: walk the trie of the
tokens, and wherever a token ends that may follow the one before, also begin a new one. The transducer
follows all such paths at once. A state holds each path's last token and its place in the trie; the
moves of the bytes whose tokens are not certain yet are kept beside it. Where all paths come from one and
more than ``LOOKAHEAD`` bytes are kept, that one's tokens are read back and emitted. Paths die after at most the
length of the longest token, which bounds what is kept. States and steps are made when a text first needs them
and kept up to half of ``MOST_WORDS``, then dropped and made anew.

Decoding joins the tokens' bytes chunk by chunk and turns them into text with an incremental UTF-8
decoder, which carries the bytes of an unfinished character to the next chunk.

Defined cases: null text counts as empty and has no tokens; special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from abacist.llm.common import per_batch, per_slice

MOST_WORDS = 200_000
"""Remembered short texts with their ids; the transducer's own memories are bounded in proportion."""
WIDE_SPACE = re.compile(r" \s|\s |^ | $")
MOST_BELOW = 40
LOOKAHEAD = 64
"""Bytes kept before certain tokens are emitted."""
CHUNK = 4096
ROOT = 0


class Transducer:
    """Bytes in, token ids out."""

    def __init__(self, ranks: dict[bytes, int], memory: int = MOST_WORDS):
        self.most_states, self.most_paths, self.most_pairs = memory // 2, memory * 3 // 2, memory * 5
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.child: dict[int, int] = {}
        self.token = [-1]
        for word, i in ranks.items():
            node = ROOT
            for b in word:
                at = node << 8 | b
                node = self.child.setdefault(at, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
            self.token[node] = i
        self.below: dict[int, list[int]] = {}
        for word, i in ranks.items():
            node = ROOT
            for b in word[:-1]:
                node = self.child[node << 8 | b]
                self.below.setdefault(node, []).append(i)
        self.halves_of: dict[int, tuple | None] = {}
        self.ends_of: tuple[dict, dict] = {}, {}
        self.pairs: dict[int, bool] = {}
        self.paths: dict[int, tuple | None] = {}
        self.alike: dict[tuple, tuple] = {}
        self.forget()

    def forget(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: dict[int, tuple] = {}
        self.moves: dict[tuple, tuple] = {}
        self.start = self.state_number(((-1, ROOT),))

    def state_number(self, state: tuple) -> int:
        found = self.number.get(state)
        if found is None:
            found = self.number[state] = len(self.states)
            self.states.append(state)
        return found

    def halves(self, token: int) -> tuple | None:
        """The two tokens of the merge that completes a token; () for a byte, None if merges never make it."""
        if token not in self.halves_of:
            data = self.bytes_of[token]
            parts = [data[i:i + 1] for i in range(len(data))]
            while len(parts) > 2:
                rank, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == 1 << 60:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.halves_of[token] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else () if len(parts) == 1 else None
        return self.halves_of[token]

    def ends(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The tokens that stand at one end of a token while it is made, longest first, each with the
        rank of the merge that ends it."""
        found = self.ends_of[side].get(token)
        if found is None:
            found, part, until = [], token, 1 << 60
            while True:
                found.append((self.bytes_of[part], until))
                halves = self.halves(part)
                if not halves:
                    break
                part, until = halves[side], part
            self.ends_of[side][token] = found
        return found

    def may_follow(self, before: int, token: int) -> bool:
        """Whether the merges leave the border between two tokens alone.

        Two pieces beside the border are merged if the rank of their merge comes before the merges
        that end either of them; among equal ranks the left one is done first.
        """
        known = self.pairs.get(before << 32 | token)
        if known is None:
            if len(self.pairs) > self.most_pairs:
                self.pairs.clear()
            known = self.pairs[before << 32 | token] = self.stay_apart(before, token)
        return known

    def stay_apart(self, before: int, token: int) -> bool:
        if self.halves(token) is None:
            return False
        if before < 0:
            return True
        for left, left_until in self.ends(before, 1):
            for right, right_until in self.ends(token, 0):
                rank = self.ranks.get(left + right)
                if rank is not None and rank < left_until and rank <= right_until:
                    return False
        return True

    def path(self, last: int, node: int) -> tuple[int, int] | None:
        """The path, None if no longer token through its node may follow.

        Where few tokens lie below the node, last tokens after which the same of them may follow are one.
        """
        below = self.below.get(node, ())
        if len(below) > MOST_BELOW:
            return last, node
        key = last + 1 << 32 | node
        if key not in self.paths:
            if len(self.paths) > self.most_paths:
                self.paths.clear()
                self.alike.clear()
            free = tuple(token for token in below if self.may_follow(last, token))
            self.paths[key] = self.alike.setdefault((node, free), (last, node)) if free else None
        return self.paths[key]

    def step(self, state: int, byte: int) -> tuple:
        """Next state, the path from which all new paths come or -1, and each new path's old path and new token."""
        after = []
        for source, (last, node) in enumerate(self.states[state]):
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            longer = self.path(last, node)
            if longer:
                after.append((longer, source, -1))
            token = self.token[node]
            if token >= 0 and self.may_follow(last, token):
                after.append(((token, ROOT), source, token))
        if not after:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        sources = {source for _, source, _ in after}
        target = self.state_number(tuple(path for path, _, _ in after))
        moves = tuple((source, token) for _, source, token in after)
        result = target, sources.pop() if len(sources) == 1 else -1, self.moves.setdefault(moves, moves)
        self.steps[state << 8 | byte] = result
        return result

    def encode(self, data: bytes) -> list[int]:
        if len(self.states) > self.most_states:
            self.forget()
        out: list[int] = []
        trail: list[tuple] = []  # the moves of the bytes whose tokens are not emitted yet
        state, steps = self.start, self.steps
        for byte in data:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = self.step(state, byte)
                if step[0] > self.most_states:  # go on from this state in an empty memory
                    kept = self.states[step[0]]
                    self.forget()
                    step, steps = (self.state_number(kept), *step[1:]), self.steps
            state, sure, moves = step
            if len(trail) > LOOKAHEAD and sure >= 0:
                out += tokens_to(trail, sure)
                trail = []
            trail.append(moves)
        ends = [i for i, (_, node) in enumerate(self.states[state]) if node == ROOT]
        if len(ends) != 1:
            raise ValueError("the ranks do not give one encoding")
        return out + tokens_to(trail, ends[0])


def tokens_to(trail: list[tuple], path: int) -> list[int]:
    """The tokens of the path that is at this place of its state after all moves of the trail."""
    found = []
    for moves in reversed(trail):
        path, token = moves[path]
        if token >= 0:
            found.append(token)
    return found[::-1]


class Remembered(dict):
    """Ids of short texts as bytes, made when first asked for; a full memory is kept until the next is full."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.make(text)
        if len(text) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Codec:
    """Between two characters that are not white space, a single blank always begins a match of the
    pattern, so texts are cut there first and equal parts are matched and encoded once. A part that is
    one match is remembered as a part only."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MOST_WORDS, words: int | None = None):
        self.pattern = regex.compile(pattern)
        self.transducer = Transducer(ranks, memory)
        self.pieces = Remembered(self.piece, words or memory)
        self.parts = Remembered(self.part, words or memory)
        self.bytes_of = self.transducer.bytes_of

    def piece(self, piece: str) -> bytes:
        ids = self.transducer.encode(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def part(self, part: str) -> bytes:
        found = self.pattern.findall(" " + part)
        return self.piece(found[0]) if len(found) == 1 else b"".join(map(self.pieces.__getitem__, found))

    def matches(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        if WIDE_SPACE.search(text):
            ids = self.matches(text)
        else:
            first, *rest = text.split(" ")
            ids = self.matches(first) + b"".join(map(self.parts.__getitem__, rest))
        return np.frombuffer(ids, dtype="<u4")

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as it becomes certain; bytes that are no UTF-8 become replacement characters."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        ids = np.asarray(ids).tolist()
        for i in range(0, len(ids), CHUNK):
            yield decoder.decode(b"".join(map(self.bytes_of.__getitem__, ids[i:i + CHUNK])))
        yield decoder.decode(b"", final=True)

    def digest(self, ids: Iterable[int]) -> str:
        """SHA-256 of the decoded text, chunk by chunk."""
        decoded = hashlib.sha256()
        for part in self.decode_stream(ids):
            decoded.update(part.encode())
        return decoded.hexdigest()


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


CODECS: dict[tuple, Codec] = {}
"""One codec per worker process and vocabulary."""


def codec_of(data: bytes, pattern: str, memory: int = MOST_WORDS, words: int | None = None) -> Codec:
    key = hashlib.sha256(data).digest(), pattern, memory, words
    if key not in CODECS:
        CODECS.clear()
        CODECS[key] = Codec(read_ranks(data), pattern, memory, words)
    return CODECS[key]


def vocabulary(df: DataFrame, path: str):
    """The vocabulary file, sent to every worker once; its size is that of the file."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(documents: DataFrame, path: str, pattern: str, memory: int = MOST_WORDS, words: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every whole text; the digest is that of the decoded ids' text.

    ``memory`` bounds what a worker remembers; ``words`` sets its short texts apart from the transducer's memories.
    """
    data = vocabulary(documents, path)

    def run(batch: pa.RecordBatch) -> list:
        codec = codec_of(data.value, pattern, memory, words)
        ids = [codec.encode(t).astype("i4") for t in batch.column("text").to_pylist()]
        return [batch.column("doc_id"), [len(i) for i in ids], ids, [codec.digest(i) for i in ids]]

    id_type = dict(documents.dtypes)["doc_id"]
    return per_slice(documents.select("doc_id", "text"), run, f"doc_id {id_type}, n_tokens long, ids array<int>, decoded_sha256 string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of lists of ids."""
    data = vocabulary(encoded, path)

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        codec = codec_of(data.value, "")
        return pd.DataFrame({"doc_id": batch["doc_id"], "text": ["".join(codec.decode_stream(i)) for i in batch["ids"]]})

    return per_batch(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode every whole text: number of tokens, digest of the ids, digest of the decoded bytes."""
    data = vocabulary(documents, path)

    def one(codec: Codec, text: str | None) -> tuple[int, str, str]:
        ids = codec.encode(text)
        decoded = hashlib.sha256()
        for part in codec.decode_stream(ids):
            decoded.update(part.encode())
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded.hexdigest()

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        codec = codec_of(data.value, pattern)
        rows = pd.DataFrame([one(codec, t) for t in batch["text"]], columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        rows.insert(0, "doc_id", batch["doc_id"].to_numpy())
        return rows

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_batch(documents.select("doc_id", "text"), run, schema)

"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A piece of text starts as its single bytes. The tree's leaf of a byte position holds the rank of the pair that starts
there, its nodes the least ``rank * width + position`` below them, so the root is the leftmost pair of least rank. A
merge changes three leaves, those of the merged token, of its left neighbour and of the token that vanished; each
update walks to the root. ``merge_piece`` does this for one piece; ``merge_pieces`` runs the trees of many pieces of
like length side by side, one merge of each per step, as numpy rows.

A worker remembers the ids of pieces up to a bound. Texts are split by the tokenizer's pattern; texts with
Latin letters only by an equal pattern in the standard library's engine, which is faster.

Defined results. A null or empty text has no ids. Bytes decode to the text again. Repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from layerwright.llm.spark import arrow_schema, batches, map_batches, pieces_of, strings
from layerwright.llm.words import text_bytes

NONE = np.int64(1) << np.int64(62)
LONG = 512  # bytes of a piece that is merged by itself

# The letters, numbers and white space below U+0240.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ȿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_LATIN = re.compile(rf" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND_LATIN = 0xC9  # first bytes from here on start later characters


class Ranks:
    """A rank file: the ids of byte strings, which of their pairs merge, and into what."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = [b""] * (max(self.ids.values()) + 1)
        for token, number in self.ids.items():
            self.bytes_of[number] = token
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, number in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = number
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges into, or NONE."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)


def merge_piece(piece: bytes, ranks: Ranks) -> list[int]:
    """The ids of one piece of any length."""
    n = len(piece)
    if n < 2:
        return ranks.single[list(piece)].tolist()
    width = 1 << (n - 1).bit_length()
    none, pairs = int(NONE), ranks.pairs
    token = ranks.single[np.frombuffer(piece, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * width)
    for i in range(n - 1):
        rank = pairs.get(token[i] << 32 | token[i + 1])
        if rank is not None:
            tree[width + i] = rank * width + i
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, key: int) -> None:
        node = width + i
        if tree[node] == key:
            return
        tree[node] = key
        while node > 1:
            node >>= 1
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                return
            tree[node] = low

    def key_at(i: int) -> int:
        rank = pairs.get(token[i] << 32 | token[after[i]]) if after[i] < n else None
        return none if rank is None else rank * width + i

    while tree[1] < none:
        rank, i = divmod(tree[1], width)
        gone = after[i]
        token[i], after[i] = rank, after[gone]
        if after[i] < n:
            before[after[i]] = i
        put(gone, none)
        put(i, key_at(i))
        if before[i] >= 0:
            put(before[i], key_at(before[i]))
    out, i = [], 0
    while i < n:
        out.append(token[i])
        i = after[i]
    return out


def _merge_rows(pieces: list[bytes], width: int, ranks: Ranks) -> list[bytes]:
    """Pieces of 2 to ``width`` bytes, a power of two; the ids of each as little-endian unsigned 32-bit numbers."""
    count = len(pieces)
    sizes = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(count, width)
    token = np.zeros((count, width + 1), np.int64)
    token[:, :width] = ranks.single[raw]
    places = np.arange(width)
    after = np.tile(places + 1, (count, 1))
    before = np.tile(places - 1, (count, 1))
    tree = np.full((count, 2 * width), NONE)
    keys = ranks.rank(token[:, : width - 1], token[:, 1:width])
    inside = places[1:] < sizes[:, None]
    tree[:, width : 2 * width - 1] = np.where(inside & (keys < NONE), keys * width + places[:-1], NONE)
    for node in range(width - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
    live = np.ones((count, width), bool) & (places < sizes[:, None])

    def put(rows, at, key):
        node = width + at
        tree[rows, node] = key
        while (node := node >> 1)[0]:
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    rows = np.flatnonzero(tree[:, 1] < NONE)
    while len(rows):
        rank, at = np.divmod(tree[rows, 1], width)
        gone = after[rows, at]
        following = after[rows, gone]
        token[rows, at], after[rows, at] = rank, following
        live[rows, gone] = False
        follows = following < sizes[rows]
        before[rows[follows], following[follows]] = at[follows]
        put(rows, gone, NONE)
        key = ranks.rank(rank, token[rows, following])
        put(rows, at, np.where(follows & (key < NONE), key * width + at, NONE))
        left = before[rows, at]
        some = left >= 0
        if some.any():
            own, left = rows[some], left[some]
            key = ranks.rank(token[own, left], rank[some])
            put(own, left, np.where(key < NONE, key * width + left, NONE))
        rows = rows[tree[rows, 1] < NONE]
    flat = token[:, :width][live].astype("<u4").tobytes()
    ends = np.cumsum(live.sum(1) * 4).tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def merge_pieces(pieces: list[bytes], ranks: Ranks) -> list[bytes]:
    """The ids of each piece, as little-endian unsigned 32-bit numbers. A piece in the vocabulary is its own id."""
    out: list[bytes] = [b""] * len(pieces)
    widths: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        number = ranks.ids.get(piece)
        if number is not None:
            out[i] = number.to_bytes(4, "little")
        elif len(piece) > LONG:
            out[i] = np.array(merge_piece(piece, ranks), "<u4").tobytes()
        elif piece:
            widths.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
    for width, members in widths.items():
        for at in range(0, len(members), step := max(1, (1 << 19) // width)):
            some = members[at : at + step]
            for i, ids in zip(some, _merge_rows([pieces[i] for i in some], width, ranks), strict=True):
                out[i] = ids
    return out


class Encoder:
    def __init__(self, path: str, pattern: str, most: int = 600_000):
        self.ranks, self.pattern, self.most = Ranks(path), regex.compile(pattern), most
        self.latin = _LATIN if pattern == PATTERN else None
        self.known: dict[str, bytes] = {}

    def split(self, text: str, latin: bool) -> list[str]:
        return self.latin.findall(text) if latin and self.latin else self.pattern.findall(text)

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        data, offsets = text_bytes(texts)
        highest = np.zeros(len(texts), np.uint8)
        filled = np.flatnonzero(np.diff(offsets))
        if len(filled):
            highest[filled] = np.maximum.reduceat(data, offsets[:-1][filled])
        latin = (highest < _BEYOND_LATIN).tolist()
        split = [self.split(text, ok) for text, ok in zip(texts.to_pylist(), latin, strict=True)]
        if len(self.known) > self.most:
            self.known.clear()
        new = list(set().union(*split).difference(self.known)) if split else []
        self.known.update(zip(new, merge_pieces([piece.encode() for piece in new], self.ranks), strict=True))
        get = self.known.__getitem__
        return [b"".join(map(get, own)) for own in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


# Fixed value: the splitting pattern that goes with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


ENCODED = "doc_id long, ids array<long>"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encode(rows: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(ENCODED)
    for batch in rows:
        for part in pieces_of(batch, "text", 2 << 20):
            ids = encoder(path, pattern).encode(strings(part.column("text")))
            numbers = [np.frombuffer(x, "<u4").astype(np.int64) for x in ids]
            yield from batches({"doc_id": part.column("doc_id").to_pylist(), "ids": numbers}, schema)


def encoded(docs: DataFrame, path: str, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, ids`` of each document."""
    return map_batches(docs.select("doc_id", "text"), partial(_encode, path=path, pattern=pattern), ENCODED)


def _digest(rows: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(DIGESTS)
    coder = encoder(path, pattern)
    for batch in rows:
        for part in pieces_of(batch, "text", 2 << 20):
            ids = coder.encode(strings(part.column("text")))
            yield from batches(
                {
                    "doc_id": part.column("doc_id").to_pylist(),
                    "n_tokens": [len(x) // 4 for x in ids],
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(coder.decode(x)).hexdigest() for x in ids],
                },
                schema,
            )


def digests(docs: DataFrame, path: str, pattern: str = PATTERN) -> DataFrame:
    """Per document the number of ids, a digest of the ids and one of the bytes that they decode to."""
    return map_batches(docs.select("doc_id", "text"), partial(_digest, path=path, pattern=pattern), DIGESTS)

"""Runs: stretches of consecutive words that repeat with a period, by enumeration of maximal pairs.

Two places i < j of a text form a maximal pair of length m if the m words from i on equal those from j on, the words before
them differ (or one place is the start) and the words after them differ (or one ends the text). A pair whose
distance q = j - i meets m >= 3 q and m + q >= 6 is the stretch from i to j + m with period q, which no neighbouring word
extends: a run, found without any extension. The same stretch may come with multiples of its period; the least counts.

Maximal pairs come from the suffix array of a text. Its LCP-interval tree is walked bottom-up with a stack; every node keeps
its places by the word to their left, and when a child joins its parent, pairs between the two are formed across
classes of different left words only. Three facts keep that near linear, and lose no pair: a run has m >= 5, so only
suffixes that share five words with another one count; a block of those with one left word has no pair; a place
whose next equal window is farther than a third of its longest match has none either. Places of a node that are
closer than a third of the match length are a chain in which only the first has another left word, so the nearest place
above and the farthest one in reach below tell all.

Words are runs of characters other than space and U+0009 to U+000D, compared exactly.

Defined results. A null text has no words. A text without a run has empty lists. Of overlapping runs all are found.
A very long text is held in its task with some 150 bytes per word and, for words in long repeats, 4 bytes more per
doubling of the longest repeat. Repeated rows give repeated rows. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, map_batches, pieces_of

#: A run has at least SHORTEST words and EXPONENT times its period.
SHORTEST, EXPONENT = 6, 4
_SEED = 5  # shortest match of a run's maximal pair: period 1, six words


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers, from 1 up."""
    known: dict[bytes, int] = {}
    return np.fromiter(map(known.setdefault, words, count(1)), np.int64, len(words))


def _window_keys(numbers: np.ndarray) -> np.ndarray:
    """A key of the four words from each place on, equal for equal words only; behind the end stands the number 0."""
    n = len(numbers)
    padded = np.zeros(n + 4, np.uint64)
    padded[:n] = numbers
    if n < 1 << 16:  # word numbers are at most n
        bits = np.uint64(16)
        return padded[:n] << bits * 3 | padded[1 : n + 1] << bits * 2 | padded[2 : n + 2] << bits | padded[3 : n + 3]
    bits = np.uint64(32)
    _, pairs = np.unique(padded[:-1] << bits | padded[1:], return_inverse=True)
    pairs = pairs.astype(np.uint64)
    return pairs[:n] << bits | pairs[2 : n + 2]


def suffix_order(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose first four words occur again, in suffix order, and the match length of each with the one before it
    (0 where less than four words match). Ranks are doubled from four words on, for places still tied only."""
    n, key = len(numbers), _window_keys(numbers)
    ordered = np.sort(key)
    if not (ordered[1:] == ordered[:-1]).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    ranks, size = [rank], 4
    chosen = tied = np.flatnonzero(_shared(fresh))
    while len(tied):
        places, rank = order[tied], ranks[-1]
        after = np.full(len(places), -1, np.int32)
        inner = places + size < n
        after[inner] = rank[places[inner] + size]
        by = np.lexsort((after, rank[places]))
        places, after = places[by], after[by]
        order[tied] = places
        fresh = np.ones(len(places), bool)
        fresh[1:] = (rank[places[1:]] != rank[places[:-1]]) | (after[1:] != after[:-1])
        rank = rank.copy()
        rank[places] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))]
        ranks.append(rank)
        size *= 2
        tied = tied[_shared(fresh)]
    return order[chosen], _match_lengths(order[chosen], ranks, numbers)


def _shared(fresh: np.ndarray) -> np.ndarray:
    """True for members of groups of two and more, groups starting where ``fresh`` is true."""
    last = np.append(fresh[1:], True)
    return ~(fresh & last)


def _match_lengths(order: np.ndarray, ranks: list[np.ndarray], numbers: np.ndarray) -> np.ndarray:
    """From the largest doubling down: where the next words are equal as a block, step over the block."""
    n, lengths = len(numbers), np.zeros(len(order), np.int64)
    if len(order) < 2:
        return lengths
    left, right = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 1, -1, -1):
        rank, size = ranks[level], 4 << level
        inner = np.flatnonzero(np.maximum(left, right) + size <= n)
        equal = inner[rank[left[inner]] == rank[right[inner]]]
        left[equal] += size
        right[equal] += size
    for _ in range(3):
        inner = np.flatnonzero(np.maximum(left, right) < n)
        equal = inner[numbers[left[inner]] == numbers[right[inner]]]
        left[equal] += 1
        right[equal] += 1
        if not len(equal):
            break
    lengths[1:] = right - order[1:]
    return lengths


def _worth(order: np.ndarray, match: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leave out places that can be in no run's pair; matches between those left are minima over what is left out."""
    match = np.where(match >= _SEED, match, 0)
    follows = np.append(match[1:], 0)
    longest = np.maximum(match, follows)
    block = np.cumsum(match == 0)
    by = np.lexsort((order, block))
    gap = np.full(len(order), np.iinfo(np.int64).max)
    near = np.diff(order[by])
    near[np.diff(block[by]) != 0] = np.iinfo(np.int64).max
    ends = np.minimum(np.append(near, gap[:1]), np.append(gap[:1], near))
    gap[by] = ends
    keep = (longest >= _SEED) & (gap <= longest // (EXPONENT - 1))
    heads = np.flatnonzero(match == 0)
    if len(heads):  # blocks with one left word only
        mixed = np.minimum.reduceat(before, heads) != np.maximum.reduceat(before, heads)
        keep &= mixed[block - 1]
    kept = np.flatnonzero(keep)
    if not len(kept):
        return order[:0], match[:0]
    between = np.minimum.reduceat(match[: kept[-1] + 1], np.append(0, kept[:-1] + 1))
    between[0] = 0
    return order[kept], between


class _Classes:
    """Places below a node, in order, and the left word of each."""

    __slots__ = ("places", "words")

    def __init__(self, place: int, word: int):
        self.places, self.words = [place], {place: word}

    def join(self, other: _Classes, match: int, found: list[tuple[int, int, int]]) -> _Classes:
        """Form the pairs between two children of a node and put the smaller one's places into the larger one's."""
        small, large = (self, other) if len(self.places) < len(other.places) else (other, self)
        reach, places, words = match // (EXPONENT - 1), large.places, large.words
        for place in small.places:
            word = small.words[place]
            at = bisect_right(places, place)
            while at < len(places) and places[at] - place <= reach and words[places[at]] != word:
                found.append((place, places[at], match))
                at += 1
            at = bisect_left(places, place - reach)
            if at < len(places) and places[at] < place and words[places[at]] != word:
                found.append((places[at], place, match))
        for place in small.places:
            places.insert(bisect_left(places, place), place)
        words.update(small.words)
        return large


def close_pairs(order: list[int], match: list[int], before: list[int]) -> list[tuple[int, int, int]]:
    """Maximal pairs (place, place, length) that are at most a third of their length apart, bottom-up over the LCP intervals:
    the stack holds the open intervals, each with the match length of its places with those above it."""
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, _Classes]] = []
    for place, length in zip([*order, -1], [*match, 0], strict=True):
        while stack and stack[-1][0] > length:
            deep, top = stack.pop()
            below, rest = stack.pop()
            stack.append((below, rest.join(top, deep, found)))
        if length == 0:
            stack.clear()
        if place >= 0:
            stack.append((length, _Classes(place, before[place])))
    return found


def runs_of(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if len(numbers) < SHORTEST:
        return []
    order, match = suffix_order(numbers)
    if not len(order) or match.max() < _SEED:
        return []
    before = np.concatenate([[0], numbers[:-1]])
    order, match = _worth(order, match, before[order])
    least: dict[tuple[int, int], int] = {}
    for i, j, m in close_pairs(order.tolist(), match.tolist(), before.tolist()):
        period = j - i
        if m + period >= SHORTEST:
            stretch = (i, m + period)
            least[stretch] = min(period, least.get(stretch, period))
    return sorted(((i, size, q) for (i, size), q in least.items()), key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for words that a run contains after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, size, period in runs:
        depth[start + period] += 1
        depth[start + size] -= 1
    return np.cumsum(depth[:n]) == 0


FOUND = "doc_id long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"


def _found(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(FOUND)
    for batch in rows:
        for piece in pieces_of(batch, "text"):
            runs, collapsed = [], []
            for text in piece.column("text").cast(pa.large_binary()).fill_null(b"").to_pylist():
                words = text.split()
                runs.append(runs_of(word_numbers(words)))
                if runs[-1]:
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs[-1]))]
                collapsed.append(b" ".join(words))
            lists = [[[run[k] for run in of] for of in runs] for k in range(3)]
            columns = [piece.column("doc_id"), *lists, collapsed]
            yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def found(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the runs (three lists, by start, then period) and the text's words, joined by one space,
    without those that a run repeats after its first period. One pass without a shuffle."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(texts, _found, FOUND)


def with_planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where a tenth of the rows, by crc32 of the doc_id, repeats a piece of its text to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr("array_join(transform(sequence(0L, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def digests(runs: DataFrame) -> DataFrame:
    """The longest run of each row and digests of all of them and of the collapsed text."""
    n = F.size("starts")
    at = F.expr(
        "reduce(sequence(0, size(starts) - 1), 0, (best, i) -> if(i > 0 and lengths[i] > lengths[best], i, best))"
    )
    lines = F.expr("array_join(transform(starts, (s, i) -> concat(s, ',', lengths[i], ',', periods[i], '\n')), '')")
    rows = runs.withColumn("at", F.when(n > 0, at))
    best = {"start": "starts", "length": "lengths", "period": "periods"}
    rows = rows.withColumns({name: F.expr(f"{column}[at]") for name, column in best.items()})
    return rows.select(
        "doc_id", n.cast("long").alias("n_runs"), *best, F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

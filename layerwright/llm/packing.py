"""Packing of tokenized documents into sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens. Full pieces are sequences already. The others are dealt by a
hash of their row into shards of some 2,000 pieces, a bounded row each, and every shard is solved on a few islands
at once: a population of packings evolves by crossover, in which whole well-filled bins of one parent are injected into the
other, bins that now hold duplicates are dissolved, and displaced pieces go where they fit best. Between epochs the best
packing of each island migrates to the next island of its shard. Pieces of bins that stay badly filled are dealt anew into
shards across the whole table for another round.

Defined results. A null or empty text is one piece, the end token alone. Repeated rows are packed once each. A null
doc_id is kept. An empty table gives no rows. A text of any length is cut, never dropped; one task holds its ids.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, batches, map_batches, pieces_of, ship, stage_table, strings
from layerwright.llm.words import text_bytes

CAPACITY = 2048
SHARD = 2048
SLICE = 1 << 20  # bytes of text that are worked on at once
ISLANDS = 2
END = 0
REMEMBERED = 800_000  # strings whose ids a worker remembers
_ASCII_SPACE = re.compile("[ \t\n\x0b\x0c\r]+")


class WordIds(dict):
    """Token ids, as bytes, of strings between white space, which this kind of tokenizer encodes one by one.

    Normaliser, splitter and model are those of the ``tokenizers`` library; the dictionaries only remember. They are
    emptied when full, so a worker's memory is bounded. A text that holds one of the tokenizer's added tokens, which count
    before anything is normalised or split, is left to the library as a whole."""

    def __init__(self, path: str, most: int = REMEMBERED):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.normalize, self.split = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self.tokenize, self.most, self.parts = tokenizer.model.tokenize, most, {}
        self.whole = tokenizer.encode
        self.added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            ids = self._tokens(chunk) if chunk.islower() else self[chunk.lower()]
        elif chunk.isascii() and chunk.endswith((",", ".")) and chunk[:-1].isalpha():
            ids = self[chunk[:-1].lower()] + self._part(chunk[-1])
        else:
            ids = b"".join([self._part(part) for part, _ in self.split(self.normalize(chunk))])
        if len(self) >= self.most:
            self.clear()
        self[chunk] = ids
        return ids

    def _tokens(self, part: str) -> bytes:
        return b"".join([token.id.to_bytes(4, "little") for token in self.tokenize(part)])

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isalpha() and part.islower():  # a string between white space by itself
            return self[part]
        ids = self.parts.get(part)
        if ids is None:
            ids = self._tokens(part)
            if len(self.parts) >= self.most:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    def encode(self, text: str, odd: bool = False) -> bytes:
        """odd: the text may hold characters that ``str.split`` takes for white space and the tokenizer does not."""
        for token in self.added:
            if token in text:
                return np.array(self.whole(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, _ASCII_SPACE.split(text) if odd else text.split()))


@cache
def _word_ids(path: str, most: int) -> WordIds:
    return WordIds(path, most)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(rows: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool, most: int) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(PIECES + (", ids array<long>" if with_ids else ""))
    words, end = _word_ids(path, most), np.array([END], "<u4").tobytes()
    for batch in rows:
        for part in pieces_of(batch, "text", SLICE):
            out = {name: [] for name in schema.names}
            texts = strings(part.column("text"))
            data, _ = text_bytes(texts)
            odd = bool(((data >= 0x1C) & (data <= 0x1F)).any())
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts.to_pylist(), strict=True):
                ids = words.encode(text, odd) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(own) // 4)
                    out["ids_crc32"].append(zlib.crc32(own))
                    if with_ids:
                        out["ids"].append(np.frombuffer(own, "<u4").tolist())
            yield from batches(out, schema)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, most: int = REMEMBERED) -> DataFrame:
    """The documents' token ids and an end token, cut at ``capacity``; the ids themselves on demand. ``path`` is a
    tokenizer file that encodes strings between white space one by one; a worker remembers the ids of ``most`` of them, some 200
    bytes each."""
    run = partial(_cut, path=path, capacity=capacity, with_ids=with_ids, most=most)
    return map_batches(docs.select("doc_id", "text"), run, PIECES + (", ids array<long>" if with_ids else ""))


# Packings of one shard. sizes: descending; a packing is the bin of each item.


def best_fit(sizes: np.ndarray, items, bins: np.ndarray, free: list[int]) -> None:
    """Put the items one by one where the least room is left over. bins is filled in; free is the room of each bin."""
    room = sorted((f, b) for b, f in enumerate(free) if f > 0)
    for item in items:
        size = int(sizes[item])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, bin_ = room.pop(at)
        else:
            left, bin_ = free_capacity(free), len(free)
            free.append(left)
        bins[item] = bin_
        left -= size
        free[bin_] = left
        if left:
            insort(room, (left, bin_))


class Room(list):
    """The free room of bins, with the capacity of a new one."""

    def __init__(self, capacity: int, free=()):
        super().__init__(free)
        self.capacity = capacity


def free_capacity(free: Room) -> int:
    return free.capacity


def fresh(sizes: np.ndarray, capacity: int, order) -> np.ndarray:
    bins = np.full(len(sizes), -1, np.int32)
    best_fit(sizes, order, bins, Room(capacity))
    return bins


def fills(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, sizes).astype(np.int64)


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """Few bins first; of as many bins, the more uneven filling, which leaves more room in one place."""
    fill = fills(sizes, bins) / capacity
    return -len(fill) + float((fill**2).mean())


def crossover(sizes: np.ndarray, one: np.ndarray, other: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Well-filled bins of ``other`` injected whole into ``one``."""
    fill = fills(sizes, other)
    well = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 2)]
    injected = np.zeros(len(fill), bool)
    injected[rng.choice(well, max(1, len(well) // 2), replace=False)] = True
    taken = injected[other]
    hit = np.zeros(one.max() + 1, bool)
    hit[one[taken]] = True  # bins that would hold an item twice
    rest = fills(sizes, one)
    if (~hit).sum() > 2:  # and, as mutation, the two emptiest of the others
        hit[np.argsort(np.where(hit, capacity + 1, rest), kind="stable")[:2]] = True
    stays = ~taken & ~hit[one]
    bins = np.full(len(sizes), -1, np.int32)
    _, bins[taken] = np.unique(other[taken], return_inverse=True)
    count = int(injected.sum())
    kept, place = np.unique(one[stays], return_inverse=True)
    bins[stays] = place + count
    free = Room(capacity, (capacity - np.bincount(bins[bins >= 0], sizes[bins >= 0], count + len(kept))).astype(int).tolist())
    best_fit(sizes, np.flatnonzero(bins < 0), bins, free)
    return bins


def evolve(sizes: np.ndarray, population: list[np.ndarray], capacity: int, rng, generations: int) -> list[np.ndarray]:
    """Each generation a child of two parents replaces the worst packing, if it is better. Ends at the lower bound."""
    least = -(-int(sizes.sum()) // capacity)
    scored = sorted(((fitness(sizes, p, capacity), i, p) for i, p in enumerate(population)), key=lambda x: -x[0])
    for _ in range(generations):
        if int(scored[0][2].max()) + 1 <= least:
            break
        a, b = rng.choice(len(scored), 2, replace=len(scored) < 2)
        child = crossover(sizes, scored[a][2], scored[b][2], capacity, rng)
        score = fitness(sizes, child, capacity)
        if score > scored[-1][0]:
            scored[-1] = (score, 0, child)
            scored.sort(key=lambda x: -x[0])
    return [p for _, _, p in scored]


STATE = "shard long, island int, ids array<long>, sizes array<int>, population array<array<int>>, elite array<int>, fit double"


def _epoch(frames: Iterator[pd.DataFrame], capacity: int, epoch: int, members: int, generations: int):
    for frame in frames:
        out = []
        for row in frame.itertuples():
            sizes = np.asarray(row.sizes, np.int64)
            rng = np.random.default_rng([int(row.shard), int(row.island), epoch])
            if epoch == 0:
                n = len(sizes)
                population = [fresh(sizes, capacity, range(n))]  # sizes come in descending order
                while len(population) < members:
                    jitter = sizes * rng.uniform(0.7, 1.0, n)
                    population.append(fresh(sizes, capacity, np.argsort(-jitter, kind="stable")))
            else:
                population = [np.asarray(p, np.int32) for p in row.population] + [np.asarray(row.elite, np.int32)]
            population = evolve(sizes, population, capacity, rng, generations)[:members]
            score = fitness(sizes, population[0], capacity)
            out.append((row.shard, row.island, row.ids, row.sizes, [p.tolist() for p in population], population[0].tolist(), score))
        yield pd.DataFrame(out, columns=["shard", "island", "ids", "sizes", "population", "elite", "fit"])


PLACED = "row long, sequence_id long, offset long, fill long"


def _place(frames: Iterator[pd.DataFrame], base: int):
    """Rows of the chosen packing of each shard. A sequence number is base, shard and bin side by side."""
    for frame in frames:
        for row in frame.itertuples():
            sizes, bins = np.asarray(row.sizes, np.int64), np.asarray(row.elite, np.int64)
            order = np.argsort(bins, kind="stable")
            sums = np.cumsum(sizes[order]) - sizes[order]
            starts = np.flatnonzero(np.r_[True, np.diff(bins[order]) > 0])
            offset = sums - np.repeat(sums[starts], np.diff(np.r_[starts, len(order)]))
            yield pd.DataFrame(
                {
                    "row": np.asarray(row.ids, np.int64)[order],
                    "sequence_id": base + (int(row.shard) << 20) + bins[order],
                    "offset": offset,
                    "fill": fills(sizes, bins)[bins[order]],
                }
            )


def _round(items: DataFrame, capacity: int, number: int, islands: int, generations: int) -> DataFrame:
    """Packings of items (``row``, ``length``); ``number`` of the round keeps sequence numbers apart."""
    spark = items.sparkSession
    ship(spark)
    shards = max(1, -(-items.count() // SHARD))
    dealt = items.groupBy(F.pmod(F.xxhash64("row", F.lit(number)), shards).alias("shard")).agg(
        F.sort_array(F.collect_list(F.struct("length", "row")), asc=False).alias("items")
    )
    start = dealt.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.col("items.row").alias("ids"),
        F.col("items.length").cast("array<int>").alias("sizes"),
    ).repartition("shard", "island")
    first = partial(_epoch, capacity=capacity, epoch=0, members=4, generations=generations)
    state = stage_table(start.mapInPandas(first, STATE), "packing-epoch")
    moved = state.select("shard", F.pmod(F.col("island") + 1, islands).alias("island"), "elite")
    mixed = state.drop("elite").join(moved, ["shard", "island"])
    later = partial(_epoch, capacity=capacity, epoch=1, members=4, generations=generations)
    ended = mixed.mapInPandas(later, STATE).select("shard", "ids", "sizes", "elite", "fit", "island")
    best = ended.groupBy("shard").agg(F.max_by(F.struct("ids", "sizes", "elite"), F.struct("fit", F.negative("island"))).alias("best"))
    chosen = best.select("shard", "best.ids", "best.sizes", "best.elite")
    return chosen.mapInPandas(partial(_place, base=number << 50), PLACED)


def packed(rows: DataFrame, capacity: int = CAPACITY, islands: int = ISLANDS, generations: int = 8, rounds: int = 2) -> DataFrame:
    """``row, sequence_id, offset`` for rows with a ``row`` number and a ``length`` from 1 to ``capacity``."""
    full = rows.filter(F.col("length") >= capacity).select(
        "row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    out, rest = full, rows.filter(F.col("length") < capacity).select("row", "length")
    for number in range(rounds):
        placed = stage_table(_round(rest, capacity, number, islands, generations), "packing-round")
        last = number == rounds - 1
        good = placed if last else placed.filter(F.col("fill") >= 0.98 * capacity)
        out = out.unionAll(good.select("row", "sequence_id", "offset"))
        if not last:
            rest = rest.join(placed.filter(F.col("fill") < 0.98 * capacity).select("row"), "row", "left_semi")
    return out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, most: int = REMEMBERED) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``."""
    cut = pieces(docs, path, capacity, with_ids, most)
    cut = stage_table(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    return cut.join(packed(cut, capacity), "row").drop("row")

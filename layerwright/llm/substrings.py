"""Repeated passages: shared seeds, collinear chains, aligned chains.

1. Seeds are runs of ``k`` words (lower case), of which a text keeps the minimizers of ``w`` neighbours, so an equal
   run of ``k + w - 1`` words shares one. Long seeds are runs of ``min_words`` words, chosen so of ``long_w`` neighbours; each is a
   passage of its own. Long seeds give membership: an occurrence names the first holder and the one before. Within a task these
   links are made first, and only occurrences in the first document go on, so they grow with the occurrences, never with their
   square, and no equal run of ``min_words + long_w - 1`` words is lost. Words that a long seed names an earlier holder for are
   copies. Short seeds with up to ``LIGHT`` occurrences link every pair of documents. Of those with more, copies are linked to
   the first holder and the one before, who stand for them, and all other occurrences are compared with each other in blocks, by
   the words around them. Two that make a passage by these words alone are one class. A class is linked by a spanning tree, each member
   to the earliest holder it is like, so links grow with the occurrences. Pairs of different classes are linked one by one,
   unless they cannot reach ``min_identity`` there.
2. The links of a pair of documents are anchors. Anchors on one diagonal at minimizer distance are one segment. Segments that
   follow each other in both texts are chained: a segment's weight is its words, a gap costs a share of its words on both
   sides. That cost splits into a part of either end, so the best predecessor is a prefix maximum in a Fenwick tree
   over the other text's positions.
3. A chain is aligned: its ends are extended word by word, its gaps compared. Only these words are fetched from the texts.
   A passage has ``min_words`` words or more on both sides and a share of equal words of ``min_identity`` or more. A chain
   with too few equal words is split at gaps into the parts that pass.

A passage belongs to the later document (greater doc_id) and names an earlier holder, so the first holder is never cut. Of a
run that many hold, a document's copy names holders of it; its links to what is like the run are theirs. So a document with
like passages in many earlier ones names one or some of them, and like passages are one class: rows connect all of them.

Defined results. Null, empty and short texts hold no passage. Rows without doc_id are not compared, and kept. Rows that
repeat a doc_id with the same text count once; with different texts their seeds are taken together and positions are
those of either text. A passage that a document holds more than once is found at each place if an earlier document holds it;
repetition inside a document alone is not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, batches, fresh_name, map_batches, pieces_of, stage_table, strings
from layerwright.llm.words import Words, find_words, inside, window_keys

BLANK = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Rules:
    k: int = 8
    w: int = 10
    long_w: int = 4  # of the long seeds, which have min_words words
    min_words: int = 50
    min_identity: float = 0.8
    gap_cost: float = 0.1  # per word of a gap, on either side
    reach: int = 32  # words by which an end may be extended


def _slide(x: np.ndarray, size: int, low: bool) -> np.ndarray:
    """Least (or greatest) of x[i:i + size], for every i, with the array's end padded."""
    combine = np.minimum if low else np.maximum
    out, have = x, 1
    while have < size:
        step = min(have, size - have)
        out = combine(out, np.r_[out[step:], np.full(step, BLANK if low else 0, np.uint64)])
        have += step
    return out


def minimizers(texts: pa.StringArray, k: int, w: int, every: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, word position and key of the seeds of each text; of equal seeds of a text, the first, or ``every`` one."""
    text, pos, key = _minimizers(find_words(texts, lower=True), k, w)
    if every:
        return text, pos, key
    order = np.lexsort((pos, key, text))
    fresh = np.r_[True, (text[order][1:] != text[order][:-1]) | (key[order][1:] != key[order][:-1])] if len(order) else order
    first = np.sort(order[fresh]) if len(order) else order
    return text[first], pos[first], key[first]


def _minimizers(words: Words, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, good = window_keys(words.keys, k), inside(words, k)
    texts = len(words.counts)
    owner = words.owner[: len(keys)]
    at = np.arange(len(keys)) + owner * w  # w blanks between texts, so that no window spans two
    spread = np.full(len(words.keys) + texts * w + w, BLANK)
    spread[at[good]] = keys[good]
    least = _slide(spread, w, low=True)
    # a text shorter than a window has one that ends in blanks; windows of longer texts must not
    sizes = np.maximum(words.counts - k + 1, 0)
    final = np.arange(texts) * w + words.first[:-1] + np.maximum(sizes - w, 0)
    starts = at[good]
    least_of = np.zeros(len(spread), np.uint64)
    inner = starts[starts <= np.repeat(final, sizes)]
    least_of[inner] = least[inner]
    # position i is a minimizer if it equals the least of one of the windows that hold it
    back = np.r_[np.zeros(w - 1, np.uint64), least_of][: len(spread)]
    most = _slide(back, w, low=False)
    chosen = np.flatnonzero(good)[most[starts] == keys[good]]
    return owner[chosen], chosen - words.first[owner[chosen]], keys[chosen]


def _short(keys: np.ndarray) -> np.ndarray:
    return (keys & ~np.uint64(1)).view(np.int64)


def _long(keys: np.ndarray) -> np.ndarray:
    return (keys | np.uint64(1)).view(np.int64)


LINKS = "seed long, doc_id long, pos int, other_id long, other_pos int"


def link_sorted(seed, doc) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by seed and document: rows that link, the rows they link to, and of each row the first row of
    its seed and the first one of its seed and document. Every row links to the last row of the document before and to the
    first row of its seed, if that is another document's."""
    n = len(seed)
    start = np.r_[True, seed[1:] != seed[:-1]] if n else np.zeros(0, bool)
    fresh = start | np.r_[True, doc[1:] != doc[:-1]] if n else start
    first = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    own = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    later = np.flatnonzero(own != first)
    before = own[later] - 1
    far = later[first[later] != before]
    return np.concatenate([later, far]), np.concatenate([before, first[far]]), first, own


def _long_seeds(rows: Iterator[pa.RecordBatch], rules: Rules, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Of each task: the links within it, and each seed's occurrences in the first document, which link to nothing yet."""
    schema = arrow_schema(LINKS)
    held, size = [], 0

    def flush():
        seed, doc, pos = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((pos, doc, seed))
        seed, doc, pos = seed[order], doc[order], pos[order]
        again = (seed[1:] == seed[:-1]) & (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1])  # of rows that repeat a document
        seed, doc, pos = (x[np.r_[True, ~again][: len(x)]] for x in (seed, doc, pos))
        left, right, first, own = link_sorted(seed, doc)
        firsts = np.flatnonzero(own == first)
        for at in range(0, len(left), 100_000):
            a, b = left[at : at + 100_000], right[at : at + 100_000]
            yield _link_batch(seed[a], doc[a], pos[a], pa.array(doc[b]), pa.array(pos[b]))
        for at in range(0, len(firsts), 100_000):
            a = firsts[at : at + 100_000]
            yield _link_batch(seed[a], doc[a], pos[a], pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32()))

    def _link_batch(seed, doc, pos, *other):
        return pa.RecordBatch.from_arrays([pa.array(seed), pa.array(doc), pa.array(pos), *other], schema=schema)

    for batch in rows:
        for part in pieces_of(batch, "text", 1 << 20):
            text, pos, key = _minimizers(find_words(strings(part.column("text")), lower=True), rules.min_words, rules.long_w)
            doc = part.column("doc_id").cast(pa.int64()).to_numpy(zero_copy_only=False)
            held.append((_long(key), doc[text], pos.astype(np.int32)))
            size += len(key)
            if size > most:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def _across(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by seed and document; the first row of the open seed, the last row of the document before and the last
    row are carried on."""
    schema = arrow_schema(LINKS)
    carry = None
    for batch in rows:
        if not batch.num_rows:
            continue
        seed, doc, pos = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("seed", "doc_id", "pos"))
        if carry is not None:
            seed, doc, pos = (np.concatenate([c, x]) for c, x in zip(carry, (seed, doc, pos), strict=True))
        left, right, first, own = link_sorted(seed, doc)
        if carry is not None:  # links among carried rows were given before
            fresh = left >= len(carry[0])
            left, right = left[fresh], right[fresh]
        yield pa.RecordBatch.from_arrays(
            [pa.array(seed[left]), pa.array(doc[left]), pa.array(pos[left]), pa.array(doc[right]), pa.array(pos[right])],
            schema=schema,
        )
        keep = np.unique([first[-1], max(first[-1], own[-1] - 1), len(seed) - 1])
        carry = seed[keep], doc[keep], pos[keep]


def _complete(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links found within tasks as they are, and those across tasks."""
    done: list[pa.RecordBatch] = []

    def still_open():
        for batch in rows:
            linked = pa.compute.is_valid(batch.column("other_id"))
            done.append(batch.filter(linked).select(names))
            yield batch.filter(pa.compute.invert(linked))

    names = arrow_schema(LINKS).names
    for found in _across(still_open()):
        yield found
        yield from done
        done.clear()
    yield from done


def _long_links(texts: DataFrame, rules: Rules) -> DataFrame:
    found = map_batches(texts, partial(_long_seeds, rules=rules), LINKS)
    # links that are found stay apart from their seed's other rows, so that a hot seed brings a task no more than its firsts
    key = F.when(F.col("other_id").isNull(), F.col("seed")).otherwise(F.xxhash64("doc_id", "pos"))
    dealt = found.repartition(key).sortWithinPartitions("seed", "doc_id", "pos")
    return map_batches(dealt, _complete, LINKS)


SEEDS = "seed long, doc_id long, pos int, size int, copy boolean"


def _held_at(keys: np.ndarray, first: int, size: int, at: list[dict], of_text: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and seeds of a list that a text of ``of_text`` words really has; the others are of a row that repeats its doc_id."""
    pos = np.array([x["pos"] for x in at], np.int64)
    seed = np.array([x["seed"] for x in at], np.int64)
    inner = pos + size <= of_text
    pos, seed = pos[inner], seed[inner]
    own = keys[first + pos] == seed
    return pos[own], seed[own]


def _short_seeds(rows: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """The short seeds of each text; those inside a long seed of ``held``, the ones with an earlier holder, are copies."""
    schema = arrow_schema(SEEDS)
    for batch in rows:
        for part in pieces_of(batch, "text", 1 << 20):
            words = find_words(strings(part.column("text")), lower=True)
            text, pos, key = _minimizers(words, rules.k, rules.w)
            doc = part.column("doc_id").cast(pa.int64()).to_numpy(zero_copy_only=False)
            held = part.column("held")
            has = np.flatnonzero(pa.compute.is_valid(held).to_numpy(zero_copy_only=False))
            copy = np.zeros(len(pos), bool)
            if len(has):
                long_keys = _long(window_keys(words.keys, rules.min_words))
                reach = np.zeros(len(words.keys) + 1, np.int64)  # of each word, the end of the last held seed that has begun
                for i in has.tolist():
                    first, count = int(words.first[i]), int(words.counts[i])
                    at, _ = _held_at(long_keys, first, rules.min_words, held[i].as_py(), count)
                    reach[first + at] = first + at + rules.min_words
                reach = np.maximum.accumulate(reach)  # texts do not overlap, so nor do their ends
                at = words.first[text] + pos
                copy = reach[at] >= at + rules.k
            part_of, pos, key, size = stretches(2 * text + copy, pos, key, rules.k)
            yield from _rows(schema, _short(key), doc[part_of // 2], pos, size, part_of % 2 == 1)


def stretches(text: np.ndarray, pos: np.ndarray, key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of a seed that follow each other by half its words or less as one, with its words. Such a seed has their
    distances as periods, so it tells the words of the whole stretch (as in a word that is said a hundred times)."""
    order = np.lexsort((pos, key, text))
    text, pos, key = text[order], pos[order], key[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (key[1:] != key[:-1]) | (pos[1:] - pos[:-1] > k // 2)][: len(pos)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(pos)][: len(first)] - 1
    return text[first], pos[first], key[first], pos[last] - pos[first] + k


def _rows(schema: pa.Schema, *columns, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + rows], f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


LIGHT = 4  # occurrences of a seed that are linked as they come
BLOCK = 1024  # occurrences of a seed with more that a task compares with as many others


PAIRS = "seed long, doc_id long, pos int, other_id long, other_pos int, size int"


def _pairs(rows: Iterator[pa.RecordBatch], k: int, light: int = LIGHT) -> Iterator[pa.RecordBatch]:
    """Rows sorted by seed, document and position. All pairs of different documents of each seed with up to ``light`` rows, by the
    starts of their stretches and, if these differ in length, by their ends. Of other seeds copies are linked to the first row and
    the document before; the rest gives both ends, linked to nothing."""
    schema = arrow_schema(PAIRS)
    names = ("seed", "doc_id", "pos", "size", "copy")
    carry = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int32, bool)]
    hot = None  # the open seed, if it has more rows than that
    before = [c[:0] for c in carry]  # of it the first row, the last one of the document before and the last one

    def single(*own):
        nonlocal before
        known = len(before[0]) if len(before[0]) and before[0][0] == own[0][0] else 0
        seed, doc, pos, size, copy = own = [np.concatenate([b[:known], c]) for b, c in zip(before, own, strict=True)]
        a, b, first, mine = link_sorted(seed, doc)
        wanted = copy[a] & (a >= known)
        a, b = a[wanted], b[wanted]
        yield from _rows(schema, seed[a], doc[a], pos[a], doc[b], pos[b], np.minimum(size[a], size[b]))
        keep = np.unique([first[-1], max(first[-1], mine[-1] - 1), len(seed) - 1])
        before = [c[keep] for c in own]
        rest = np.flatnonzero(~copy[known:]) + known
        seed, doc, pos, size = seed[rest], doc[rest], pos[rest], size[rest]
        longer = size > k
        seed, doc, pos = np.r_[seed, seed[longer]], np.r_[doc, doc[longer]], np.r_[pos, (pos + size - k)[longer]]
        for at in range(0, len(seed), 100_000):
            own = [pa.array(x[at : at + 100_000], f.type) for x, f in zip((seed, doc, pos), schema, strict=False)]
            n = len(own[0])
            nothing = pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32())
            yield pa.RecordBatch.from_arrays([*own, *nothing], schema=schema)

    def linked(seed, doc, pos, size, copy):
        edges = np.flatnonzero(np.r_[True, seed[1:] != seed[:-1]])
        sizes = np.diff(np.r_[edges, len(seed)])
        many = np.repeat(sizes > light, sizes)
        if many.any():
            yield from single(seed[many], doc[many], pos[many], size[many], copy[many])
        first, later = np.repeat(edges, sizes), np.flatnonzero(~many)
        for back in range(1, light):
            later = later[later - back >= first[later]]
            if not len(later):
                break
            a = later[doc[later] != doc[later - back]]
            b = a - back
            yield from _rows(schema, seed[a], doc[a], pos[a], doc[b], pos[b], np.minimum(size[a], size[b]))
            a = a[size[a] != size[b]]
            b = a - back
            least = np.minimum(size[a], size[b])
            yield from _rows(schema, seed[a], doc[a], (pos + size)[a] - least, doc[b], (pos + size)[b] - least, least)

    for batch in rows:
        own = [np.concatenate([c, batch.column(n).to_numpy(zero_copy_only=False)]) for c, n in zip(carry, names, strict=True)]
        if hot is not None:
            more = int(np.searchsorted(own[0], hot, side="right"))
            if more:
                yield from single(*(c[:more] for c in own))
            own = [c[more:] for c in own]
            carry = own
        if not len(own[0]):
            continue
        cut = int(np.searchsorted(own[0], own[0][-1]))
        hot = None
        if cut:
            yield from linked(*(c[:cut] for c in own))
        carry = [c[cut:] for c in own]
        if len(carry[0]) > light:
            hot = int(carry[0][0])
            yield from single(*carry)
            carry = [c[:0] for c in carry]
    if len(carry[0]):
        yield from linked(*carry)


CONTEXTS = "seed long, doc_id long, pos int, blocks long, lead boolean, words binary"


def _drift(rules: Rules) -> int:
    """Words by which the two sides of ``min_words`` words can be shifted at ``min_identity``."""
    return int(rules.min_words / rules.min_identity) - rules.min_words


def _contexts(rows: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """Of each seed in ``held`` the words around it as 16-bit keys, as far as ``min_words`` words with it and their drift reach.
    0 stands for no word."""
    schema, side = arrow_schema(CONTEXTS), rules.min_words - rules.k + _drift(rules)
    width = 2 * side + rules.k
    for batch in rows:
        for part in pieces_of(batch, "text", 1 << 20):
            words = find_words(strings(part.column("text")), lower=True)
            short_keys = _short(window_keys(words.keys, rules.k))
            small = (words.keys >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
            for i, (doc, held) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("held").to_pylist(), strict=True)):
                first, count = int(words.first[i]), int(words.counts[i])
                pos, seed = _held_at(short_keys, first, rules.k, held, count)
                known = {(x["seed"], x["pos"]): (x["blocks"], x["lead"]) for x in held}
                padded = np.r_[np.zeros(side, np.uint16), small[first : first + count], np.zeros(side, np.uint16)]
                for at in range(0, len(pos), 2_000):
                    own, where = seed[at : at + 2_000], pos[at : at + 2_000]
                    around = np.lib.stride_tricks.sliding_window_view(padded, width)[where]
                    edges = np.arange(len(own) + 1, dtype=np.int32) * (2 * width)
                    binary = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(edges), pa.py_buffer(around.tobytes())])
                    more = [known[x] for x in zip(own.tolist(), where.tolist(), strict=True)]
                    columns = own, np.full(len(own), doc), where, *zip(*more, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)), binary], schema=schema
                    )


def _features(words: np.ndarray) -> np.ndarray:
    """For each row counts of (word, how many of it came before in the row), hashed to 1,024 columns. The product of two rows is at
    least the number of words they share, each as often as both have it."""
    n, width = words.shape
    order = np.argsort(words, axis=1, kind="stable")
    ranked = np.take_along_axis(words, order, 1).astype(np.int64)
    start = np.c_[np.ones((n, 1), bool), ranked[:, 1:] != ranked[:, :-1]]
    at = np.arange(width)
    nth = at - np.maximum.accumulate(np.where(start, at, 0), axis=1)
    column = ((ranked * 40503 + nth * 2654435761) >> 5) & 1023
    row = np.broadcast_to(np.arange(n)[:, None], column.shape)
    counted = np.bincount((row * 1024 + column)[ranked > 0], minlength=n * 1024)
    return counted.reshape(n, 1024).astype(np.float32)


def alike(a: np.ndarray, b: np.ndarray, rules: Rules) -> np.ndarray:
    """Of pairs of contexts, where the last ``min_words`` words with the seed begin of which a share of ``min_identity`` is in the
    other context too, shifted by no more than the drift; -1 if there are none. It counts from where the first could begin."""
    side, drift = rules.min_words - rules.k, _drift(rules)
    inner = slice(drift, drift + 2 * side + rules.k)
    own = a[:, inner]
    there = np.zeros(own.shape, bool)
    for shift in range(2 * drift + 1):
        there |= own == b[:, shift : shift + own.shape[1]]
    there &= own > 0
    sums = np.cumsum(np.c_[np.zeros(len(a), np.int32), there.astype(np.int32)], axis=1)
    enough = sums[:, rules.min_words :] - sums[:, : -rules.min_words] >= int(rules.min_words * rules.min_identity)
    return np.where(enough, np.arange(enough.shape[1]), -1).max(axis=1)


ANCHORS = "doc_id long, pos int, other_id long, other_pos int, size int"
COMPARED = 2_000  # contexts, of whole groups, that are worked on at once


def _extended(same: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows that tell which words are equal from a seed outwards: the equal run, and what ``extension`` gives ``reach`` beyond it."""
    run = np.cumprod(same, axis=1, dtype=np.int32).sum(axis=1)
    score = np.cumsum(np.where(same, 1, -2), axis=1)
    score[np.arange(same.shape[1]) >= (run + reach)[:, None]] = -2 * same.shape[1] - 1
    best = score.argmax(axis=1)
    row = np.arange(len(same))
    length = np.where(score[row, best] > 0, best + 1, 0)
    return run, length, (score[row, best] + 2 * length) // 3 * (length > 0)


def _made(words: np.ndarray, x: np.ndarray, y: np.ndarray, rules: Rules, part: int = 10_000) -> np.ndarray:
    """Of pairs of contexts: 1 if the seed alone makes a passage, as ``judged`` would find it, 2 if the equal runs around it do, too,
    else 0."""
    side = (words.shape[1] - rules.k) // 2
    out = np.zeros(len(x), np.int8)
    for at in range(0, len(x), part):
        own = slice(at, at + part)
        same = (words[x[own]] == words[y[own]]) & (words[x[own]] > 0)
        for kind, reach in ((2, side), (1, rules.reach)):
            behind, left, left_same = _extended(same[:, :side][:, ::-1], reach - (rules.w - rules.k))
            ahead, right, right_same = _extended(same[:, side + rules.k :], reach)
            span = rules.k + left + right
            good = (span >= rules.min_words) & (rules.k + left_same + right_same >= rules.min_identity * span)
            out[own][good & (behind + ahead > 0)] = kind  # a seed without equal words beside it gives no chain
    return out


def _runs(words: np.ndarray, x: np.ndarray, y: np.ndarray, kind: np.ndarray, rules: Rules, part: int = 10_000):
    """Of pairs of contexts the number of the pair, the begin (counted from the seed's) and the words of the run of equal words with the
    seed, and where ``kind`` is 2 of all runs as far as the passage reaches. Runs begin so late that the unequal words before them are
    not taken for the unknown ones between two seeds; those of the seed keep a word more than it has, which a chain needs."""
    side = (words.shape[1] - rules.k) // 2
    for at in range(0, len(x), part):
        own = slice(at, at + part)
        same = (words[x[own]] == words[y[own]]) & (words[x[own]] > 0)
        behind, left, _ = _extended(same[:, :side][:, ::-1], side)
        ahead, right, _ = _extended(same[:, side + rules.k :], side)
        many = kind[own] == 2
        low, high = side - np.where(many, left, behind), side + rules.k + np.where(many, right, ahead)
        place = np.arange(words.shape[1])
        same &= (place >= low[:, None]) & (place < high[:, None])
        same[:, side : side + rules.k] = True
        edges = np.diff(np.pad(same, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (pair, begin), (_, end) = np.nonzero(edges == 1), np.nonzero(edges == -1)
        whole = (begin <= side) & (end >= side + rules.k)
        begin = begin + np.minimum(rules.w - rules.k, np.where(whole, np.maximum(end - begin - rules.k - 1, 0), end - begin))
        some = end > begin
        yield at + pair[some], begin[some] - side, (end - begin)[some]


def spanning(
    group: np.ndarray, class_of: np.ndarray, a: np.ndarray, b: np.ndarray, made
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs of rows, sorted by ``b`` and of increasing groups: those that span the classes of the pairs for which
    ``made(pairs)`` holds, the pairs for which it does not, and the classes then. Rows come in order of their documents and
    ``b`` is the earlier one, so each row with an earlier one in its class is linked to such a one, the first it makes a pair with."""
    todo, kept, failed = np.arange(len(a)), [], []
    while len(todo):
        todo = todo[class_of[a[todo]] != class_of[b[todo]]]
        if not len(todo):
            break
        own = group[b[todo]]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        pivot = np.repeat(b[todo[first]], np.diff(np.r_[first, len(todo)]))
        now = b[todo] == pivot  # the earliest row of each group
        asked, todo = todo[now], todo[~now]
        good = made(asked)
        failed.append(asked[~good])
        asked = asked[good]
        _, one = np.unique(class_of[a[asked]], return_index=True)
        kept.append(asked[one])
        merged = np.arange(len(group))
        merged[class_of[a[asked]]] = class_of[b[asked]]
        class_of = merged[class_of]
    return *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (kept, failed)), class_of


def _compare(rows: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """Rows sorted by seed, pair of blocks, document and position. Links of the pairs that are alike, with the run of equal words
    that holds the seed, or all runs that a passage needs: a spanning tree of each class, and every pair of different classes. The seed's first row, which is in no
    block, is in every group, so its class needs no links between blocks; its own links are given where a block meets itself."""
    schema, least = arrow_schema(ANCHORS), int(rules.min_words * rules.min_identity)
    names = ("seed", "low", "high", "block", "doc_id", "pos")

    def compared(columns, words):
        seed, low, high, block, doc, pos = columns
        words = np.frombuffer(b"".join(words), np.uint16).reshape(len(doc), -1)
        new = np.r_[True, (seed[1:] != seed[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
        begins, group, class_of = np.flatnonzero(new), np.cumsum(new), np.arange(len(doc))
        ends = np.r_[begins[1:], len(doc)]
        features = np.concatenate([_features(words[at : at + COMPARED]) for at in range(0, len(doc), COMPARED)])
        linked, apart = [], []
        for after in range(0, int((ends - begins).max()), 256):  # the pairs with these rows of each group as the earlier one
            pairs = []
            for begin, end in zip((begins + after).tolist(), ends.tolist(), strict=True):
                if begin < end - 1:
                    y, x = np.nonzero(features[begin : min(begin + 256, end)] @ features[begin:end].T >= least)
                    pairs.append((x + begin, y + begin))
            if not pairs:
                break
            a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
            wanted = (doc[a] > doc[b]) & ((block[a] != block[b]) | (low[a] == high[a]))
            a, b = a[wanted], b[wanted]
            kept, failed, class_of = spanning(group, class_of, a, b, lambda asked, a=a, b=b: _made(words, a[asked], b[asked], rules) > 0)
            linked.append((a[kept], b[kept]))
            apart.append((a[failed], b[failed]))
        if not linked:
            return
        a, b = (np.concatenate(x) for x in zip(*apart, strict=True))
        different = class_of[a] != class_of[b]
        a, b = a[different], b[different]
        for at in range(0, len(a), 20_000):
            x, y = a[at : at + 20_000], b[at : at + 20_000]
            close = np.maximum(alike(words[x], words[y], rules), alike(words[y], words[x], rules)) >= 0
            linked.append((x[close], y[close]))
        x, y = (np.concatenate(x) for x in zip(*linked, strict=True))
        fresh = (block[y] >= 0) | (low[y] == high[y])
        x, y = x[fresh], y[fresh]
        for pair, begin, size in _runs(words, x, y, _made(words, x, y, rules), rules):
            one, other = x[pair], y[pair]
            yield from _rows(schema, doc[one], pos[one] + begin, doc[other], pos[other] + begin, size)

    held, texts = [np.zeros(0, np.int64)] * len(names), []
    for batch in rows:
        held = [np.concatenate([h, batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64)]) for h, n in zip(held, names, strict=True)]
        texts += batch.column("words").to_pylist()
        edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in held[:3]], axis=0)) + 1
        done = 0
        while done < len(held[0]) and len(edges) and edges[-1] > done:
            end = int(edges[max(np.searchsorted(edges, done + COMPARED, side="right") - 1, np.searchsorted(edges, done, side="right"))])
            yield from compared([c[done:end] for c in held], texts[done:end])
            done = end
        held, texts = [c[done:] for c in held], texts[done:]
    if texts:
        yield from compared(held, texts)


def _hot_pairs(texts: DataFrame, rows: DataFrame, rules: Rules) -> DataFrame:
    """Links among the occurrences of seeds that have many. They are dealt to blocks by hash, and every pair of blocks of a
    seed is a group of its own, so what a task holds and what it sends on does not grow with a seed's rows."""
    blocks = rows.groupBy("seed").agg(
        F.ceil(F.count("*") / BLOCK).alias("blocks"), F.min(F.struct("doc_id", "pos")).alias("lead"), F.max("doc_id").alias("last")
    ).filter("lead.doc_id < last")
    lead = F.expr("struct(doc_id, pos) = lead").alias("lead")
    of_doc = rows.join(blocks, "seed").groupBy("doc_id").agg(F.collect_set(F.struct("pos", "seed", "blocks", lead)).alias("held"))
    around = map_batches(texts.join(of_doc, "doc_id"), partial(_contexts, rules=rules), CONTEXTS)
    block = F.when(F.col("lead"), -1).otherwise(F.pmod(F.xxhash64("doc_id", "pos"), "blocks"))
    pairs = F.expr("""if(lead, flatten(transform(sequence(0L, blocks - 1), x -> transform(sequence(x, blocks - 1), y -> struct(x as x, y as y)))),
        transform(sequence(0L, blocks - 1), z -> struct(least(z, block) as x, greatest(z, block) as y)))""")
    dealt = around.withColumn("block", block).withColumn("both", F.explode(pairs))
    dealt = dealt.select(
        "seed", F.col("both.x").alias("low"), F.col("both.y").alias("high"), "block", "doc_id", "pos", "words"
    ).repartition("seed", "low", "high")
    return map_batches(dealt.sortWithinPartitions("seed", "low", "high", "doc_id", "pos"), partial(_compare, rules=rules), ANCHORS)


def anchors(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Links between occurrences of a seed: ``doc_id, pos, other_id, other_pos, size`` with ``other_id < doc_id`` and the
    words that are equal from there on. Rows that repeat a document repeat its links."""
    texts = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    long = stage_table(_long_links(texts, rules), "long-links")
    held = long.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "seed")).alias("held"))
    seeds = map_batches(texts.join(held, "doc_id", "left"), partial(_short_seeds, rules=rules), SEEDS)
    found = map_batches(seeds.repartition("seed").sortWithinPartitions("seed", "doc_id", "pos"), partial(_pairs, k=rules.k), PAIRS)
    found = stage_table(found, "short-links")
    long = long.select("doc_id", "pos", "other_id", "other_pos", F.lit(rules.min_words).alias("size"))
    short = found.filter("other_id is not null").drop("seed")
    hot = _hot_pairs(texts, found.filter("other_id is null").select("seed", "doc_id", "pos"), rules)
    return long.unionAll(short).unionAll(hot)


class Fenwick:
    """Prefix maxima with the number that gave them."""

    def __init__(self, size: int):
        self.size, self.best = size, [(float("-inf"), -1)] * (size + 1)

    def put(self, place: int, value: float, number: int) -> None:
        entry = (value, number)
        while place <= self.size:
            if entry > self.best[place]:
                self.best[place] = entry
            place += place & -place

    def top(self, place: int) -> tuple[float, int]:
        """The greatest value at places up to this one."""
        out = (float("-inf"), -1)
        while place > 0:
            if self.best[place] > out:
                out = self.best[place]
            place -= place & -place
        return out


def chains(segments: list[tuple[int, int, int]], cost: float) -> list[list[int]]:
    """Chains of segments ``(start, other start, words)``, best first; each segment is in one chain at most.

    A chain's score is its words less ``cost`` times the words of its gaps in both texts."""
    n = len(segments)
    if n == 1:
        return [[0]]
    ranks = {p: i + 1 for i, p in enumerate(sorted({s[1] + s[2] for s in segments}))}
    ends = sorted(ranks)
    by_start = sorted(range(n), key=lambda i: segments[i][:2])
    by_end = sorted(range(n), key=lambda i: segments[i][0] + segments[i][2])
    tree, score, back, done = Fenwick(len(ends)), [0.0] * n, [-1] * n, 0
    from bisect import bisect_right

    for j in by_start:
        start, other, words = segments[j]
        while done < n and segments[by_end[done]][0] + segments[by_end[done]][2] <= start:
            i = by_end[done]
            end, other_end = segments[i][0] + segments[i][2], segments[i][1] + segments[i][2]
            tree.put(ranks[other_end], score[i] + cost * (end + other_end), i)
            done += 1
        value, i = tree.top(bisect_right(ends, other))
        gained = value - cost * (start + other)
        score[j], back[j] = (words + gained, i) if i >= 0 and gained > 0 else (float(words), -1)
    used, out = [False] * n, []
    for j in sorted(range(n), key=lambda i: (-score[i], i)):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(j)
            j = back[j]
        if chain:
            out.append(chain[::-1])
    return out


def needed(starts: np.ndarray, words: np.ndarray, enough: int) -> np.ndarray:
    """The segments of a pair to go on with. Of those of ``enough`` words, each a passage by itself, the fewest that hold the
    same words of the document, which matters where a text repeats itself; others unless they lie inside one of these."""
    ends = starts + words
    long = np.flatnonzero(words >= enough)
    if not len(long):
        return np.arange(len(starts))
    order = long[np.lexsort((-ends[long], starts[long]))]
    kept, reach, best = [], -1, -1
    for i in order.tolist():
        if best >= 0 and starts[i] > reach:  # nothing later reaches what is not held yet better than the best one
            kept.append(best)
            reach, best = int(ends[best]), -1
        if ends[i] > reach and (best < 0 or ends[i] > ends[best]):
            best = i
            if starts[i] > reach:
                kept.append(best)
                reach, best = int(ends[best]), -1
    if best >= 0:
        kept.append(best)
    kept = np.array(kept)
    by_start = kept[np.argsort(starts[kept], kind="stable")]
    rest = np.flatnonzero(words < enough)
    at = np.searchsorted(starts[by_start], starts[rest], side="right")
    held = np.r_[-1, np.maximum.accumulate(ends[by_start])][at]
    return np.sort(np.concatenate([kept, rest[ends[rest] > held]]))


def apart(found: list[tuple[int, list[int], list[int]]], enough: int) -> list[int]:
    """Of a document's chains ``(other document, starts, words)`` the numbers of those that do not lie inside one
    segment of ``enough`` words of another; of such segments with equal spans the one with the smallest document counts."""
    marks = []
    for i, (other, starts, words) in enumerate(found):
        marks += [(a, -a - n, False, other, i) for a, n in zip(starts, words, strict=True) if n >= enough]
        marks.append((starts[0], -starts[-1] - words[-1], True, other, i))
    reach, holder, kept = -1, -1, []
    for _, end, whole, _, i in sorted(marks):
        if whole and (holder == i or reach < -end):
            kept.append(i)
        elif not whole and -end > reach:
            reach, holder = -end, i
    return sorted(kept)


CHAINS = "doc_id long, other_id long, starts array<int>, others array<int>, words array<int>, covered long"


def _chain(rows: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pair, diagonal and position; a document may go on in the next batch."""
    schema = arrow_schema(CHAINS)
    names = ("doc_id", "other_id", "pos", "other_pos", "size")
    rest = [np.zeros(0, np.int64)] * 5

    def chained(doc, other, pos, other_pos, size):
        out = {name: [] for name in schema.names}
        if not len(doc):
            return out
        diagonal = pos - other_pos
        new_pair = np.r_[True, (doc[1:] != doc[:-1]) | (other[1:] != other[:-1])]
        new_line = new_pair | np.r_[True, diagonal[1:] != diagonal[:-1]]
        end = pos + size
        # the farthest end so far on the diagonal; lines are kept apart by their number in the upper bits
        line = np.cumsum(new_line) << 32
        far = np.maximum.accumulate(line + end) - line
        before = np.where(new_line, pos, np.r_[0, far[:-1]])
        new = new_line | (pos - before > rules.w - rules.k)
        first = np.flatnonzero(new)
        last = np.r_[first[1:] - 1, len(doc) - 1]
        words = far[last] - pos[first]
        covered = np.add.reduceat(np.maximum(end - np.maximum(before, pos), 0), first)
        pair = np.cumsum(new_pair)[first]
        edges = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        total = np.add.reduceat(covered, edges)
        of_doc: dict[int, list] = {}
        for a, b in zip(edges[total > rules.k], np.r_[edges[1:], len(pair)][total > rules.k], strict=True):
            take = a + needed(pos[first[a:b]], words[a:b], rules.min_words)
            found = list(zip(pos[first[take]].tolist(), other_pos[first[take]].tolist(), words[take].tolist(), strict=True))
            for chain in chains(found, rules.gap_cost):
                own = int(sum(covered[take[i]] for i in chain))
                if own > rules.k:
                    starts, others, sizes = ([found[i][place] for i in chain] for place in range(3))
                    of_doc.setdefault(int(doc[first[a]]), []).append((int(other[first[a]]), starts, others, sizes, own))
        for number, own in of_doc.items():
            for i in apart([(c[0], c[1], c[3]) for c in own], rules.min_words):
                for name, value in zip(schema.names, (number, *own[i]), strict=True):
                    out[name].append(value)
        return out

    for batch in rows:
        columns = [np.concatenate([r, batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)]) for r, c in zip(rest, names, strict=True)]
        doc = columns[0]
        if not len(doc):
            continue
        open_ = np.flatnonzero(doc != doc[-1])
        cut = int(open_[-1]) + 1 if len(open_) else 0
        rest = [c[cut:] for c in columns]
        yield from batches(chained(*(c[:cut] for c in columns)), schema)
    yield from batches(chained(*rest), schema)


FETCHED = "chain long, side int, sizes array<int>, keys array<int>"


def _regions(starts: list[int], words: list[int], reach: int) -> list[tuple[int, int]]:
    """The words before a chain, in each of its gaps and after it."""
    ends = [s + n for s, n in zip(starts, words, strict=True)]
    return [(max(0, starts[0] - reach), starts[0]), *zip(ends[:-1], starts[1:], strict=True), (ends[-1], ends[-1] + reach)]


def _fetch(rows: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """The 32-bit keys of the asked words of each text. A row has a text and some requests."""
    schema = arrow_schema(FETCHED)
    for batch in rows:
        for part in pieces_of(batch, "text"):
            words = find_words(strings(part.column("text")), lower=True)
            keys = (words.keys >> np.uint64(33)).astype(np.int32)
            out = {name: [] for name in schema.names}
            for i, requests in enumerate(part.column("requests").to_pylist()):
                own = keys[words.first[i] : words.first[i + 1]]
                for request in requests:
                    got = [own[a:b] for a, b in _regions(request["starts"], request["words"], reach)]
                    out["chain"].append(request["chain"])
                    out["side"].append(request["side"])
                    out["sizes"].append([len(x) for x in got])
                    out["keys"].append(np.concatenate(got))
            yield from batches(out, schema)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the longest common subsequence of two short runs."""
    if len(a) == len(b) and ((same := int((a == b).sum())) >= len(a) - 1 or len(a) <= 2):
        return same
    before = np.zeros(len(b) + 1, np.int64)
    for x in a:
        now = before.copy()
        now[1:] = np.maximum(before[1:], before[:-1] + (b == x))
        before = np.maximum.accumulate(now)
    return int(before[-1])


def extension(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Length and equal words of the best common beginning: equal words less twice the unequal ones is greatest."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    best = int(score.argmax())
    return (best + 1, int(same[: best + 1].sum())) if score[best] > 0 else (0, 0)


def judged(starts, others, words, own, other, rules: Rules) -> list[tuple[int, int, int, int, float]]:
    """The passages of an aligned chain: ``start, end, other start, other end, identity``.

    ``own`` and ``other`` are the words before the chain, in each gap and after it. A chain that passes is one passage. Of a
    chain that does not, the parts (runs of its segments, extended into the gaps beside them) that pass and do not share a
    segment and hold the most words together, in the fewest parts."""
    left, left_same = extension(own[0][::-1], other[0][::-1])
    right, right_same = extension(own[-1], other[-1])
    start, end, other_start, other_end = starts[0] - left, starts[-1] + words[-1] + right, others[0] - left, others[-1] + words[-1] + right
    if min(end - start, other_end - other_start) < rules.min_words:
        return []
    gaps = [common(a, b) for a, b in zip(own[1:-1], other[1:-1], strict=True)]
    # words inside a segment lie between seeds of one diagonal, at most w - k in a row without a seed
    identity = (left_same + right_same + sum(words) + sum(gaps)) / max(end - start, other_end - other_start)
    if identity >= rules.min_identity:
        return [(start, end, other_start, other_end, identity)]
    if len(words) == 1:
        return []
    starts, others, words = (np.array(x, np.int64) for x in (starts, others, words))
    before = np.array([extension(a[::-1], b[::-1]) for a, b in zip(own[:-1], other[:-1], strict=True)]).T
    after = np.array([extension(a, b) for a, b in zip(own[1:], other[1:], strict=True)]).T
    same = np.cumsum(words + np.array([0, *gaps]))  # of the chain up to a segment

    def parts(i, j):
        """Of the parts from segments ``i`` to segment ``j``."""
        left, right = before[0][i], after[0][j]
        span = starts[i] - left, starts[j] + words[j] + right, others[i] - left, others[j] + words[j] + right
        own_words, other_words = span[1] - span[0], span[3] - span[2]
        equal = same[j] - same[i] + words[i] + before[1][i] + after[1][j]
        identity = equal / np.maximum(own_words, other_words)
        return span, identity, (np.minimum(own_words, other_words) >= rules.min_words) & (identity >= rules.min_identity)

    def passage(i, j):
        span, identity, _ = parts(i, j)
        return (*(int(x) for x in span), float(identity))

    last = len(words) - 1
    best, fewest, begin = np.zeros(last + 2, np.int64), np.zeros(last + 2, np.int64), np.full(last + 2, -1)
    for j in range(last + 1):
        best[j + 1], fewest[j + 1] = best[j], fewest[j]
        i = np.arange(j + 1)
        span, _, good = parts(i, j)
        if good.any():
            i = i[good]
            held = best[i] + (span[1] - span[0])[good]
            pick = np.lexsort((fewest[i], -held))[0]
            if held[pick] > best[j + 1]:
                best[j + 1], fewest[j + 1], begin[j + 1] = held[pick], fewest[i[pick]] + 1, i[pick]
    out, j = [], last + 1
    while j > 0:
        if begin[j] >= 0:
            out.append(passage(int(begin[j]), j - 1))
            j = int(begin[j])
        else:
            j -= 1
    return out[::-1]


PASSAGES = "doc_id long, other_id long, start_word long, end_word long, other_start long, other_end long, identity double"


def _ends(keys: pa.ListArray, sizes: pa.ListArray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Of chains the words before, read backwards, and those after, as rows of ``reach`` words; -1 where there are none."""
    flat = np.append(keys.values.to_numpy(), np.int32(0)).astype(np.int64)
    counts, of = sizes.values.to_numpy(), sizes.offsets.to_numpy()
    begin, end = keys.offsets.to_numpy()[:-1, None], keys.offsets.to_numpy()[1:, None]
    before, after = counts[of[:-1]][:, None], counts[of[1:] - 1][:, None]
    at = np.arange(reach)
    return tuple(
        np.where(at < n, flat[np.clip(place, 0, len(flat) - 1)], -1)
        for n, place in ((before, begin + before - 1 - at), (after, end - after + at))
    )


def _long_enough(batch: pa.RecordBatch, rules: Rules) -> np.ndarray:
    """Of chains where both sides have ``min_words`` words with the ends by which ``judged`` extends them."""
    kept = batch.num_rows
    own = _ends(batch.column("keys"), batch.column("sizes"), rules.reach)
    other = _ends(batch.column("other_keys"), batch.column("other_sizes"), rules.reach)
    beside = np.zeros(kept, np.int64)
    for a, b in zip(own, other, strict=True):
        score = np.cumsum(np.where((a >= 0) & (b >= 0), np.where(a == b, 1, -2), -2), axis=1)
        best = score.argmax(axis=1)
        beside += np.where(score[np.arange(kept), best] > 0, best + 1, 0)
    of, words = batch.column("words").offsets.to_numpy(), batch.column("words").values.to_numpy()
    least = np.full(kept, np.iinfo(np.int64).max)
    for side in ("starts", "others"):
        starts, at = batch.column(side).values.to_numpy(), batch.column(side).offsets.to_numpy()
        least = np.minimum(least, starts[at[1:] - 1].astype(np.int64) + words[of[1:] - 1] - starts[at[:-1]] + beside)
    return least >= rules.min_words


def _align(rows: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(PASSAGES)
    for batch in rows:
        if not batch.num_rows:
            continue
        out = {name: [] for name in schema.names}
        for row in batch.filter(pa.array(_long_enough(batch, rules))).to_pylist():
            own, other = (
                np.split(np.array(row[keys], np.int32), np.cumsum(row[sizes])[:-1])
                for keys, sizes in (("keys", "sizes"), ("other_keys", "other_sizes"))
            )
            for start, end, other_start, other_end, identity in judged(row["starts"], row["others"], row["words"], own, other, rules):
                values = (row["doc_id"], row["other_id"], start, end, other_start, other_end, identity)
                for name, value in zip(schema.names, values, strict=True):
                    out[name].append(value)
        yield from batches(out, schema)


REQUESTS = 128  # of one text in a row


def passages(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``doc_id, other_id, start_word, end_word, other_start, other_end, identity``: word spans of each passage
    in the later document and in an earlier one that holds it. Ends are exclusive."""
    found = anchors(docs, rules)
    # the links of one document with all others, so that passages inside another's exact copy can be told
    dealt = found.repartition("doc_id").sortWithinPartitions(
        "doc_id", "other_id", F.col("pos") - F.col("other_pos"), "pos"
    )
    chained = map_batches(dealt, partial(_chain, rules=rules), CHAINS)
    chained = stage_table(chained.withColumn("chain", F.monotonically_increasing_id()), "chains")
    request = lambda doc, starts, side: chained.select(
        F.col(doc).alias("doc_id"), F.struct("chain", F.lit(side).alias("side"), F.col(starts).alias("starts"), "words").alias("request")
    )
    requests = request("doc_id", "starts", 0).unionAll(request("other_id", "others", 1))
    counted = requests.groupBy("doc_id").agg(F.ceil(F.count("*") / REQUESTS).alias("parts"))
    part = F.pmod(F.xxhash64("request.chain"), "parts").alias("part")
    grouped = requests.join(counted, "doc_id").groupBy("doc_id", part).agg(F.collect_list("request").alias("requests"))
    texts = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    fetched = map_batches(
        grouped.join(texts, "doc_id").select("text", "requests"), partial(_fetch, reach=rules.reach), FETCHED
    )
    fetched = stage_table(fetched, "chain-words")
    own = fetched.filter("side = 0").select("chain", "sizes", "keys")
    other = fetched.filter("side = 1").select("chain", F.col("sizes").alias("other_sizes"), F.col("keys").alias("other_keys"))
    both = chained.join(own, "chain").join(other, "chain").drop("chain", "covered")
    return map_batches(both, partial(_align, rules=rules), PASSAGES)


def _cut(rows: Iterator[pa.RecordBatch], spans: str) -> Iterator[pa.RecordBatch]:
    """The texts without the words of their spans. Text between the kept words stays as it is."""
    for batch in rows:
        for part in pieces_of(batch, "text"):
            at = part.schema.get_field_index("text")
            words = find_words(strings(part.column("text")))
            texts = part.column("text").to_pylist()
            for i, own in enumerate(part.column(spans).to_pylist()):
                if not own:
                    continue
                base, first = int(words.offsets[i]), int(words.first[i])
                raw = texts[i].encode()
                count = int(words.first[i + 1]) - first
                gone = np.zeros(count, bool)
                for span in own:
                    gone[span["start_word"] : span["end_word"]] = True
                starts = np.append(words.starts[first : first + count] - base, len(raw))
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                kept, last = [], 0
                for a, b in zip(edges[::2], edges[1::2], strict=True):
                    kept.append(raw[last : starts[a]])
                    last = int(starts[b])
                texts[i] = b"".join([*kept, raw[last:]]).decode().strip()
            column = pa.array(texts, part.schema.field(at).type)
            yield part.set_column(at, part.schema.field(at), column).drop_columns([spans])


def without_repeats(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents without the passages that an earlier document holds. A text of which nothing is left is dropped;
    ``n_chars``, where there is one, is that of the text that is left."""
    spans = fresh_name(docs, "spans")
    found = passages(docs, rules).groupBy("doc_id").agg(
        F.collect_set(F.struct("start_word", "end_word")).alias(spans)
    )
    joined = docs.join(found, "doc_id", "left").select(*docs.columns, spans)
    length = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    out = map_batches(joined, partial(_cut, spans=spans), docs.schema).filter("text is null or text <> ''")
    return out.withColumn("n_chars", length).select(*docs.columns) if length is not None else out

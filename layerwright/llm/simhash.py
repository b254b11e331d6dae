"""SimHash near-duplicates: fingerprints of word shingles, linked at a few differing bits.

A fingerprint bit is set if it is set in over half of the hashes of a text's shingles. The distinct fingerprints are
dealt by pigeonhole: of five blocks of bits at least one is equal in two fingerprints that differ in four bits, so each
fingerprint goes to one group per block. Within a group ``GrayIndex`` sorts the fingerprints by Gray rank, which puts
those with long equal bit patterns side by side, and folds runs of neighbours into nodes that keep the mask of the bits
their members share and those bits. A search adds up the differing shared bits and leaves whole nodes once the
sum exceeds the limit. A group gives links that connect its members, not all pairs; components of these links are the
components of all links.

Groups that hold more fingerprints than ``GROUP`` are dealt into chunks by a hash, and every pair of chunks becomes
a group, so no task holds more than about two chunks.

Defined results. A null, empty or blank text has no shingle and fingerprint zero, linked like any other. Repeated rows
are linked, as they have the same fingerprint. A null doc_id keeps its fingerprint; its component is the smallest
doc_id that is not null, or null. Columns other than doc_id and text are not looked at. An empty table gives no rows.
A very long text is never cut; one task holds its words and hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.components import components
from layerwright.llm.spark import arrow_schema, fresh_name, map_batches, pieces_of, stage_table, strings

SEED = 42
GROUP = 4096
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprints(texts: pa.StringArray, shingle: int = 4) -> np.ndarray:
    """The fingerprint of each text."""
    hashes, sizes = [], []
    hash_of = xxhash.xxh64_intdigest
    for text in texts.to_pylist():
        words = text.encode().translate(_LOWER).split()
        if len(words) <= shingle:
            spans = [b" ".join(words)] if words else []
        else:
            spans = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
        own = [hash_of(span, SEED) for span in spans]
        hashes += own
        sizes.append(len(own))
    return majority(np.array(hashes, np.uint64), np.array(sizes, np.int64))


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per run of ``sizes`` hashes, the number with the bits set that over half of the run has set."""
    out = np.zeros(len(sizes), np.uint64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    starts = offsets[:-1][filled]
    for bit in range(64):
        ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), starts)
        out[filled] |= (2 * ones > sizes[filled].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


FINGERPRINTED = "doc_id long, mark long, code long"


def _fingerprint(rows: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(FINGERPRINTED)
    for batch in rows:
        for part in pieces_of(batch, "text", 2 << 20):
            codes = fingerprints(strings(part.column("text")), shingle).view(np.int64)
            own = part.column("doc_id").cast(pa.int64()), part.column("mark")
            yield pa.RecordBatch.from_arrays([*own, pa.array(codes)], schema=schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each number in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Distinct fingerprints in Gray order under nodes of ``fan`` neighbours, level above level.

    A node holds the mask of bits that are equal in all its members and are not in its parent's mask, with their
    values, so that each bit counts once on the way down."""

    def __init__(self, codes: np.ndarray, fan: int = 8):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        masks, values = [np.full(len(codes), ~np.uint64(0))], [self.codes]
        while len(masks[-1]) > 1:
            size = len(masks[-1])
            starts = np.arange(0, size, fan)
            ones = np.bitwise_and.reduceat(values[-1] & masks[-1], starts)
            zeros = np.bitwise_and.reduceat(~values[-1] & masks[-1], starts)
            masks.append(ones | zeros)
            values.append(ones)
        self.fan, self.levels = fan, []
        for level, (mask, value) in enumerate(zip(masks, values, strict=True)):
            above = masks[level + 1][np.arange(len(mask)) // fan] if level + 1 < len(masks) else np.uint64(0)
            self.levels.append((mask & ~above, value))

    def links(self, most: int, block: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs ``i < j`` of places in ``codes`` with at most ``most`` differing bits, in blocks of queries.
        A block's pairs go down the levels together."""
        for at in range(0, len(self.codes), block):
            query = np.arange(at, min(at + block, len(self.codes)))
            node, spent = np.zeros(len(query), np.int64), np.zeros(len(query), np.int64)
            for level in range(len(self.levels) - 1, -1, -1):
                mask, value = self.levels[level]
                spent = spent + np.bitwise_count((self.codes[query] ^ value[node]) & mask[node])
                stay = spent <= most
                query, node, spent = query[stay], node[stay], spent[stay]
                if level:
                    below = len(self.levels[level - 1][0])
                    query, spent = np.repeat(query, self.fan), np.repeat(spent, self.fan)
                    node = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
                    # members before the query find it themselves
                    real = (node < below) & ((node + 1) * self.fan ** (level - 1) > query)
                    query, node, spent = query[real], node[real], spent[real]
            later = node > query
            yield query[later], node[later]


def spanning(codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint that is not the first of its component within these, with the first one."""
    index = GrayIndex(codes)
    root = np.arange(len(codes))
    for left, right in index.links(most):
        while len(left):
            a, b = root[left], root[right]
            differ = a != b
            left, right, a, b = left[differ], right[differ], a[differ], b[differ]
            if not len(left):
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    moved = root != np.arange(len(codes))
    return index.codes[moved], index.codes[root[moved]]


LINKS = "src long, dst long"


def _link_groups(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group may go on in the next batch."""
    schema = arrow_schema(LINKS)
    rest_key, rest = np.zeros(0, np.int64), np.zeros(0, np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def link(codes):
        if len(codes) > 1:
            a, b = spanning(np.unique(codes).view(np.uint64), most)
            if len(a):
                found.append((a.view(np.int64), b.view(np.int64)))

    def flush():
        if found:
            src, dst = (np.concatenate(x) for x in zip(*found, strict=True))
            found.clear()
            yield from (pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], schema=schema),)

    for batch in rows:
        key = np.concatenate([rest_key, batch.column("part").to_numpy(zero_copy_only=False)])
        codes = np.concatenate([rest, batch.column("code").to_numpy(zero_copy_only=False)])
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if b - a > 1:
                link(codes[a:b])
        last = int(starts[-1]) if len(starts) else 0
        rest_key, rest = key[last:], codes[last:]
        yield from flush()
    link(rest)
    yield from flush()


def _blocks(count: int) -> list[tuple[int, int]]:
    bounds = [round(64 * i / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _parts(codes: DataFrame, most: int) -> DataFrame:
    """``part, code``: the groups to search. A block's value with more than GROUP fingerprints is dealt in chunks."""
    blocks = F.array(
        *(
            F.struct(F.lit(i).alias("no"), F.shiftrightunsigned("code", at).bitwiseAND((1 << width) - 1).alias("bits"))
            for i, (at, width) in enumerate(_blocks(most + 1))
        )
    )
    dealt = codes.select("code", F.explode(blocks).alias("block")).select("code", "block.no", "block.bits")
    sizes = dealt.groupBy("no", "bits").agg(F.count("*").alias("size"))
    large = sizes.filter(F.col("size") > GROUP)
    # in a large group the chunk is a range of a hash, and a pair of chunks (low, high) is one part
    marked = dealt.join(large, ["no", "bits"], "left")
    chunks = F.ceil(F.col("size") / GROUP).cast("int")
    own = F.when(F.col("size").isNull(), 0).otherwise(F.pmod(F.xxhash64("code"), chunks).cast("int"))
    marked = marked.select("code", "no", "bits", F.coalesce(chunks, F.lit(1)).alias("chunks"), own.alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    pairs = marked.select("code", "no", "bits", "own", other)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return pairs.select(F.xxhash64("no", "bits", low, high).alias("part"), "code")


def linked(docs: DataFrame, most: int = 4, shingle: int = 4) -> DataFrame:
    """``doc_id, code, component_id`` of each document; ``code`` is the fingerprint as a signed 64-bit number."""
    return _grouped(docs, most, shingle).select("doc_id", "code", "component_id")


def _grouped(docs: DataFrame, most: int, shingle: int) -> DataFrame:
    """``doc_id, mark, code, root, component_id``: a mark of the text, and the code that stands for the component."""
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    made = stage_table(map_batches(marked, partial(_fingerprint, shingle=shingle), FINGERPRINTED), "fingerprints")
    first = made.groupBy("code").agg(F.min("doc_id").alias("first"))
    first = stage_table(first, "codes")
    parts = _parts(first.select("code"), most).repartition("part").sortWithinPartitions("part", "code")
    links = stage_table(map_batches(parts, partial(_link_groups, most=most), LINKS).distinct(), "links")
    groups = components(links)
    rooted = first.join(groups, first.code == groups.node, "left").select(
        "code", "first", F.coalesce("component", "code").alias("root")
    )
    # a table of its own, so that adaptive execution may split the join of a hot component
    roots = stage_table(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    named = rooted.join(roots, "root").select("code", "root", "component_id")
    return made.join(named, "code").select("doc_id", "mark", "code", "root", "component_id")


def hex_code(column: str = "code"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def deduplicated(docs: DataFrame, most: int = 4, shingle: int = 4) -> DataFrame:
    """One document of each component, with all columns: that with the smallest doc_id. Of repeated rows one stays. Rows
    that share a doc_id and differ in text count as documents of their own, each in its text's component; where one
    component holds several texts of its smallest doc_id, that with the smallest fingerprint stays. Rows without doc_id
    cannot be told apart and all stay."""
    own = _grouped(docs, most, shingle).filter("doc_id = component_id")
    heads = own.groupBy("root").agg(F.min(F.struct("code", "doc_id", "mark")).alias("head")).select("head.doc_id", "head.mark")
    mark, number = fresh_name(docs, "mark"), fresh_name(docs, "row_number")
    order = Window.partitionBy("doc_id", mark).orderBy(F.xxhash64(*docs.columns))
    heads = heads.withColumnRenamed("mark", mark)
    kept = docs.withColumn(mark, F.xxhash64("text")).join(heads, ["doc_id", mark], "left_semi").select(*docs.columns, mark)
    kept = kept.withColumn(number, F.row_number().over(order)).filter(F.col(number) == 1).select(*docs.columns)
    return kept.unionAll(docs.filter("doc_id is null"))

"""Exact duplicates by content-defined chunk recipes.

A text is normalised (each run of space and U+0009 to U+000D becomes one space) and cut where a rolling hash of its last
32 bytes says so, so equal texts have equal chunks wherever they stand. A chunk gets an identifier, a keyed digest; the
ordered list of a text's identifiers is its recipe. An identifier counts as verified when all chunks that carry it hold
the same bytes: the chunks of texts whose recipe occurs twice travel once per task to the others of their identifier and
are compared there. If two different chunks share an identifier, all identifiers are drawn anew, twice as wide.
After that equal recipes are equal texts, and only recipes, some 16 bytes per 2 KB of text, are grouped.

Which texts must send chunks is told to the tasks by a bitmap of their recipes' marks. It has eight bits per row, at
most ``MOST_BITS`` in all (32 MB); beyond, more texts send chunks than need to, each still once, and nothing else changes.

Defined results. A null text is empty; all empty texts are equal, their recipe has no chunk. Leading and trailing white
space counts (as one space). A text of any length is one value of its task and some ten times its size in memory
there. Of equal texts the smallest doc_id stays, null last; of repeated rows with this doc_id one row stays.
An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, batches, fresh_name, map_batches, pieces_of, stage_table

#: Chunks have 256 to 16,384 bytes, some 2,300 on average; a text's last one may be shorter.
LEAST, MOST, BITS = 256, 16_384, 11
WIDTH = 16  # bytes of an identifier
MOST_BITS = 1 << 28
SPACES = b" \t\n\x0b\x0c\r"
_GEAR = np.random.Generator(np.random.PCG64(12)).integers(0, 1 << 32, 256, dtype=np.uint32)


def normalised(text: bytes) -> bytes:
    inner = b" ".join(text.split())
    if not inner:
        return text and b" "
    return b" " * (text[0] in SPACES) + inner + b" " * (text[-1] in SPACES)


def cut_marks(data: bytes) -> np.ndarray:
    """Places after which the rolling hash of the last 32 bytes asks for a cut."""
    sums = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):  # sums over windows of 2, 4, ... 32 bytes, each byte shifted by its age
        sums[step:] += sums[:-step] << np.uint32(step)
    return np.flatnonzero(sums >> np.uint32(32 - BITS) == 0) + 1


def ends_of(start: int, end: int, marks: list[int]) -> list[int]:
    """The chunk ends of the text at start:end. Marks closer to a chunk's start than LEAST don't cut, so no mark counts
    that looked at bytes before the text."""
    ends, at = [], start
    for mark in marks:
        while mark - at > MOST:
            at += MOST
            ends.append(at)
        if mark - at >= LEAST and mark < end:
            ends.append(mark)
            at = mark
    while end - at > MOST:
        at += MOST
        ends.append(at)
    return [*ends, end] if at < end else ends


def _chunked(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes], list[list[bytes]]]]:
    """For slices of the rows: doc_ids, normalised texts, each text's chunks."""
    for batch in rows:
        for piece in pieces_of(batch, "text"):
            column = piece.column("text").cast(pa.large_binary()).fill_null(b"")
            texts = [normalised(text) for text in column.to_pylist()]
            joined = b"".join(texts)
            marks, chunks, start = cut_marks(joined), [], 0
            bounds = np.concatenate([[0], np.cumsum([len(text) for text in texts])])
            first = np.searchsorted(marks, bounds)
            for i, text in enumerate(texts):
                start = int(bounds[i])
                ends = [0, *(e - start for e in ends_of(start, int(bounds[i + 1]), marks[first[i] : first[i + 1]].tolist()))]
                chunks.append([text[a:b] for a, b in zip(ends, ends[1:], strict=False)])
            yield piece.column("doc_id"), texts, chunks


def identifier(chunk: bytes, width: int) -> bytes:
    return blake2b(chunk, digest_size=width).digest()


def mark_of(recipe: bytes) -> int:
    return int.from_bytes(blake2b(recipe, digest_size=8).digest(), "little") >> 1


RECIPES = "doc_id long, recipe binary, mark long, text_sha256 string"


def _recipes(rows: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(RECIPES)
    for ids, texts, chunks in _chunked(rows):
        made = [b"".join(identifier(chunk, width) for chunk in of) for of in chunks]
        columns = {"doc_id": ids, "recipe": made, "mark": [mark_of(recipe) for recipe in made]}
        yield from batches(columns | {"text_sha256": [sha256(text).hexdigest() for text in texts]}, schema)


CHUNKS = "identifier binary, content binary"


def _chunks(rows: Iterator[pa.RecordBatch], width: int, shared) -> Iterator[pa.RecordBatch]:
    """The chunks of texts whose recipe may occur twice, as the bitmap says."""
    schema, bits = arrow_schema(CHUNKS), np.frombuffer(shared.value, np.uint8)
    for _, _, chunks in _chunked(rows):
        sent: dict[bytes, bytes] = {}
        for of in chunks:
            named = [identifier(chunk, width) for chunk in of]
            place = mark_of(b"".join(named)) % (len(bits) * 8)
            if bits[place >> 3] >> (place & 7) & 1:
                for name, chunk in zip(named, of, strict=True):
                    if sent.setdefault(name, chunk) != chunk:
                        yield from batches({"identifier": [name], "content": [chunk]}, schema)
        yield from batches({"identifier": list(sent), "content": list(sent.values())}, schema, 500)


def shared_bitmap(recipes: DataFrame) -> bytes:
    """One bit per mark of a recipe that occurs at least twice; other marks may share it."""
    rows = recipes.count()
    bits = 1 << min(max(15, (8 * rows).bit_length()), MOST_BITS.bit_length() - 1)
    twice = recipes.groupBy("recipe", "mark").count().filter("count > 1").select((1 + F.col("mark") % bits).alias("place"))
    # a bucket holds 32,768 places; both are counted from 1 up
    buckets = twice.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")
    )
    out = bytearray(bits // 8)
    for bucket, bitmap in buckets.toLocalIterator():
        out[(bucket - 1) * 4096 : bucket * 4096] = bitmap
    return bytes(out)


def recipes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``row, doc_id, recipe, mark, text_sha256`` for each row, as a written table, all identifiers verified."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    while True:
        made = map_batches(texts, partial(_recipes, width=width), RECIPES)
        made = stage_table(made.withColumn("row", F.monotonically_increasing_id()), "recipes")
        shared = docs.sparkSession.sparkContext.broadcast(shared_bitmap(made))
        sent = map_batches(texts, partial(_chunks, width=width, shared=shared), CHUNKS)
        different = sent.groupBy("identifier", "content").agg(F.count("*").alias("n")).groupBy("identifier").count()
        if different.filter("count > 1").isEmpty():
            return made
        width *= 2


def classes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row. Groups merge map-side; the join back
    is by recipe, and adaptive execution splits the rows of a hot one."""
    made = recipes(docs, width)
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    groups = made.groupBy("recipe").agg(F.count("*").alias("group_size"), least)
    # a table of its own, so that adaptive execution may split the join of a hot recipe
    groups = stage_table(groups.select("recipe", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")), "classes")
    joined = made.join(groups, "recipe")
    return joined.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns."""
    digest, number = fresh_name(docs, "text_digest"), fresh_name(docs, "row_number")
    heads = classes(docs).filter("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256")
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    rows = docs.withColumn(digest, F.sha2(text, 256))
    same = rows["doc_id"].eqNullSafe(heads["kept_id"]) & (rows[digest] == heads["text_sha256"])
    order = Window.partitionBy("doc_id", digest).orderBy(F.xxhash64(*docs.columns))
    kept = rows.join(heads, same, "left_semi").withColumn(number, F.row_number().over(order))
    return kept.filter(F.col(number) == 1).select(*docs.columns)

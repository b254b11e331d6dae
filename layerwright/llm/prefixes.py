"""The trie of conversation prefixes, grown as z-fast tries.

A node of depth d is a sequence of d turns (role, text); its members are the conversations that start with it. ``marked``
turns each row into a 128-bit digest of its role and text, ``paths`` chains the digests of a conversation, so a
prefix is one 128-bit key, and no text is moved. Each task inserts the paths it reads, in batches, into a z-fast trie:
compacted nodes stand in a hash table under the key of their handle, the depth in their edge that is divisible by the
largest power of two; a fat binary search over the path's length finds the node where a new path leaves the trie, and
the edge is split there. Then the edges are expanded to one row per depth, and equal nodes of all batches are merged by
a sum, a minimum and a maximum, so a first turn that a third of all conversations share costs one row per batch.

A node belongs to its smallest member, its owner, and a conversation owns all depths of its path from some depth on.
So sums over subtrees need no walk: each member adds, to every node on its path, what it owns there (leaves,
children) or shares with its owner (words saved), and one more aggregation by key sums it up.

Defined results. Turns are ordered by number, null first, then by digest. A null role or text is empty. Rows with a null
conv_id belong to no conversation and are left out. A repeated row is a turn of its own. An empty table has no root
and gives no rows. A conversation of any length is one path, 16 bytes per turn, in the memory of its tasks; long
texts are hashed in place. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, batches, map_batches, stage_table

KEY = 16  # bytes of a prefix's key
ROOT = bytes(KEY)
#: A task starts another trie when its paths have this many bytes.
BATCH_BYTES = 64 << 20
#: Ids of one group whose numbers differ in the last ten bits only are joined to one text before they are sorted.
BUCKET_BITS = 10
NO_END = hashlib.sha256(b"").hexdigest()


def marked(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, words``: a row's digest of role and text, and the number of words of its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * KEY)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def conversation_ids(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id").distinct()


def with_shared_openings(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations c that open with the first h turns of conversation c - c % every, h = crc32(c) % most, and go on with
    their own turns after the first h. At most ``every`` conversations either side of 0 share an opening."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    h = F.crc32(F.col("conv_id").cast("string")) % most
    place = F.row_number().over(order).cast("long") - 1
    opening = turns.filter(F.col("conv_id") % every == 0).withColumn("turn", place).filter(F.col("turn") < most - 1)
    borrowers = conversation_ids(turns).select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("of"), h.alias("h"))
    opening = opening.withColumnRenamed("conv_id", "of")
    lent = borrowers.filter("h > 0").join(opening, "of").filter(F.col("turn") < F.col("h"))
    own = turns.withColumn("turn", place).filter(F.col("turn") >= h).withColumn("turn", F.col("turn") + most)
    columns = ("conv_id", "turn", "digest", "words")
    return lent.select(*columns).unionAll(own.select(*columns))


PATHS = "conv_id long, keys binary, words array<long>"


def _paths(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn; a row without a digest only names its conversation."""
    schema = arrow_schema(PATHS)
    done: dict[str, list] = {name: [] for name in schema.names}
    conv, keys, words, last = None, bytearray(), [], ROOT

    def close():
        for name, value in zip(schema.names, (conv, bytes(keys), words), strict=True):
            done[name].append(value)

    for batch in rows:
        for c, digest, n in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "digest", "words")), strict=True):
            if c != conv:
                if conv is not None:
                    close()
                conv, keys, words, last = c, bytearray(), [], ROOT
            if digest is not None:
                last = hashlib.blake2b(last + digest, digest_size=KEY).digest()
                keys += last
                words.append(n)
        yield from batches(done, schema)
        for column in done.values():
            column.clear()
    if conv is not None:
        close()
    yield from batches(done, schema)


def paths(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``conv_id, keys, words`` per conversation, as a written table: the keys of its prefixes of 1, 2, ... turns and the
    words of each turn. ``ids`` (conv_id) adds conversations that may have no turn."""
    rows = turns.select("conv_id", "turn", "digest", "words")
    if ids is not None:
        rows = rows.unionAll(ids.selectExpr("conv_id", "cast(null as bigint)", "cast(null as binary)", "0L"))
    order = ("conv_id", F.col("turn").asc_nulls_first(), "digest")
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order)
    return stage_table(map_batches(dealt, _paths, PATHS), "paths")


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the largest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def key_at(keys: bytes, depth: int) -> bytes:
    return keys[KEY * (depth - 1) : KEY * depth] if depth else ROOT


class Node:
    """A compacted node: the edge from its parent's depth to its own, the path it was made for, and the ends at it."""

    __slots__ = ("children", "ends", "extent", "keys", "least", "parent")

    def __init__(self, parent: Node | None, extent: int, keys: bytes):
        self.parent, self.extent, self.keys = parent, extent, keys
        self.children: dict[bytes, Node] = {}
        self.ends, self.least = 0, None

    @property
    def start(self) -> int:
        return self.parent.extent if self.parent else 0

    def ended_by(self, conv: int) -> None:
        self.ends += 1
        self.least = conv if self.least is None else min(conv, self.least)


class ZFastTrie:
    def __init__(self):
        self.root = Node(None, 0, b"")
        self.nodes = [self.root]
        self.handles: dict[bytes, Node] = {}

    def _hang(self, node: Node, parent: Node) -> None:
        """Put a node below a parent and under its handle."""
        node.parent = parent
        parent.children[key_at(node.keys, parent.extent + 1)] = node
        self.handles[key_at(node.keys, two_fattest(parent.extent, node.extent))] = node

    def _matches(self, node: Node, keys: bytes, depth: int) -> bool:
        return node.extent <= depth and key_at(keys, node.extent) == key_at(node.keys, node.extent)

    def exit_node(self, keys: bytes, depth: int) -> Node:
        """The node whose edge the path leaves or ends in, or the last one it passes whole if no edge goes on."""
        node, low, high = self.root, 0, depth
        while low < high:
            middle = two_fattest(low, high)
            found = self.handles.get(key_at(keys, middle))
            if found is None:
                high = middle - 1
            elif self._matches(found, keys, depth):
                node, low = found, found.extent
            else:
                return found
        return node if node.extent == depth else node.children.get(key_at(keys, node.extent + 1), node)

    def insert(self, keys: bytes, conv: int) -> None:
        depth = len(keys) // KEY
        node = self.exit_node(keys, depth)
        if not self._matches(node, keys, depth):
            low, high = node.start, min(depth, node.extent)
            while low < high:  # the last depth at which both paths agree
                middle = (low + high + 1) // 2
                same = key_at(keys, middle) == key_at(node.keys, middle)
                low, high = (middle, high) if same else (low, middle - 1)
            upper = Node(node.parent, low, node.keys)
            self.nodes.append(upper)
            self._hang(upper, node.parent)
            self._hang(node, upper)
            node = upper
        if node.extent < depth:
            leaf = Node(node, depth, keys)
            self.nodes.append(leaf)
            self._hang(leaf, node)
            node = leaf
        node.ended_by(conv)

    def expanded(self) -> Iterator[tuple[bytes, bytes | None, int, int, int, bool]]:
        """Each depth of each edge: key, parent's key, depth, members, smallest member, whether a turn follows."""
        counts, least = {id(n): n.ends for n in self.nodes}, {id(n): n.least for n in self.nodes}
        for node in sorted(self.nodes, key=lambda n: -n.extent):
            n, smallest, up = counts[id(node)], least[id(node)], node.parent
            if up:
                counts[id(up)] += n
                least[id(up)] = smallest if least[id(up)] is None else min(smallest, least[id(up)])
            elif n:
                yield ROOT, None, 0, n, smallest, bool(node.children)
            for depth in range(node.start + 1, node.extent + 1):
                inner = depth < node.extent or bool(node.children)
                yield key_at(node.keys, depth), key_at(node.keys, depth - 1), depth, n, smallest, inner


NODES = "key binary, parent binary, depth long, n_convs long, conv_id long, inner boolean"


def _grow(rows: Iterator[pa.RecordBatch], batch_bytes: int) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(NODES)

    def expanded(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        for row in trie.expanded():
            part.append(row)
            if len(part) == 20_000:
                yield from batches(dict(zip(schema.names, zip(*part, strict=True), strict=True)), schema)
                part = []
        if part:
            yield from batches(dict(zip(schema.names, zip(*part, strict=True), strict=True)), schema)

    trie, held = ZFastTrie(), 0
    for batch in rows:
        for conv, keys in zip(batch.column("conv_id").to_pylist(), batch.column("keys").to_pylist(), strict=True):
            trie.insert(keys, conv)
            held += len(keys) + KEY
            if held >= batch_bytes:
                yield from expanded(trie)
                trie, held = ZFastTrie(), 0
    yield from expanded(trie)


def nodes(made: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``key, parent, depth, n_convs, conv_id, inner`` for every node of the expanded trie of these paths."""
    grown = map_batches(made.select("conv_id", "keys"), partial(_grow, batch_bytes=batch_bytes), NODES)
    return grown.groupBy("key", "parent", "depth").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("inner").alias("inner")
    )


SHARES = "key binary, n_children long, n_leaves long, saved_tokens long"


def _shares(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a conversation adds to each node of its path, from the first depth it owns and whether it owns a leaf."""
    schema = arrow_schema(SHARES)
    out: dict[str, list] = {name: [] for name in schema.names}
    for batch in rows:
        columns = [batch.column(c).to_pylist() for c in ("keys", "words", "owned_from", "leaf")]
        for keys, words, owned, leaf in zip(*columns, strict=True):
            depth = len(keys) // KEY
            owned = depth + 1 if owned is None else owned
            sums = np.concatenate([[0], np.cumsum(words[: max(owned - 1, 0)], dtype=np.int64)])
            left = np.zeros(depth + 1, np.int64)  # words from each depth to the last one that is not owned
            left[0] = sums[-1]
            left[1 : len(sums)] = sums[-1] - sums[:-1]
            follow = np.arange(1, depth + 2)
            out["key"] += [key_at(keys, d) for d in range(depth + 1)]
            out["n_children"] += ((follow >= owned) & (follow <= depth)).astype(np.int64).tolist()
            out["n_leaves"] += [leaf or 0] * (depth + 1)
            out["saved_tokens"] += left.tolist()
            if len(out["key"]) >= 20_000:
                yield from batches(out, schema)
                out = {name: [] for name in schema.names}
    yield from batches(out, schema)


ENDS = "key binary, ends_sha256 string"


def _end_digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by key and bucket; one hash is open at a time, however many ids a node has."""
    schema = arrow_schema(ENDS)
    out: dict[str, list] = {name: [] for name in schema.names}
    key, state = None, None
    for batch in rows:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    out["key"].append(key)
                    out["ends_sha256"].append(state.hexdigest())
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield from batches(out, schema)
        out = {name: [] for name in schema.names}
    if state is not None:
        yield from batches({"key": [key], "ends_sha256": [state.hexdigest()]}, schema)


def end_digests(made: DataFrame) -> DataFrame:
    """``key, ends_sha256``: SHA-256 of the ascending ids of the conversations that end at a node, joined by commas. At
    most 1,024 ids are joined before the sort, so a node where a third of all conversations ends is many pieces."""
    last = F.when(F.length("keys") > 0, F.expr(f"substring(keys, -{KEY}, {KEY})")).otherwise(F.lit(ROOT))
    ends = made.select("conv_id", last.alias("key"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy("key", F.shiftright("conv_id", BUCKET_BITS).alias("bucket")).agg(ids.alias("ids"))
    return map_batches(pieces.repartition("key").sortWithinPartitions("key", "bucket"), _end_digests, ENDS)


def trie(turns: DataFrame, ids: DataFrame | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per node of the trie of marked turns: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` of its subtree, ``ends_sha256``, and ``key``, its prefix's key."""
    made = paths(turns, ids)
    grown = stage_table(nodes(made, batch_bytes), "nodes")
    owners = grown.groupBy("conv_id").agg(
        F.min("depth").alias("owned_from"), F.max((~F.col("inner")).cast("long")).alias("leaf")
    )
    shares = map_batches(made.join(owners, "conv_id", "left").select("keys", "words", "owned_from", "leaf"), _shares, SHARES)
    totals = shares.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")))
    parents = grown.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = grown.drop("inner").join(totals, "key").join(end_digests(made), "key", "left")
    return named.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_END)).alias("ends_sha256"), "key",
    )

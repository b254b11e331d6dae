"""Near-duplicate embeddings by randomly rotated binary codes.

Equal vectors of a label are one, with a count. A vector is scaled to length one and rotated; the signs of the rotated
coordinates are its code, and the inner product of the vector with its own code is stored as correction factor. The
inner product of another vector with the code, over the factor, is an unbiased estimate of their cosine, with an error of
``sqrt((1 - f^2) / f^2 / (d - 1))`` times the sine of their angle. A pair is computed exactly, in double precision, only if
the estimate is above the limit less ``CONFIDENCE`` such errors (the error cannot exceed ``sqrt(d - 1)`` of them).

Vectors that are compared at all share a label and one of ``BANDS`` groups of ``BAND_BITS`` signs of further rotations. A
pair at cosine 0.98 agrees in a sign with probability 0.936, so it misses all groups with probability 4e-8. A group gives
the number of links of each member and links that connect its members, no pairs; a pair counts in the first group that
it shares. Groups of more than ``CHUNK`` members are dealt out as pairs of chunks.

Defined results. Vectors that are null, empty, zero or hold a null or non-finite component, and rows with a null label,
have no links. Only vectors of equal length are compared. Repeated rows are vectors of their own, linked to
each other. A null vec_id keeps its links; the component is the smallest vec_id that is not null. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.components import components
from layerwright.llm.spark import arrow_schema, batches, map_batches, stage_table

BANDS = 40
BAND_BITS = 16
CONFIDENCE = 6.0
CHUNK = 1024


@cache
def rotation(d: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every executor."""
    q, r = np.linalg.qr(np.random.default_rng([d, number]).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def band_keys(units: np.ndarray) -> np.ndarray:
    """The signs of each band as a 16-bit number: rows x BANDS."""
    d, need = units.shape[1], BANDS * BAND_BITS
    signs = [units @ rotation(d, 1 + i) >= 0 for i in range(-(-need // d))]
    bits = np.hstack(signs)[:, :need].reshape(len(units), BANDS, BAND_BITS)
    return (bits << np.arange(BAND_BITS)).sum(2).astype(np.uint16)


def codes(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of each vector, packed signs, and its correction factor."""
    rotated = units @ rotation(units.shape[1], 0)
    return np.packbits(rotated >= 0, axis=1), np.abs(rotated).sum(1) / np.sqrt(units.shape[1])


def estimates(units: np.ndarray, packed: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Estimated cosine of each unit vector with each coded one."""
    d = units.shape[1]
    signs = np.unpackbits(packed, axis=1, count=d).astype(np.float32) * 2 - 1
    rotated = (units @ rotation(d, 0)).astype(np.float32)
    return (rotated @ signs.T) / (np.sqrt(d) * factor).astype(np.float32)


def spread(factor: np.ndarray, d: int) -> np.ndarray:
    """The standard error of estimates by a code, for vectors at a right angle."""
    return np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(d - 1, 1))


CODED = "rep long, keys binary, code binary, factor double"
FULL = f"label int, embedding array<double>, {CODED}"


def _encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(CODED)
    for batch in rows:
        sizes = pa.compute.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
        reps = batch.column("rep").to_numpy()
        flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        for d in np.unique(sizes):
            mine = np.flatnonzero(sizes == d)
            units = unit(flat[starts[mine][:, None] + np.arange(d)])
            keys, (packed, factor) = band_keys(units), codes(units)
            columns = {"rep": reps[mine], "keys": [k.tobytes() for k in keys], "code": [c.tobytes() for c in packed], "factor": factor}
            yield from batches(columns, schema, 5000)


def linked_pairs(units, packed, factor, keys, band: int, limit: float, block: int = 256):
    """Pairs ``i < j`` whose cosine reaches the limit and whose first common band is this one."""
    d = units.shape[1]
    margin = min(CONFIDENCE, np.sqrt(max(d - 1, 1))) * spread(factor, d) * np.sqrt(max(0.0, 1 - limit * limit)) + 1e-5
    for a in range(0, len(units), block):
        near = estimates(units[a : a + block], packed[a:], factor[a:]) >= limit - margin[a:]
        i, j = np.nonzero(near)
        i, j = i + a, j + a
        i, j = i[j > i], j[j > i]
        for at in range(0, len(i), 200_000):
            x, y = i[at : at + 200_000], j[at : at + 200_000]
            exact = np.einsum("ij,ij->i", units[x], units[y]) >= limit
            x, y = x[exact], y[exact]
            first = ~(keys[x, :band] == keys[y, :band]).any(1)
            yield x[first], y[first]


COUNTED = "rep long, other long, links long"


def _groups(rows: Iterator[pa.RecordBatch], limit: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part. Out: the links of each member (other is null), and members with a root they reach."""
    schema = arrow_schema(COUNTED)
    held: list[dict] = []
    out: dict[str, list] = {"rep": [], "other": [], "links": []}

    def solve():
        if len(held) < 2:
            return
        rep = np.array([r["rep"] for r in held], np.int64)
        chunk = np.array([r["own"] for r in held])
        weight = np.array([r["copies"] for r in held], np.int64)
        units = unit(np.array([r["embedding"] for r in held], float))
        packed = np.frombuffer(b"".join(r["code"] for r in held), np.uint8).reshape(len(held), -1)
        keys = np.frombuffer(b"".join(r["keys"] for r in held), np.uint16).reshape(len(held), -1)
        factor = np.array([r["factor"] for r in held])
        two = chunk.min() != chunk.max() or held[0]["two"]
        root, links = np.arange(len(held)), np.zeros(len(held), np.int64)
        for x, y in linked_pairs(units, packed, factor, keys, held[0]["band"], limit):
            if two:
                across = chunk[x] != chunk[y]
                x, y = x[across], y[across]
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
            while len(x):
                a, b = root[x], root[y]
                differ = a != b
                x, y, a, b = x[differ], y[differ], a[differ], b[differ]
                if len(x):
                    np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
                    while (root[root] != root).any():
                        root = root[root]
        some = np.flatnonzero(links)
        out["rep"] += rep[some].tolist()
        out["other"] += [None] * len(some)
        out["links"] += links[some].tolist()
        moved = np.flatnonzero(root != np.arange(len(root)))
        out["rep"] += rep[moved].tolist()
        out["other"] += rep[root[moved]].tolist()
        out["links"] += [0] * len(moved)

    def flush():
        if out["rep"]:
            yield from batches(out, schema)
            for column in out.values():
                column.clear()

    for batch in rows:
        for at in range(0, batch.num_rows, 2048):
            for row in batch.slice(at, 2048).to_pylist():
                if held and held[0]["part"] != row["part"]:
                    solve()
                    held.clear()
                held.append(row)
        yield from flush()
    solve()
    yield from flush()


def _parts(coded: DataFrame) -> DataFrame:
    """``rep, band, part, own, two`` of the groups with two members or more."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.struct(i.alias("band"), F.hex(F.expr("keys").substr(2 * i + 1, F.lit(2))).alias("bits")),
    )
    dealt = coded.select("rep", "label", F.size("embedding").alias("d"), F.explode(keys).alias("key"))
    dealt = dealt.select("rep", F.xxhash64("label", "d", "key.band", "key.bits").alias("bucket"), "key.band")
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    marked = dealt.join(sizes, "bucket").withColumn("chunks", chunks)
    marked = marked.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    pairs = marked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return pairs.select("rep", "band", F.xxhash64("bucket", low, high).alias("part"), "own", (low != high).alias("two"))


def linked(embeddings: DataFrame, limit: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", "label", vector.alias("embedding"))
    sound = F.expr(
        "label is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
        " and exists(embedding, x -> x <> 0)"
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    distinct = rows.filter("sound").groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    reps = stage_table(distinct.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    made = map_batches(reps.select("rep", "embedding"), _encode, CODED)
    coded = stage_table(reps.drop("first").join(made, "rep"), "vector-codes")
    parts = _parts(coded)
    full = parts.join(coded.select("rep", "copies", "embedding", "keys", "code", "factor"), "rep")
    dealt = full.repartition("part").sortWithinPartitions("part")
    found = stage_table(map_batches(dealt, partial(_groups, limit=limit), COUNTED), "vector-links")
    counts = found.filter("other is null").groupBy("rep").agg(F.sum("links").alias("links"))
    edges = found.filter("other is not null").select(F.col("rep").alias("src"), F.col("other").alias("dst"))
    groups = components(edges)
    rooted = reps.join(groups, reps.rep == groups.node, "left").withColumn("root", F.coalesce("component", "rep"))
    # a table of its own, so that adaptive execution may split the join of a hot component
    named = stage_table(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "vector-components")
    by_rep = rooted.join(counts, "rep", "left").join(named, "root").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    good = rows.filter("sound").join(by_rep, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = rows.filter("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return good.unionAll(rest).select("vec_id", "n_links", "component_id", kept)

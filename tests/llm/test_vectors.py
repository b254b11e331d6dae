import numpy as np
import pytest

from layerwright.llm import vectors

COLUMNS = "vec_id long, embedding array<float>, label int, rep int, key string, size int"


def plain(rows, limit=0.98):
    """n_links and component of each row number, by comparing all pairs."""
    def ok(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    sound = [i for i, (_, v, label) in enumerate(rows) if ok(v, label)]
    unit = {i: np.array(rows[i][1], np.float32).astype(float) for i in sound}
    unit = {i: u / np.linalg.norm(u) for i, u in unit.items()}
    links, root = [0] * len(rows), list(range(len(rows)))
    for a in sound:
        for b in sound:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= limit:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    smallest = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            smallest[r] = min(smallest.get(r, rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], smallest.get(root[i])) for i in range(len(rows))]


def make(n=260, d=24, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, d))
    rows = []
    for i in range(n):
        v = base[i % 12] + rng.standard_normal(d) * rng.choice([0.0, 0.05, 0.12, 0.2])
        rows.append((1000 - i, (v * rng.uniform(0.5, 3)).tolist(), int(i % 2)))
    return rows


ODD = [
    (1, None, 0), (2, [0.0] * 24, 0), (3, [1.0] * 23 + [None], 0), (4, [float("nan")] * 24, 0), (5, [float("inf")] + [1.0] * 23, 0),
    (6, [1.0] * 24, None), (7, [], 0), (8, [1.0, 2.0], 0), (9, [1.0, 2.001], 0), (8, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (11, [-1.0], 1), (12, [-3.0], 1),
]


def found(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], COLUMNS)
    return vectors.linked(frame).collect()


@pytest.mark.parametrize("chunk", [1024, 5])
def test_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(vectors, "CHUNK", chunk)
    rows = [*make(), *ODD]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    out = found(spark, rows)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=key) == sorted(plain(rows), key=key)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in out)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_estimates_are_unbiased_and_within_their_bounds():
    rng = np.random.default_rng(4)
    d, n = 64, 4000
    one = vectors.unit(rng.standard_normal((n, d)))
    other = vectors.unit(one + rng.standard_normal((n, d)) * 0.025)
    packed, factor = vectors.codes(one)
    cosine = (one * other).sum(1)
    signs = np.unpackbits(packed, axis=1, count=d).astype(float) * 2 - 1
    estimate = ((other @ vectors.rotation(d, 0)) * signs).sum(1) / np.sqrt(d) / factor
    assert np.allclose(vectors.estimates(other[:50], packed[:50], factor[:50]).diagonal(), estimate[:50], atol=1e-5)
    error = (estimate - cosine) / (vectors.spread(factor, d) * np.sqrt(1 - cosine**2))
    assert abs(error.mean()) < 0.06 and 0.9 < error.std() < 1.1 and np.abs(error).max() < vectors.CONFIDENCE


def test_bands_miss_almost_no_pair_at_the_limit():
    rng = np.random.default_rng(5)
    a = vectors.unit(rng.standard_normal((20_000, 64)))
    side = rng.standard_normal(a.shape)
    side = vectors.unit(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * side
    assert (vectors.band_keys(a) == vectors.band_keys(b)).any(1).all()

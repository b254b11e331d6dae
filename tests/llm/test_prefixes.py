"""The prefix trie against brute force over all prefixes."""

import hashlib
import random
import re
import zlib

import pytest

pytest.importorskip("layerwright.llm")
from layerwright.llm import prefixes, queries  # noqa: E402

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, ids in members.items():
        d, below = len(node), [u for u in members if u[: len(node)] == node]
        childless = [u for u in below if not any(len(v) == len(u) + 1 and v[: len(u)] == u for v in members)]
        saved = sum((len(members[u]) - 1) * len(re.findall(r"[^\x20\x09-\x0d]+", u[-1][1])) for u in below if u)
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(convs[c]) == d))
        children = sum(len(u) == d + 1 for u in below)
        parent = min(members[node[:-1]]) if d else None
        out.append((min(ids), d, parent, len(ids), children, len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def many(seed, n=130, length=9, kinds=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 400), n):
        for t in range(rng.choice((1, 2, 3, length))):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "word " * (rng.randrange(kinds) if t < 6 else rng.randrange(50))))
    return rows


def result(frame, **how):
    turns = prefixes.marked(frame)
    ids = prefixes.conversation_ids(turns)
    return sorted(str(tuple(r)) for r in prefixes.trie(prefixes.with_shared_openings(turns), ids, **how).select(*COLUMNS).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = many(seed)
    frame = spark.createDataFrame(rows, ROWS)
    wanted = brute(rebuilt(rows))
    assert result(frame.repartition(3)) == wanted
    assert result(frame.repartition(1), batch_bytes=500) == wanted  # several tries per task


def test_odd_rows(spark):
    rows = many(3, n=30) + [(500, None, "user", "first"), (500, 3, None, None), (500, 1, "user", ""), (None, 0, "user", "nobody")]
    rows += [(501, t, "user", f"long conversation {t}") for t in range(600)] + [(502, t, "user", f"long conversation {t}") for t in range(550)]
    rows += [(503, 0, "user", "same"), (503, 0, "user", "same"), (520, 0, "user", "very long " * 30_000)]
    frame = spark.createDataFrame(rows, ROWS)
    for name in ("key", "keys", "words", "digest", "depth", "h"):
        frame = frame.selectExpr("*", f"7 as `{name}`")
    found = result(frame)
    wanted = brute(rebuilt([r for r in rows if r[0] not in (501, 502)]))
    # the long pair is compared by its nodes' counts: brute force over 600 depths is quadratic
    whole = prefixes.trie(prefixes.with_shared_openings(prefixes.marked(frame)), prefixes.conversation_ids(prefixes.marked(frame)))
    assert sorted(str(tuple(r)) for r in whole.filter("depth > 4 and conv_id not in (501, 502)").select(*COLUMNS).collect()) == [
        w for w in wanted if int(w.split(", ")[1]) > 4
    ]
    assert len(found) == whole.count() and whole.filter("conv_id is null").count() == 0
    top = whole.filter("depth = 0").collect()
    assert len(top) == 1 and top[0].n_convs == len({r[0] for r in rows} - {None}) and top[0].parent_conv_id is None


def test_empty_and_turnless(spark):
    empty = spark.createDataFrame([], ROWS)
    assert result(empty) == []
    assert result(spark.createDataFrame([(None, 1, "user", "x")], ROWS)) == []
    # a conversation whose own turns all give way to an opening that does not exist has no turn and ends at the root
    c = next(c for c in range(21, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    only = [(c, 0, "user", "gone"), (c, 1, "assistant", "gone too")]
    ends = hashlib.sha256(str(c).encode()).hexdigest()
    assert result(spark.createDataFrame(only, ROWS)) == [str((c, 0, None, 1, 0, 1, 0, ends))]


def test_two_fattest():
    for low in range(0, 70):
        for high in range(low + 1, 140):
            power = lambda x: x & -x
            assert prefixes.two_fattest(low, high) == max(range(low + 1, high + 1), key=power)


def test_exit_nodes_and_handles():
    rng = random.Random(4)
    for _ in range(300):
        trie, made = prefixes.ZFastTrie(), []
        for c in range(rng.randrange(1, 40)):
            turns = [rng.randrange(2) for _ in range(rng.randrange(0, 40))] if rng.random() < 0.7 or not made else made[-1][: rng.randrange(40)]
            made.append(turns)
            keys = b"".join(hashlib.blake2b(bytes(turns[: d + 1]), digest_size=16).digest() for d in range(len(turns)))
            trie.insert(keys, c)
            # every node is in the table under the handle of its edge, and only there
            assert len(trie.handles) == len(trie.nodes) - 1
            for node in trie.nodes[1:]:
                assert trie.handles[prefixes.key_at(node.keys, prefixes.two_fattest(node.start, node.extent))] is node
        nodes = {(d, key): (n, least) for key, _, d, n, least, _ in trie.expanded()}
        wanted = {}
        for c, turns in enumerate(made):
            for d in range(len(turns) + 1):
                n, least = wanted.get(tuple(turns[:d]), (0, c))
                wanted[tuple(turns[:d])] = (n + 1, least)
        assert sorted(nodes.values()) == sorted(wanted.values()) and len(nodes) == len(wanted)


def test_a_hot_end_is_hashed_in_order(spark):
    rows = [(c * 7, 0, "user", "hello") for c in range(5_000)]
    made = prefixes.paths(prefixes.marked(spark.createDataFrame(rows, ROWS).repartition(6)))
    ends = prefixes.end_digests(made).collect()
    assert [r.ends_sha256 for r in ends] == [hashlib.sha256(",".join(str(c * 7) for c in range(5_000)).encode()).hexdigest()]


def test_query_reads_the_whole_table(spark, tmp_path):
    rows = many(9)
    spark.createDataFrame(rows, ROWS).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op13_zfast_prefix_trie(spark, str(tmp_path))
    assert sorted(found.columns) == sorted(COLUMNS)
    assert sorted(str(tuple(r)) for r in found.select(*COLUMNS).collect()) == brute(rebuilt(rows))

import hashlib
import random

import pytest

from layerwright.llm import chat, queries

EVENTS = "conv_id long, seq long, message_id string, kind string, role string, text string, loss_start int"


def plain_fold(events):
    """Messages in order, by replaying the log."""
    rank = {k: i for i, k in enumerate(chat.KINDS)}
    convs = {}
    for conv, seq, message, kind, role, text in sorted(events, key=lambda e: (e[1], rank[e[3]], e[5] or "")):
        own = convs.setdefault(conv, {}).setdefault(message, [seq, None, ""])
        own[1] = own[1] if own[1] is not None else role
        own[2] = own[2] + (text or "") if kind == "delta" else (text or "")
    return {c: [(r or "", t) for _, r, t, m in sorted((s, r or "", t, m) for m, (s, r, t) in ms.items())] for c, ms in convs.items()}


def test_random_logs(spark):
    rng, events = random.Random(3), []
    for conv in range(12):
        for seq in range(rng.randrange(1, 40)):
            message = f"m{rng.randrange(6)}"
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
            text = rng.choice([None, "", "x", "</s>", "\\", "<s>[INST]", "\\n\n", "<|im_end|>", "é<"]) 
            events.append((conv, seq, message, kind, rng.choice(["user", "assistant", None, "to\\ol\n<s>"]), text))
    rng.shuffle(events)
    frame = spark.createDataFrame([(*e, 1) for e in events], EVENTS)
    segments = chat.render(chat.fold(frame))
    want = plain_fold(events)
    got = {}
    for r in segments.orderBy("conv_id", "position", "role", "text", "message_id").collect():
        got.setdefault(r.conv_id, []).append(chat.read_back(r.segment))
    assert got == want
    digests = {r.conv_id: r for r in chat.digests(segments).collect()}
    whole = {r.conv_id: r for r in chat.transcripts(segments).collect()}
    for conv, turns in want.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        d, w = digests[conv], whole[conv]
        assert d.n_turns == len(turns) and d.formatted_chars == len(w.text)
        assert d.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (d.loss_chars, d.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert "".join(chat.unescape(w.text[s.start : s.end]) for s in w.loss_spans) == loss
        assert w.text.count("</s>") == w.text.count("<s>") == len(turns)


def test_nulls_repeats_and_unknown_kinds(spark):
    rows = [(None, None, None, "message", None, None, 1), (1, 1, "a", "delta", "user", "hi", 1), (1, 1, "a", "delta", "user", "hi", 1)]
    out = chat.fold(spark.createDataFrame(rows, EVENTS)).orderBy("conv_id").collect()
    assert [(r.conv_id, r.role, r.text) for r in out] == [(None, "", ""), (1, "user", "hihi")]
    assert chat.digests(chat.render(chat.fold(spark.createDataFrame([], EVENTS)))).collect() == []
    with pytest.raises(Exception, match="unknown kind"):
        chat.fold(spark.createDataFrame([(1, 1, "a", "typo", "user", "x", 1)], EVENTS)).collect()


def test_query_keeps_repeated_and_null_rows(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", None), (2, None, None, "x")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = {r.conv_id: r for r in queries.op7_event_sourced_chat(spark, str(tmp_path)).collect()}
    assert {k: r.n_turns for k, r in out.items()} == {1: 3, 2: 1, -7: 2}
    assert out[-7].loss_chars == 21 and out[1].loss_chars == 0

import numpy as np
import pyarrow as pa

from layerwright.llm.words import find_words, inside, prefix_keys, window_keys

TEXTS = ["a b  c", "", " x\xa0y \n\t", "b", "é" * 3 + " a b c", "q" * 3_000_000 + " a", "\x0b\x0c\r"]


def spans(w):
    raw = w.data.tobytes()
    return [raw[a:b] for a, b in zip(w.starts, w.ends, strict=True)]


def test_words_are_those_of_bytes_split():
    w = find_words(pa.array(TEXTS))
    assert spans(w) == [x for t in TEXTS for x in t.encode().split()]
    assert w.counts.tolist() == [len(t.encode().split()) for t in TEXTS]


def test_equal_words_have_equal_keys_and_others_do_not():
    w = find_words(pa.array([*TEXTS, *(f"{a}{b}" for a in "abc" for b in range(500))]))
    by_word = dict(zip(spans(w), w.keys.tolist(), strict=True))
    assert all(by_word[s] == k for s, k in zip(spans(w), w.keys.tolist(), strict=True))
    assert len(set(by_word.values())) == len(by_word)


def test_sliced_and_empty_columns():
    assert find_words(pa.array(["a b", "c", "d e"]).slice(1)).counts.tolist() == [1, 2]
    assert len(find_words(pa.array([], pa.string())).keys) == 0


def test_windows_stay_in_their_text():
    w = find_words(pa.array(["a b c", "d", "a b c"]))
    keys, good = window_keys(w.keys, 3), inside(w, 3)
    assert good.tolist() == [True, False, False, False, True]
    assert keys[0] == keys[4]


def test_prefix_keys_are_keys_of_the_beginnings():
    w = find_words(pa.array(["stupid stupor stone"]))
    cut = np.minimum(w.ends, w.starts + 4)
    key = prefix_keys(w.data, w.starts, w.ends, [cut])[0]
    assert key[0] == key[1] == find_words(pa.array(["stup"])).keys[0] != key[2]


def test_lower_case_of_ascii_only():
    assert spans(find_words(pa.array(["AbZ É@["]), lower=True)) == ["abz".encode(), "É@[".encode()]

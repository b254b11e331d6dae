import random

import pytest

pytest.importorskip("layerwright.llm")

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars int"
# names that the operators use inside, as columns that must not get in the way
CLASH = {"row": "int", "key": "string", "size": "long", "part": "string", "spans": "string", "component": "string", "code": "int", "Label": "string"}


@pytest.fixture(scope="session")
def docs(spark):
    """docs((1, "text"), (2, None, "en")) makes a documents frame."""

    def make(*rows, clash=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        if clash:
            for name, kind in CLASH.items():
                frame = frame.selectExpr("*", f"cast('7' as {kind}) as `{name}`")
        return frame

    return make


@pytest.fixture
def prose():
    """prose(60, 1) gives 60 words that look like English, by a seed."""
    parts = "the an er in on re th st ing ed tion ly ha wh or at".split()

    def make(n, seed, vocabulary=400):
        words = random.Random(7)
        known = ["".join(words.choice(parts) for _ in range(words.randrange(1, 4))) for _ in range(vocabulary)]
        rng = random.Random(seed)
        return " ".join(rng.choice(known) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

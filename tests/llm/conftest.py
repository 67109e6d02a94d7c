import random

import pytest

# words and ids of an awkward corpus: nulls, blanks, repeated rows, ties, near copies, one very long text
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " row string, mark string, __body string, toxicity_score string, piece_ids string, rate string"
)


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n))


def awkward() -> list[tuple]:
    base = prose(1, 60)
    words = base.split()
    texts = [
        (1, base), (2, base.upper()), (3, base.replace(" ", "  ", 3)), (4, base + " "), (4, base + " "),
        (5, " ".join(words[:58] + ["zz", "yy"])), (6, " ".join(words[:30])), (7, None), (8, ""), (9, " \t\n"),
        (None, prose(2, 40)), (None, prose(2, 40)), (10, "one"), (11, "one two"), (12, "漢字 é 😀\nİstanbul ▁x"),
        (13, prose(3, 30_000)), (14, "x" * 50_000), (15, prose(2, 40) + " tail"), (16, "one"), (-5, prose(4, 25)),
    ]
    return [
        (i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 2}", None, "r", "m", "b", "t", "p", "q")
        for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}

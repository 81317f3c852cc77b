from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def edge_rows() -> list[tuple]:
    long = prose(1, 120)
    return [
        (None, prose(9, 80), "en"), (1, None, "en"), (2, "", None), (3, " \n\t ", "en"), (4, "one", "en"), (5, "One Two", "en"), (6, long, "en"), (7, long, "en"), (8, long + " tail", "en"),
        (9, prose(2, 3000), "en"), (10, prose(2, 3000).upper(), "en"), (11, "word " * 400, "en"), (12, "x" * 5000, "en"), (13, "é漢字\n" * 60 + long, "en"), (14, long, "en"), (14, long, "en"), (15, "a\x00b c <|endoftext|> <s>", "en"),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names the operators use inside."""
    rows = [(*r, 1, 2, "k", 3, "b", 4) for r in edge_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, tag long, spans long, key string, d1 long, bands string, cluster long").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return sorted((r[0], r[1]) for r in small.select("doc_id", "text").collect())


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

import random
import re

import pytest

from actlens.llm import substring_dedup as S

SCHEMA = "doc_id long, text string"


def brute(rows, length):
    tokens = [(d, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for d, t in rows]
    first = {}
    for d, w in tokens:
        if d is not None:
            for i in range(len(w) - length + 1):
                key = tuple(w[i:i + length])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in tokens:
        gone = set()
        if d is not None:
            for i in range(len(w) - length + 1):
                if first[tuple(w[i:i + length])] < d:
                    gone.update(range(i, i + length))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def mixed_rows(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["é", "a b"]
    base = [[rng.choice(vocab) for _ in range(rng.randint(5, 90))] for _ in range(6)]
    rows = []
    for d in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            b = rng.choice(base)
            i = rng.randint(0, len(b) - 1)
            parts += b[i:i + rng.randint(1, 70)] if rng.random() < 0.7 else [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.1:
            parts = ["same"] * 60
        rows.append((rng.randint(0, 30) if rng.random() < 0.2 else 100 + d, rng.choice([" ", "\n", "\t "]).join(parts)))
    return rows + [(None, " ".join(base[0])), (500, None), (501, ""), (502, " \n "), (503, rows[3][1]), (503, rows[3][1])]


@pytest.mark.parametrize("seed,length,k", [(1, 12, 5), (2, 12, 12), (3, 9, 3), (4, 20, 8)])
def test_equals_brute_force(spark, seed, length, k):
    rows = mixed_rows(seed)
    got = S.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3), length, k).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, length)


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, start int, anchor long, n int, found string")
    assert S.dedup(empty).collect() == []
    rows = [(1, "a b c d e f", 3, 4, 5, "x"), (2, "z a b c d e", 3, 4, 5, "x")]
    got = S.dedup(spark.createDataFrame(rows, empty.schema), 4, 2).collect()
    assert sorted(map(tuple, got)) == [(1, 6, 0, "a b c d e f"), (2, 6, 5, "z")]


def test_equal_rows_by_the_thousand(spark):
    """5,000 equal rows of one document, beside the document they repeat and one that holds a part."""
    rng = random.Random(9)
    text = [f"w{rng.randint(0, 999)}" for _ in range(200)]
    rows = [(1, " ".join(text))] + [(2, " ".join(["own", *text[20:], "end"]))] * 5000 + [(3, " ".join(text[5:120]))]
    got = S.dedup(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == 5002
    assert {tuple(r) for r in got} == {(1, 200, 0, " ".join(text)), (2, 182, 180, "own end"), (3, 115, 115, "")}

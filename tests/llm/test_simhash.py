import random
import re

import numpy as np
import pytest
import xxhash

from actlens.llm import components, simhash


def brute_print(text, width=4):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One TWO three", "É é À a b c d", "a\x0bb\x0cc\rd e f g", "w " * 500,
                                  " ".join(f"w{i}" for i in range(20000))])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_print(text)


def close_prints(rng, n):
    base = rng.integers(0, 2**63, max(1, n // 8), dtype=np.uint64)
    p = base[rng.integers(0, len(base), n)]
    for _ in range(5):
        p = np.where(rng.random(n) < 0.6, p ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)), p)
    return np.unique(p)


@pytest.mark.parametrize("n,radius", [(1, 4), (64, 3), (65, 0), (300, 7), (700, 4), (1000, 1)])
def test_forest_connects_what_links_connect(n, radius):
    p = close_prints(np.random.default_rng(n), n)
    a, b = simhash.forest(p, radius)
    every = [(i, int(j)) for i in range(len(p)) for j in np.flatnonzero(np.bitwise_count(p[i + 1:] ^ p[i]) <= radius) + i + 1]
    assert len(a) <= max(0, len(p) - 1)
    assert all(int(p[x] ^ p[y]).bit_count() <= radius for x, y in zip(a, b))
    assert groups(len(p), zip(a.tolist(), b.tolist())) == groups(len(p), every)


@pytest.mark.parametrize("cell", [4096, 8])
def test_link_table(spark, monkeypatch, cell):
    """All links' components, also where keys are cut into many parts."""
    monkeypatch.setattr(simhash, "CELL", cell)
    p = close_prints(np.random.default_rng(3), 400)
    rows = spark.createDataFrame([(int(x), i) for i, x in enumerate(p.view(np.int64).tolist())], "fp long, node long")
    got = simhash.link(rows, 4).collect()
    every = [(i, j) for i in range(len(p)) for j in range(i) if int(p[i] ^ p[j]).bit_count() <= 4]
    assert all(int(p[a] ^ p[b]).bit_count() <= 4 for a, b in got)
    assert groups(len(p), got) == groups(len(p), every)


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100), (7, 200)] + [(300, 300 + i) for i in range(1, 30)]
    pairs += [(rng.randint(400, 460), rng.randint(400, 460)) for _ in range(40)] + pairs[:3] + [(None, 3)]
    got = dict(components.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    want = groups(500, [p for p in pairs if None not in p])
    assert got == {i: c for i, c in enumerate(want) if c != i}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def documents():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    out = []
    for d in range(60):
        t = rng.choices(words, k=rng.randint(1, 200))
        out.append((d, " ".join(t)))
        for c in range(rng.randint(0, 3)):
            copy = list(t)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = "x"
            out.append((1000 - 10 * d - c, " ".join(copy)))
    return out + [(2000, None), (2001, ""), (2002, " \t"), (None, "w1 w2"), (5, "five again"), (5, "five again")]


def test_near_duplicates(spark):
    rows = documents()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, component_id int")
    got = sorted(map(tuple, simhash.near_duplicates(docs.repartition(3)).collect()), key=repr)
    prints = [brute_print(t) for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
    pairs = [(a, b) for a in range(len(order)) for b in range(a)
             if (prints[order[a]] ^ prints[order[b]]).bit_count() <= 4]
    smallest = groups(len(order), pairs)
    want = sorted(((rows[i][0], f"{prints[i]:016x}", rows[order[smallest[k]]][0]) for k, i in enumerate(order)), key=repr)
    assert got == want
    kept = simhash.one_of_each(docs).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == sorted({w[2] for w in want if w[2] is not None})
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp", "component_id"}
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_rows_without_an_id(spark):
    """They are linked and bridge like others; where all of a component have none, one of them stays."""
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base)]
    while len(texts) < 40:  # a chain of small changes
        base = list(base)
        base[7 * len(texts)] = f"x{len(texts)}"
        texts.append(" ".join(base))
    prints = [brute_print(t) for t in texts]
    want = groups(len(texts), [(a, b) for a in range(40) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    ids = [10 + i if i % 9 == 0 else None for i in range(40)]
    lone = " ".join(f"q{i}" for i in range(90))
    rows = list(zip(ids, texts)) + [(None, lone), (None, lone), (None, lone)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string").repartition(3)
    smallest = {}
    for i, c in enumerate(want):
        smallest[c] = min([x for x in (smallest.get(c), ids[i]) if x is not None], default=None)
    expected = [(ids[i], f"{prints[i]:016x}", smallest[c]) for i, c in enumerate(want)]
    expected += [(None, f"{brute_print(lone):016x}", None)] * 3
    got = simhash.near_duplicates(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    kept = simhash.one_of_each(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(c for c in smallest.values() if c is not None)
    assert len([r for r in kept if r.doc_id is None]) == 1 + sum(c is None for c in smallest.values())
    assert len([r for r in kept if r.text == lone]) == 1

import random
from hashlib import sha256

import numpy as np
import pytest

from actlens.llm import vector_codes as V

SHAPE = "vec_id long, embedding array<float>, label int"


def slow(rows, rounds=V.ROUNDS):
    """(codes with errors, digest) by comparing every part with every entry."""
    kept = [(i, [int(np.floor(float(np.float32(x)) * 4096)) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // 8
    kept = [r for r in kept if len(r[1]) == 8 * w]
    part = lambda v, p: v[p * w:(p + 1) * w]
    books = [[part(r[1], p) for r in kept[:16]] for p in range(8)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(part(v, p), books[p])[1], []).append(part(v, p))
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    coded = []
    for i, v, label in kept:
        found = [nearest(part(v, p), books[p]) for p in range(8)]
        coded.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    digest = sha256(",".join(str(x) for b in books for entry in b for x in entry).encode()).hexdigest()
    return sorted(((i, c, d, sum(x[2] for x in coded if x[3] == label), digest) for i, c, d, label in coded), key=repr)


def rows_of(n, width, seed, spread=0.3):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(8 * width)] for _ in range(7)]
    out = [(i, [float(np.float32(m + rng.gauss(0, 0.05))) for m in rng.choice(middles)], rng.choice([1, 2, None])) for i in range(n)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("n, width", [(700, 4), (40, 1), (9, 2), (1, 3)])
def test_same_as_slow(spark, monkeypatch, n, width):
    monkeypatch.setattr(V, "SHARD", 150)
    rows = rows_of(n, width, n)
    got = V.codes(spark.createDataFrame(rows, SHAPE).repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == slow(rows)


def test_odd_rows(spark):
    rows = rows_of(60, 2, 5)
    rows += rows[:5] + [rows[0]] * 30  # repeated rows
    rows += [(None, rows[1][1], 1), (500, rows[2][1], None), (500, rows[3][1], 4)]  # no id, an id twice
    rows += [(501, [0.25] * 16, 3)] * 40 + [(502, [0.0] * 8 + [1.0] * 8, 3)]  # many equal vectors, ties
    odd = [(-1, None, 1), (-2, [None] + [0.1] * 15, 1), (-3, [float("nan")] * 16, 1), (-4, [float("inf")] + [0.0] * 15, 2)]
    short = [(600, [0.1] * 8, 1), (601, [], 1), (602, [0.5] * 24, 1)]
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows + odd + short], SHAPE + ", code string, error int")
    got = V.codes(docs).collect()
    assert sorted(map(tuple, got), key=repr) == slow(rows)
    assert V.codes(docs.limit(0)).collect() == []
    assert V.codes(docs.where("vec_id < 0")).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_ball_contents_and_pruning():
    """Sums and ranges of balls are those of their points; a descent gives the
    exact assignment also where entries tie or are equal, and adds up most points as whole balls."""
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 30, (300, 3)) for c in (-2000, 0, 3000)] + [np.zeros((100, 3))]).astype(np.int64)
    tree = V.Tree.unpack(V.Tree.of(points).pack(), 3)
    assert sorted(tree.order) == list(range(1000)) and (tree.points == points[tree.order]).all()
    for at in range(len(tree.lo)):
        own = tree.points[tree.lo[at]:tree.hi[at]]
        off = own - own.mean(0)
        assert (own.sum(0) == tree.total[at]).all() and np.sqrt((off * off).sum(1).max()) <= tree.radius[at] + 1e-6
        if tree.left[at] >= 0:
            left, right = tree.left[at], tree.right[at]
            assert tree.lo[at] == tree.lo[left] and tree.hi[left] == tree.lo[right] and tree.hi[right] == tree.hi[at]
    book = np.array([[-2000] * 3, [0] * 3, [0] * 3, [10, 0, 0], [-10, 0, 0], [3000] * 3], np.int64)
    want = ((points[:, None] - book[None]) ** 2).sum(2)
    entry, error = tree.assign(book, each=True)
    assert (entry == want.argmin(1)).all() and (error == want.min(1)).all()
    looked_at = []
    original = V._squares
    V._squares = lambda p, b: looked_at.append(len(p)) or original(p, b)
    try:
        sums, counts = tree.assign(book)
    finally:
        V._squares = original
    for e in range(len(book)):
        assert counts[e] == (entry == e).sum() and (sums[e] == points[entry == e].sum(0)).all()
    assert sum(looked_at) < 500


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        V.codes(spark.createDataFrame([(1, [1e12] * 8, 1)], SHAPE)).collect()

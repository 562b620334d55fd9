import random
import zlib
from hashlib import sha256

import pytest

from actlens.llm import prefix_trie as P

SHAPE = "conv_id long, turn long, role string, text string"


def slow(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    for turns in own.values():
        turns.sort()
    anew = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        anew[c] = tuple((r, t) for *_, r, t in own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c in sorted(anew):
        for d in range(len(anew[c]) + 1):
            members.setdefault(anew[c][:d], []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    for path, who in members.items():
        cost = (len(who) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += cost
            leaves[path[:d]] += path not in children
    out = []
    for path, who in members.items():
        ends = ",".join(str(c) for c in who if len(anew[c]) == len(path))
        out.append((who[0], len(path), members[path[:-1]][0] if path else None, len(who), len(children.get(path, [])),
                    leaves[path], saved[path], sha256(ends.encode()).hexdigest()))
    return sorted(out)


def rows_of(seed, n=60, texts=3):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(3 * n), n):
        for t in range(rng.choice([1, 2, 3, 5, 8, 9, 12, 17, 30])):
            out.append((c, t, rng.choice(["user", "bot"]) if texts > 1 else "user", rng.choice(["", "é", "longer text"][:texts])))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed, texts", [(1, 3), (2, 2), (3, 1)])
def test_same_as_slow(spark, seed, texts):
    rows = rows_of(seed, texts=texts)
    got = P.prefix_trie(spark.createDataFrame(rows, SHAPE).repartition(3)).collect()
    assert sorted(map(tuple, got)) == slow(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE", 3)
    rows = rows_of(4, n=20)
    rows += [(None, 0, "user", "no conversation"), (7, None, "user", "null first"), (7, None, None, None), (1001, 0, None, "a" * 100_000)]
    rows += [(c, t, "user", "same") for c in range(2000, 2300, 5) for t in range(3)]  # copies
    rows += [(3000, 1, "a", "tie"), (3000, 1, "b", "tie"), (3000, 1, "a", "tie"), (3001, 0, "user", "short")]
    rows += [(4000, t, "user", str(t % 7)) for t in range(150)] + [(4001, t, "user", str(t % 7)) for t in range(150)]
    rows += [(c, 0, "user", "one turn") for c in range(5001, 5030)]  # some of them turnless when rebuilt
    frame = spark.createDataFrame([(*r, 9, "x") for r in rows], SHAPE + ", depth int, id string")
    got = P.prefix_trie(frame.repartition(5)).collect()
    assert sorted(map(tuple, got)) == slow(rows)
    assert P.prefix_trie(frame.limit(0)).collect() == []


def test_blocks_of_any_width_give_the_same(spark, monkeypatch):
    rows = rows_of(5, n=25)
    want = slow(rows)
    monkeypatch.setattr(P, "WIDTH", 3)
    assert sorted(map(tuple, P.prefix_trie(spark.createDataFrame(rows, SHAPE)).collect())) == want

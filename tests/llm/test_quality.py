import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from actlens.llm import quality_model as M
from actlens.llm import quality_rules as R
from actlens.llm import text_stats as T

DIR = "/root/testdata/sf0.01"


def brute_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def texts():
    rng = random.Random(8)
    out = [None, "", " \n\t", "a", "a b", "a a a", "a a a a", "x y z x y z", "é\xa0ü b\x0bc\x1cd", "l\nl\n l\n\n\nl", "#|<>&%$* <"]
    for _ in range(60):
        out.append("".join(rng.choice(["a ", "b ", "c\n", "dd", "#", " ", "é", "A! "]) for _ in range(rng.randint(0, 60))))
    return out + ["w " * 30000]


@pytest.mark.parametrize("text", texts())
def test_counts(text):
    assert T.counts_of(text)[:5] == brute_counts(text)


def test_learned_list_rejects_what_was_planted():
    rng = np.random.default_rng(0)
    n = 3000
    x = {"words": rng.integers(50, 500, n), "symbols": rng.integers(0, 40, n), "repeats": rng.integers(0, 200, n)}
    bad = rng.random(n) < 0.1
    kind = rng.random(n) < 0.5
    x["symbols"] = np.where(bad & kind, rng.integers(300, 900, n), x["symbols"])
    x["repeats"] = np.where(bad & ~kind, rng.integers(700, 1000, n), x["repeats"])
    rules = R.learn(x, bad)
    hit = np.any([R.covers(r, x) for r in rules], axis=0)
    assert (hit == bad).all()
    assert R.learn(x, np.zeros(n, bool)) == [] and R.learn(x, np.ones(n, bool)) == []
    assert R.learn({k: v[:0] for k, v in x.items()}, bad[:0]) == []
    noise = rng.random(n) < 0.1
    assert sum(map(len, R.learn({"words": x["words"]}, noise))) <= 1


def test_verdict_equals_covers(spark):
    """The emitted expression decides as the rules do, for every row."""
    rules = [(R.Condition("symbols", True, 100), R.Condition("words", False, 40)), (R.Condition("repeats", True, 500),)]
    rows = [(i, t, "k") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = {r.doc_id: r for r in R.judge(docs, rules).collect()}
    for i, t, _ in rows:
        c = dict(zip(T.COUNTS, T.counts_of(t)))
        w = max(1, c["n_words"])
        rejected = (1000 * c["n_symbols"] // w >= 100 and c["n_words"] <= 40) or 1000 * c["n_repeat_words"] // w >= 500
        failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        assert (got[i].base_failed, got[i].kept) == (failed, not failed and not rejected)
        assert tuple(got[i][1:6]) == brute_counts(t)
    kept = R.keep_good(docs, rules)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert R.judge(docs.limit(0), []).collect() == []


def test_rules_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    rules = R.fit(docs, labels.where("crc32(cast(doc_id as string)) % 3 != 1"))
    rest = R.judge(docs, rules).join(labels.where("crc32(cast(doc_id as string)) % 3 = 1"), "doc_id").where("not base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in rest.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.1 * sum(n for (q, _), n in counts.items() if q == 0) + 1


def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    out = M.classify(docs, labels)
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    label = dict(labels.select("doc_id", "quality").collect())
    held = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    good, bad = ([s for s, q in held if q == v] for v in (1, 0))
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.97
    assert M.classify(docs, labels).orderBy("doc_id").collect() == out.orderBy("doc_id").collect()


def test_classifier_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "a b c", "x"), (4, "a b c", "x"), (None, "q", "x"), (5, "w " * 90000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (3, None, 0), (None, 1, 0), (5, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = M.classify(docs, labels).collect()
    assert len(rows) == 7 and len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert all(r.score == 0.5 for r in M.classify(docs, labels.limit(0)).collect())
    assert M.classify(docs.limit(0), labels).collect() == []


def test_ftrl_against_a_loop():
    """The vectorised updates equal the textbook's, one coordinate at a time."""
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(20, 5, replace=False)), rng.random(5), int(rng.random() < 0.5)) for _ in range(50)]
    p = M.FTRL()
    z, n = np.zeros(20), np.zeros(20)
    M.ftrl_pass(rows, z, n, p)
    zz, nn = [0.0] * 20, [0.0] * 20
    for slots, values, y in rows:
        w = {}
        for i in slots.tolist():
            w[i] = 0.0 if abs(zz[i]) <= p.l1 else -(zz[i] - (p.l1 if zz[i] > 0 else -p.l1)) / (
                (p.beta + nn[i] ** 0.5) / p.alpha + p.l2)
        q = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(slots.tolist(), values))))
        for i, v in zip(slots.tolist(), values):
            g = (q - y) * v
            s = ((nn[i] + g * g) ** 0.5 - nn[i] ** 0.5) / p.alpha
            zz[i] += g - s * w[i]
            nn[i] += g * g
    assert np.allclose(z, zz) and np.allclose(n, nn)


def test_training_rows_are_bounded_where_ids_repeat(spark, monkeypatch):
    rows = [(1, f"some text number {i} with words"  * 9) for i in range(3000)] + [(1, "same " * 60)] * 2000 + [(2, "other " * 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(R, "learn", lambda x, bad: seen.append(len(bad)) or [])
    assert R.fit(docs, labels, limit=2) == [] and seen == [2]
    fitted = []
    original = M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name: fitted.append(df.count()) or original(df, name))
    M.fit(docs, labels, M.F.lit(True), M.FTRL(rounds=1), max_rows=40)
    assert fitted[0] == 40


def test_features_against_a_loop():
    """Slots and values of one text, counted one by one: hashed words and pairs (log counts, unit
    length), the bias, and the shares of repeated pairs and triples."""
    import xxhash

    text = "a b c a b c a b Zürich . a"
    tokens, mask = [w.encode() for w in text.split(" ")], (1 << 64) - 1
    h = [xxhash.xxh64_intdigest(w) for w in tokens]
    pairs = [(x * int(M._PAIR) & mask) ^ y for x, y in zip(h, h[1:])]
    triples = [(x * int(M._PAIR) & mask) ^ y for x, y in zip(pairs, h[2:])]
    counts = Counter((x * int(M._ODD) & mask) >> (64 - 10) for x in h + pairs)
    norm = sum(np.log1p(c) ** 2 for c in counts.values()) ** 0.5
    want = {s: np.log1p(c) / norm for s, c in counts.items()}
    want |= {1024: 1.0, 1025: 1 - len(set(pairs)) / len(pairs), 1026: 1 - len(set(triples)) / len(triples)}
    slots, values = M.features(text, 10)
    assert len(slots) == len(set(slots.tolist())) and set(slots.tolist()) == set(want)
    assert all(abs(v - want[s]) < 1e-6 for s, v in zip(slots.tolist(), values.tolist()))


def test_rounds_add_up_the_shards_changes(spark):
    """Weights equal those of a slow version: each shard from the common state, changes added; scores are dot products."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(words[: 20 + 20 * (i % 2)], 30))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    p, bits = M.FTRL(rounds=2), 10
    got = M.fit(docs, labels, M.F.lit(True), p, bits=bits)
    shard = {r.doc_id: r.s for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {M.SHARDS}) as s").collect()}
    z, n = np.zeros((1 << bits) + 3), np.zeros((1 << bits) + 3)
    import pandas as pd

    for _ in range(p.rounds):
        dz, dn = np.zeros_like(z), np.zeros_like(n)
        for s in range(M.SHARDS):
            own = pd.DataFrame({"doc_id": [i for i, _ in rows if shard[i] == s]}).sample(frac=1, random_state=11)["doc_id"]
            zs, ns = z.copy(), n.copy()
            M.ftrl_pass([(*(lambda f: (f[0], f[1].astype(np.float32)))(M.features(rows[i][1], bits)), i % 2) for i in own], zs, ns, p)
            dz, dn = dz + zs - z, dn + ns - n
        z, n = z + dz, n + dn
    assert np.allclose(got, M._weights(z, n, p), atol=1e-6)
    for r in M.score(docs, got, bits).collect():
        slots, values = M.features(rows[r.doc_id][1], bits)
        assert abs(r.score - 1 / (1 + np.exp(-(got[slots] @ values)))) < 1e-9

import random
from collections import Counter

import numpy as np

from actlens.llm import decontamination as D


def language(rng, n):
    return [rng.choice(["the", "of", "a", "in", "is"]) if rng.random() < 0.4 else f"word{rng.randint(0, 400)}" for _ in range(n)]


def items(rng, n=70):
    out = []
    for i in range(n):
        a, b = language(rng, rng.randint(6, 40)), language(rng, rng.randint(1, 12))
        out.append((i, f"{' '.join(a).capitalize()}. {' '.join(b).capitalize()}."))
    return out + [(500, "single sentence of eight words without any end"), (501, None), (502, ""), (503, "..."), (7, out[7][1])]


def documents(rng, bench):
    docs = []
    for d in range(80):
        parts = [" ".join(language(rng, rng.randint(0, 200)))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            _, text = rng.choice(bench[:-4])
            how = rng.random()
            if how < 0.2:
                text = text.upper()
            elif how < 0.4:
                text = " ".join(text.split()[: len(text.split()) // 2])
            elif how < 0.5:
                text = text.replace(" ", "\n")
            parts += [text, " ".join(language(rng, rng.randint(0, 150)))]
        docs.append((d, " ".join(parts)))
    return docs + [(900, None), (901, ""), (902, " ... "), (3, docs[5][1]), (None, docs[6][1])]


def brute_share(part, terms):
    if not part:
        return 1.0
    n = min(5, len(part))
    want = {tuple(part[i:i + n]) for i in range(len(part) - n + 1)}
    there = {tuple(terms[i:i + n]) for i in range(len(terms) - n + 1)}
    return len(want & there) / len(want)


def build(bench):
    own = [(i, *D.question_and_answer(t)) for i, t in bench]
    own = [x for x in own if x[1] or x[2]]
    return D.Index(own, Counter(t for _, q, a in own for t in set(q + a)), len(own), 25.0), own


def test_retrieval_equals_exhaustive_bm25(monkeypatch):
    rng = random.Random(1)
    bench = items(rng)
    texts = [t for _, t in documents(rng, bench)]
    for blocks in (64, 5):
        monkeypatch.setattr(D, "BLOCKS", blocks)
        index, own = build(bench)
        df = Counter(t for _, q, a in own for t in set(q + a))
        weight = []
        for _, q, a in own:
            bag = Counter(q + a)
            size = sum(bag.values())
            w = {t: np.log(1 + (len(own) - df[t] + 0.5) / (df[t] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / 25))
                 for t, n in bag.items()}
            weight.append({t: x / sum(w.values()) for t, x in w.items()})
        m = index.longest
        for threshold in (0.25, 0.6):
            got = {(a, b, c): s for a, b, c, s in zip(*(x.tolist() for x in index.retrieve([index.encode(t) for t in texts], threshold)))}
            want = {}
            for k, t in enumerate(texts):
                terms = D.terms_of(t)
                for p in range(max(1, -(-len(terms) // m))):
                    here = set(terms[p * m:(p + 2) * m])
                    for j, w in enumerate(weight):
                        s = sum(x for t, x in w.items() if t in here)
                        if s >= threshold:
                            want[k, p, j] = s
            assert got.keys() == want.keys()
            assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_query_against_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    bench = items(rng)
    docs = documents(rng, bench)
    table = spark.createDataFrame([(*d, 1, 2.0) for d in docs], "doc_id long, text string, item_id int, score double")
    marks = spark.createDataFrame([(*b, "x") for b in bench], "item_id long, text string, doc_id string")
    # Verified are exactly the items whose question and answer are there (each text is short: one look at all of it).
    want = sorted((str(d), i) for d, t in docs for i, q, a in build(bench)[1]
                  if brute_share(q, D.terms_of(t)) >= 0.8 and brute_share(a, D.terms_of(t)) >= 0.8)
    got = D.contaminated(table.repartition(3), marks, threshold=0.5).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == want and len(want) > 30
    monkeypatch.setattr(D, "SHARD_BYTES", 2000)
    frame = D.contaminated(table, marks, threshold=0.5)
    again = frame.collect()
    # Several shards share a pass over the texts.
    shards = -(-sum(len(r.text.encode()) for r in marks.collect() if D.terms_of(r.text)) // 2000)
    passes = frame._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    assert shards > 1 and passes == -(-shards // D.SHARDS_PER_PASS)
    monkeypatch.setattr(D, "SHARDS_PER_PASS", 1)
    assert sorted(map(tuple, D.contaminated(table, marks, threshold=0.5).collect())) == sorted(map(tuple, again))
    assert sorted(map(tuple, again), key=repr) != [] and sorted((str(r.doc_id), r.item_id) for r in again) == want
    left = D.decontaminate(table, marks, threshold=0.5)
    assert left.columns == table.columns
    leaked = {d for d, _ in want}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _ in docs if str(d) not in leaked or d is None)
    assert D.contaminated(table, marks.limit(0)).collect() == [] and D.contaminated(table.limit(0), marks).collect() == []


def test_items_with_a_word_changed_or_cut_off(spark):
    """At the registered defaults; an item counts while 0.8 of the shingles of all of it are there."""
    rng = random.Random(5)
    bench = [(i, f"{' '.join(language(rng, rng.randint(30, 60)))}. {' '.join(language(rng, rng.randint(1, 8)))}.") for i in range(60)]
    bench += [(100 + i, " ".join(language(rng, rng.randint(40, 60)))) for i in range(20)]  # one sentence
    docs, want = [], set()
    for i, text in bench:
        words = text.split()
        middle = len(words) - rng.randint(2, 6)
        for j, edited in enumerate([words[:-1], [*words[:-1], "other"], [*words[:middle], "other", *words[middle + 1:]],
                                    [*words[:middle], "other", *words[middle:]], words[1:], words[:len(words) * 7 // 10]]):
            passage = " ".join([*language(rng, 50), "before", *edited, "after", *language(rng, 50)])
            docs.append((i * 10 + j, passage))
            if brute_share(D.terms_of(text), D.terms_of(passage)) >= 0.8:
                want.add((i * 10 + j, i))
    rows = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(bench, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert got == want and len(rows) == len(got)
    assert {d % 10 for d, _ in want} == {0, 1, 2, 3, 4}  # what lost three tenths of its words is no hit
    assert sum(r.answer_overlap < 0.8 for r in rows) > 100


def test_leaked_rows_without_an_id_go(spark):
    rng = random.Random(6)
    bench = items(rng)
    clean = [" ".join(language(rng, 80)) for _ in range(4)]
    leaked = [f"{clean[i]} {bench[i][1]} {clean[i]}" for i in range(3)]
    rows = [(None, leaked[0], 0), (None, leaked[0], 1), (None, clean[0], 2), (None, None, 3), (None, "", 4), (None, clean[0], 5),
            (1, leaked[1], 6), (1, clean[1], 7), (2, clean[2], 8), (0, leaked[2], 9), (3, leaked[0], 10), (4, clean[3], 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a int").repartition(3)
    left = D.decontaminate(docs, spark.createDataFrame(bench, "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted(r.a for r in left.collect()) == [2, 3, 4, 5, 8, 11]


def test_defaults_find_all_that_verify():
    """Also items whose weight sits in one or two rare words, where the rare words are missing."""
    rng = random.Random(8)
    words = ("which of the following is in the list of the words that are in the text of the {} in the end of the day of the week. "
             "it is the one of the {}.")
    bench = [(i, words.format(f"rare{i}", f"gem{i}")) for i in range(40)] + [(100 + i, t) for i, t in items(rng, 40)[:40]]
    texts = [t for _, t in documents(rng, bench + [(0, "")] * 4)]
    for i in (0, 7):
        t = bench[i][1].split()
        texts += [" ".join(["x", *some, "y"]) for some in (t, t[:-1], [w for w in t if "rare" not in w], t[:20])]
    index, own = build(bench)
    found = index.matches([index.encode(t) for t in texts], 0.6, 0.8)
    want = set()
    for k, t in enumerate(texts):
        terms = D.terms_of(t)
        passages = [terms[p:p + 2 * index.longest] for p in range(0, max(1, len(terms)), index.longest)]
        want |= {(k, j) for j, (_, q, a) in enumerate(own) for p in passages
                 if (brute_share(q, p) >= 0.8 and brute_share(a, p) >= 0.8) or brute_share(q + a, p) >= 0.8}
    assert set(found) == want and len(want) > 100
    full = index.matches([index.encode(t) for _, t in bench], 0.6, 0.8)
    assert all(abs(full[k, k][2] - 1) < 1e-6 for k in range(len(bench)))


def test_question_and_answer():
    assert D.question_and_answer("What is it? An Answer, here.") == ([b"what", b"is", b"it"], [b"an", b"answer", b"here"])
    assert D.question_and_answer("one two three four") == ([b"one", b"two", b"three"], [b"four"])
    assert D.question_and_answer(None) == ([], [])

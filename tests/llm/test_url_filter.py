import math
import random
import re
import zlib
from collections import Counter

from actlens.llm import url_filter as U


def brute(urls, rules):
    """Rules, counts, interpolation, calibration in plain Python."""
    out, good, fold = [], [], []
    for u in urls:
        u = u or ""
        host = path = ""
        if "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host):]).group()
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [(len(r), r, v) for r, v in rules for h, p in [(r.split("/")[0], r[r.index("/"):])]
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        out.append([host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else None])
        good.append(max(fit)[2] == "allow" if fit else None)
        fold.append(zlib.crc32(u.encode()) % 5 == 0)

    def model(which):
        counts = Counter()
        for u in which:
            padded = U.START * U.ORDER + u + U.END
            for i in range(U.ORDER, len(padded)):
                for k in range(U.ORDER + 1):
                    counts[padded[i - k:i + 1]] += 1
        context, kinds = Counter(), Counter()
        for g, n in counts.items():
            context[g[:-1]] += n
            kinds[g[:-1]] += 1

        def p(gram):
            lower = p(gram[1:]) if len(gram) > 1 else 1 / U.ALPHABET
            n, t = context[gram[:-1]], kinds[gram[:-1]]
            return (counts[gram] + t * lower) / (n + t) if n + t else lower
        return p

    def score(u, a, b):
        g = U.grams(u)
        return sum(math.log(a(x)) - math.log(b(x)) for x in g) / len(g)

    urls = [u or "" for u in urls]
    a, b = (model([u for u, g in zip(urls, good) if g is w]) for w in (True, False))
    # Calibration: models without every fifth decided URL; the first of the best cuts between two occupied bins.
    fit_a, fit_b = (model([u for u, g, f in zip(urls, good, fold) if g is w and not f]) for w in (True, False))
    bins = [(math.floor(max(-U.RANGE, min(U.RANGE, score(u, fit_a, fit_b))) * U.BINS), g)
            for u, g, f in zip(urls, good, fold) if g is not None and f]
    rate = {k: sum(g and x >= k for x, g in bins) / sum(g for _, g in bins) + sum(not g and x < k for x, g in bins) / sum(not g for _, g in bins)
            for k in {x for x, _ in bins}}
    at = min(k for k, r in rate.items() if r >= max(rate.values()) - 1e-12)
    below = [k for k in rate if k < at]
    threshold = (at + max(below) + 1) / 2 / U.BINS if below else at / U.BINS
    return out, [None if g is not None else score(u, a, b) for u, g in zip(urls, good)], threshold


def some_urls():
    rng = random.Random(5)
    words = ["news", "shop", "casino", "blog", "wiki", "win", "free"]
    out = []
    for i in range(300):
        host = rng.choice(["A.example", "www.example", "x" + rng.choice(words)]) + rng.choice([".com", ".org", ".net"])
        out.append(f"http://{host}/{rng.choice(['fr', 'de', 'en', 'es'])}/{rng.choice(words)}{rng.choice(['', '?q=1', '#t', '/1'])}")
    return out + [None, "", "no scheme", "http://", "http://example.org", "HTTP://EXAMPLE.ORG/es/", "http://example.org/en/12?x",
                  "http://notexample.org/es/", "http://org/", "http://é.com/fr/ü", out[0], out[0], "http://a.net/" + "x" * 3000]


def test_equals_brute_force(spark):
    urls = some_urls()
    rows = spark.createDataFrame([(i, u, 1, "c") for i, u in enumerate(urls)], "page_id long, url string, key int, gram string")
    got = sorted(map(tuple, U.judge(rows.repartition(3)).collect()))
    want, scores, threshold = brute(urls, U.RULES)
    assert [g[0] for g in got] == list(range(len(urls)))
    assert [list(g[1:4]) for g in got] == [w[:3] for w in want]
    for g, w, s in zip(got, want, scores):
        assert (g[5] is None) == (s is None)
        if s is None:
            assert g[4] == w[3]
        else:
            assert abs(g[5] - s) < 1e-9
            assert abs(s - threshold) > 1e-7 and g[4] == ("allow" if s >= threshold else "block")
    # one threshold parts allowed from blocked
    allowed = [g[5] for g in got if g[5] is not None and g[4] == "allow"]
    blocked = [g[5] for g in got if g[5] is not None and g[4] == "block"]
    assert allowed and blocked and min(allowed) > max(blocked)


def test_one_class_only_and_empty(spark):
    rows = spark.createDataFrame([(1, "http://a.org/"), (2, "http://a.net/")], "page_id long, url string")
    assert sorted(map(tuple, U.judge(rows).collect())) == [
        (1, "a.org", "/", "org/", "allow", None), (2, "a.net", "/", None, "allow", 0.0)]
    assert U.judge(rows.limit(0)).collect() == []

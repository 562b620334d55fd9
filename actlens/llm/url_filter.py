"""URL filter: rules, and for the rest a character language-model ratio.

*Rules* are hosts with a path prefix; a rule fits its host and all subdomains
where the URL's path starts with the rule's, and the longest fitting rule
decides.

*Model*: two smoothed Markov models of variable order over characters, one for
the URLs that a rule accepts and one for those that a rule rejects.  Orders 0
to ``ORDER`` are interpolated (Witten-Bell): a context that is rarely seen
hands more weight to the next shorter one.  Characters are counted over all
URLs that a rule decides, at every position, with start and end marks.

*Score*: the difference of both log-likelihoods, divided by the number of
characters.  *Calibration*: the models are counted a second time without every
fifth decided URL (by checksum), those URLs are scored, and the threshold with
the best mean of both classes' hit rates is taken from the histogram of their
scores.  URLs that no rule decides are allowed if their score reaches it.

Counts, contexts and probabilities are Spark tables that are joined on the
character sequences which occur; nothing but the histogram (a fixed number of
bins) reaches the driver.

The score bins reach to +-``RANGE``; calibration scores beyond share the outermost bins, scores
themselves are not cut.  Repeated URLs count as often as they occur and get the same score; a score equal
to the threshold is allowed; an empty table gives an empty one; other columns are not read.  URLs are told
apart by a 64-bit hash.

A null URL counts as empty; without ``://`` host and path are empty.  Where
rules accept or reject nothing at all, the score is 0 and the rest is allowed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.sources.scratch import materialize

#: Longest context, in characters.
ORDER = 4
#: Probability of a character that was never seen: one in so many.
ALPHABET = 256
START, END = "\x02", "\x03"
#: Score bins a unit, and the largest score that has a bin of its own.
BINS, RANGE = 100, 10

#: The production rules (host and path prefix -> verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))

COUNTS = ("a", "b", "a_fit", "b_fit")  # accepted, rejected; the same without the calibration fold


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` (the rule's)."""
    host, path = host_and_path(F.col("url"))
    pages = pages.withColumn("host", host).withColumn("path", path)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is tested first
        site, slash, prefix = text.partition("/")
        fits = (F.col("host").eqNullSafe(site) | F.col("host").endswith("." + site)) & F.col("path").startswith(slash + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("verdict", verdict)


def grams(url: str) -> list[str]:
    """The characters of a URL (end mark last), each with ``ORDER`` before it."""
    padded = START * ORDER + url + END
    return [padded[i:i + ORDER + 1] for i in range(len(padded) - ORDER)]


def _counted(decided: DataFrame) -> DataFrame:
    """``gram`` and :data:`COUNTS` over the URLs ``decided`` (``url, good,
    fold``), combined in each batch before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, good, fold = (c.to_pylist() for c in batch.columns)
            sums = [Counter(), Counter(), Counter(), Counter()]
            for url, g, f in zip(urls, good, fold):
                seen = grams(url)
                sums[0 if g else 1].update(seen)
                if not f:
                    sums[2 if g else 3].update(seen)
            keys = list(sums[0] | sums[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in sums)], ["gram", *COUNTS])

    rows = decided.select("url", "good", "fold").mapInArrow(run, "gram string, " + ", ".join(f"{c} long" for c in COUNTS))
    return rows.groupBy("gram").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _occurrences(urls: DataFrame) -> DataFrame:
    """``url, gram, n`` of the distinct ``urls``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_url, out_gram, out_n = [], [], []
            for key, url in zip(*(c.to_pylist() for c in batch.columns)):
                seen = Counter(grams(url))
                out_url += [key] * len(seen)
                out_gram += seen.keys()
                out_n += seen.values()
            yield pa.RecordBatch.from_arrays([pa.array(out_url, pa.int64()), pa.array(out_gram, pa.string()),
                                              pa.array(out_n, pa.int64())], ["key", "gram", "n"])

    return urls.select("key", "url").mapInArrow(run, "key long, gram string, n long")


def _probabilities(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``gram`` and, for each of :data:`COUNTS`, ``p_...``: the interpolated
    probability of the gram's last character after the others, for every
    gram in ``wanted`` (distinct).

    Goes from single characters to the longest grams.  No key is hot: a
    context or shorter gram has at most as many rows as there are characters."""
    levels = {ORDER + 1: wanted.select("gram")}
    tables = {ORDER + 1: counts}
    for size in range(ORDER, 0, -1):
        shorter = F.col("gram").substr(F.lit(2), F.lit(size)).alias("gram")
        levels[size] = levels[size + 1].select(shorter).distinct()
        tables[size] = tables[size + 1].groupBy(shorter).agg(*[F.sum(c).alias(c) for c in COUNTS])
    known = None
    for size in range(1, ORDER + 2):
        context = F.col("gram").substr(F.lit(1), F.lit(size - 1)).alias("context")
        contexts = tables[size].groupBy(context).agg(
            *[F.sum(c).alias(f"n_{c}") for c in COUNTS], *[F.count_if(F.col(c) > 0).alias(f"t_{c}") for c in COUNTS])
        rows = levels[size].join(tables[size], "gram", "left").withColumn("context", context).join(contexts, "context", "left")
        if known is not None:
            rows = rows.withColumn("rest", F.col("gram").substr(F.lit(2), F.lit(size - 1))).join(known, "rest")
        p = []
        for c in COUNTS:
            lower = F.col(f"q_{c}") if known is not None else F.lit(1 / ALPHABET)
            seen, kinds, count = (F.coalesce(F.col(x), F.lit(0)) for x in (f"n_{c}", f"t_{c}", c))
            p.append(F.when(seen + kinds > 0, (count + kinds * lower) / (seen + kinds)).otherwise(lower).alias(f"p_{c}"))
        found = rows.select("gram", *p)
        known = found.select(F.col("gram").alias("rest"), *[F.col(f"p_{c}").alias(f"q_{c}") for c in COUNTS])
    return found


def _threshold(calibration: DataFrame) -> float:
    """The score with the best mean of both classes' hit rates, between two
    bins of the histogram; 0 if a class is missing."""
    bin_ = F.floor(F.greatest(F.lit(-RANGE), F.least(F.lit(RANGE), F.col("score"))) * BINS).cast("int").alias("bin")
    table = calibration.groupBy(bin_).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    table = table.toPandas().sort_values("bin")
    good, bad = table["good"].sum(), table["bad"].sum()
    if not good or not bad:
        return 0.0
    # allowed from a bin on: the good ones from there, the bad ones before it
    rate = (good - table["good"].cumsum() + table["good"]) / good + (table["bad"].cumsum() - table["bad"]) / bad
    best = table["bin"][rate >= rate.max() - 1e-12]
    at = int(best.iloc[0])
    lower = table["bin"][table["bin"] < at]
    # halfway into the empty bins below, if any
    return (at + int(lower.iloc[-1]) + 1) / 2 / BINS if len(lower) else at / BINS


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row of ``pages``
    (``page_id, url``); the score is null where a rule decides."""
    pages = judged(pages.select("page_id", F.coalesce("url", F.lit("")).alias("url")), rules).withColumn(
        "key", F.xxhash64("url"))
    decided = pages.where("verdict is not null").select(
        "key", "url", (F.col("verdict") == "allow").alias("good"), (F.crc32("url") % 5 == 0).alias("fold"))
    counts = materialize(_counted(decided), "url-counts")
    both = counts.agg(F.sum("a"), F.sum("b")).first()
    if not all(both):
        return pages.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"),
                            F.when(F.col("rule").isNull(), F.lit(0.0)).alias("score"))
    # Every distinct URL that needs a score, once.
    scored = pages.where("verdict is null").select("key", "url", F.lit(None).cast("boolean").alias("good")).union(
        decided.where("fold").select("key", "url", "good")).distinct()
    seen = materialize(_occurrences(scored), "url-grams")
    ratio = _probabilities(counts, seen.select("gram").distinct()).select(
        "gram", (F.log("p_a") - F.log("p_b")).alias("r"), (F.log("p_a_fit") - F.log("p_b_fit")).alias("r_fit"))
    total = F.sum("n")
    scores = materialize(seen.join(ratio, "gram").groupBy("key").agg(
        (F.sum(F.col("n") * F.col("r")) / total).alias("score"), (F.sum(F.col("n") * F.col("r_fit")) / total).alias("score_fit")),
        "url-scores")
    calibration = decided.where("fold").join(scores, "key").select("good", F.col("score_fit").alias("score"))
    threshold = _threshold(calibration)
    ruled = pages.where("verdict is not null").withColumn("score", F.lit(None).cast("double"))
    rest = pages.where("verdict is null").drop("verdict").join(scores.select("key", "score"), "key").withColumn(
        "verdict", F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block")))
    columns = ["page_id", "host", "path", "rule", "verdict", "score"]
    return ruled.select(*columns).union(rest.select(*columns))

"""Line dedup by site-relative frequency.

Lines are compared without surrounding blanks, tabs and carriage returns;
blank lines are never dropped.  For each host the pages that contain a line
are divided by all of the host's pages, and lines above the ratio are
boilerplate of that host and dropped from its pages.

Pages of a host with the same text count as one page: a page that was copied
a thousand times does not turn its body into boilerplate.  How many pages a share
has to be seen on is decided by the score test: a line found on k of n pages
is above the ratio r if k - r n > z sqrt(r (1 - r) n), which is the same as the lower
confidence bound of its share being above r.  No line of a host's only page is, a line on both
of two pages is, and on large hosts the share itself decides.  Nothing else exempts a page or
a host; a page of nothing but boilerplate becomes empty.

A null host is a host of its own; null and empty texts have no lines and stay; texts
of any length are cut whole, line by line; repeated rows are cut alike; an
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.sources.scratch import materialize

RATIO = 0.02
#: Standard errors by which a line's share has to exceed the ratio.
Z = 8.0


def test_slope(ratio: float, z: float) -> float:
    """The s for which k - r n > sqrt(s n) is the score test."""
    return z * z * ratio * (1 - ratio)


def _line_key(line: Column) -> Column:
    """96 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.crc32(line).alias("b"))


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                z: float = Z) -> DataFrame:
    """``host, gone``: the keys of each host's boilerplate lines.  A host has
    at most (mean lines of a page) / ratio of them.  Only keys of lines and
    texts are shuffled, combined on each task first; the totals of the hosts are written
    before the lines join them, so that a hot host's lines can be split."""
    pages = docs.where(F.col(text_col).isNotNull()).select(
        F.col(host_col).alias("host"), F.struct(F.xxhash64(text_col).alias("a"), F.crc32(text_col).alias("b")).alias("page"),
        F.col(text_col).alias("text"))
    lines = pages.select("host", "page", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")).select(
        "host", "page", _trimmed(F.col("line")).alias("line")).where("line != ''")
    lines = lines.select("host", "page", _line_key(F.col("line")).alias("line")).distinct()
    on_pages = lines.groupBy("host", "line").agg(F.count("page").alias("n"))
    totals = materialize(pages.select("host", "page").distinct().groupBy("host").agg(F.count("page").alias("total")), "hosts")
    over = F.col("n") - F.lit(ratio) * F.col("total")
    found = on_pages.join(totals, on_pages["host"].eqNullSafe(totals["host"])).where(
        (over > 0) & (over * over > F.lit(test_slope(ratio, z)) * F.col("total")))
    return found.select(on_pages["host"], "line").groupBy("host").agg(F.collect_list("line").alias("gone"))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                     z: float = Z, counts: bool = True) -> DataFrame:
    """All rows and columns of ``docs``, with boilerplate lines taken out of
    ``text_col``, and with ``counts`` the columns ``n_lines`` and ``n_dropped``
    (long; they replace columns of ``docs`` with these names).

    The table of hosts is written first, so its size is known when the join
    is planned: it is broadcast only if small, and otherwise shuffled apart
    from its aggregate, so that a hot host's rows can be split."""
    gone = materialize(boilerplate(docs, host_col, text_col, ratio, z), "boilerplate")
    # The other columns travel as one struct, whatever their names.
    other = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *other).alias("row"), F.col(host_col).alias("site"),
                       F.col(text_col).alias("text"))
    joined = rows.join(gone, rows["site"].eqNullSafe(gone["host"]), "left").withColumn("lines", F.split("text", "\n"))
    joined = joined.withColumn("kept", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.filter(
        "lines", lambda x: ~F.array_contains("gone", _line_key(_trimmed(x))))))
    dropped = F.size("lines") - F.size("kept")
    null = F.col("text").isNull()
    own = {"n_lines": F.when(null, 0).otherwise(F.size("lines")).cast("long"),
           "n_dropped": F.when(null, 0).otherwise(dropped).cast("long")} if counts else {}
    return joined.select(
        *[F.array_join("kept", "\n").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c not in own],
        *[c.alias(name) for name, c in own.items()])

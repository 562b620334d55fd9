"""Conversation prefix trie by ROLLUP over positional turn-id columns.

Conversations that begin with the same turns share the nodes of a trie: a node
is a distinct sequence of first turns.  A turn becomes an id (128 bits of the SHA-256 of
role and text, and the text's bytes), a conversation is cut into blocks of
:data:`WIDTH` turns, and a block is a row with the positional columns ``t1 ... t8``.
``GROUP BY block, key, ROLLUP(t1, ..., t8)`` then aggregates all prefixes of all
conversations together, and ``grouping_id`` tells a prefix's length; a prefix that
ends before its column is filled is dropped.  ``key`` is the node at which the prior block ended, so
long conversations continue in further blocks however long they are, all in the
same query.  That node's name is the sum of 64-bit hashes of (position, turn id)
along its path, twice with different seeds, as exact decimals: it is the
same for everyone on the path and can be summed up across the ranges of a
conversation that holds a large part of all turns.

What a node needs from its whole subtree follows from sums over its members, so no
level-by-level pass is needed.  Say a conversation owns a node if it is the
smallest member.  It owns exactly its nodes from some depth on, hence

* bytes of all turns below a node = sum of its members' bytes - those before the node,
* bytes of the distinct nodes below it = the same for its owner, and for each
  other member only from the depth on from which that one owns nodes,
* leaves below it = members that own the childless node in which they end,
* children = the owner's next turn, if any, and the conversations that branch off here.

The first ROLLUP gives owners, from which each conversation's branching point follows;
the second sums these numbers.

Defined cases: rows without a ``conv_id`` belong to no conversation and are left out; a null
role or text is empty; rows of a conversation with the same ``turn`` (null first) are ordered by
their turn ids; repeated rows are turns of their own; an empty table gives no node, not
even a root; texts of any length only meet a hash; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.operators.ordinal import ordinal_within, running_totals_within
from actlens.sources.scratch import materialize

#: Turns in a block of columns.  Results do not depend on it.
WIDTH = 8
#: Ids whose decimal digits make up one piece of an end list.
PIECE = 4096

NODE = ["depth", "p1", "p2"]


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, id, bytes`` of every row with a ``conv_id``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"))


def rebuild(turns: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c anew: the first h turns of c - c % ``group``, then its own
    turns after its first h; h = crc32 of c's digits % ``heads``.  Returns ``conv_id, pos
    (from 1), id, bytes``, and for each conversation one more row with position 0."""
    numbered = materialize(ordinal_within(turns, ["conv_id"], ["turn", "id"], "position"), "numbered")
    first = numbered.where(F.col("position") < heads).groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "id", "bytes"))),
                    lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))).alias("first"))
    members = numbered.where("position = 1").select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int").alias("h"))
    members = members.join(first.withColumnRenamed("conv_id", "base"), "base", "left").select(
        "conv_id", "h", F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.array()).alias("head"))
    members = materialize(members, "members")
    shared = members.select("conv_id", F.posexplode("head").alias("p", "t")).selectExpr(
        "conv_id", "p + 1L as pos", "t.id as id", "t.bytes as bytes")
    own = numbered.join(members.selectExpr("conv_id", "h", "size(head) as n"), "conv_id").where("position > h").selectExpr(
        "conv_id", "position - h + n as pos", "id", "bytes")
    every = members.selectExpr("conv_id", "0L as pos", "cast(null as binary) as id", "cast(null as long) as bytes")
    return shared.union(own).union(every)


def _hashes(pos: str, turn: str) -> tuple[str, str]:
    """The two numbers that a turn adds to the name of a path."""
    return tuple(f"cast(xxhash64({seed}{pos}, {turn}) as decimal(38,0))" for seed in ("", "7, "))


def _rollup(blocks: DataFrame, *aggs: str) -> DataFrame:
    """All nodes with the given aggregates of their members: ``depth``, path name
    ``p1, p2``, parent's ``up1, up2``, ``before`` (bytes of the path before the last turn) and ``last``
    (bytes of the last turn)."""
    columns = [f"t{i}" for i in range(1, WIDTH + 1)]
    rolled = blocks.sparkSession.sql(
        f"SELECT block, k1, k2, kb, {', '.join(columns)}, grouping_id() AS g, {', '.join(aggs)} "
        f"FROM {{blocks}} GROUP BY block, k1, k2, kb, ROLLUP({', '.join(columns)})", blocks=blocks)
    # grouping_id has a bit set for each column that is rolled up: the last ones.
    rolled = rolled.withColumn("d", F.expr(f"{WIDTH} - length(replace(bin(g), '0', ''))"))
    ends_here = " ".join(f"WHEN {i} THEN t{i} IS NOT NULL" for i in range(1, WIDTH + 1))
    rolled = rolled.where(F.expr(f"CASE d WHEN 0 THEN block = 0 {ends_here} END"))

    def along(value, upto: str) -> str:
        return " + ".join(f"CASE WHEN {i} <= {upto} THEN {value(i)} ELSE 0 END" for i in range(1, WIDTH + 1))

    one, two = (lambda i, s=s: _hashes(f"block * {WIDTH} + {i}L", f"t{i}.id")[s] for s in (0, 1))
    size = lambda i: f"t{i}.bytes"
    names = [a.rpartition(" ")[2] for a in aggs]
    last = " ".join(f"WHEN {i} THEN t{i}.bytes" for i in range(1, WIDTH + 1))
    return rolled.selectExpr(
        f"block * {WIDTH} + d AS depth", f"cast(k1 + {along(one, 'd')} as decimal(38,0)) AS p1",
        f"cast(k2 + {along(two, 'd')} as decimal(38,0)) AS p2", f"cast(k1 + {along(one, 'd - 1')} as decimal(38,0)) AS up1",
        f"cast(k2 + {along(two, 'd - 1')} as decimal(38,0)) AS up2", f"kb + {along(size, 'd - 1')} AS before",
        f"CASE d WHEN 0 THEN 0L {last} END AS last", *names)


def _blocks(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, conversations): a row per conversation and block with ``t1 ...``, the
    block's key ``k1, k2`` and the bytes before it ``kb``; a row per conversation with its length, bytes and path name."""
    one, two = _hashes("pos", "id")
    hashed = turns.withColumn("s1", F.when(F.col("id").isNotNull(), F.expr(one))).withColumn(
        "s2", F.when(F.col("id").isNotNull(), F.expr(two)))
    whole = hashed.groupBy("conv_id").agg(
        F.max("pos").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total"),
        *[F.coalesce(F.sum(s), F.lit(0)).cast("decimal(38,0)").alias(p) for s, p in (("s1", "p1"), ("s2", "p2"))])
    whole = materialize(whole, "whole")
    cut = hashed.groupBy("conv_id", F.expr(f"greatest(pos - 1, 0) div {WIDTH}").alias("block")).agg(
        F.filter(F.array_sort(F.collect_list(F.struct("pos", "id", "bytes"))), lambda t: t["id"].isNotNull()).alias("turns"),
        *[F.coalesce(F.sum(s), F.lit(0)).cast("decimal(38,0)").alias(s) for s in ("s1", "s2")],
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("sb"))
    summed = running_totals_within(cut, ["conv_id"], ["block"], {"r1": "s1", "r2": "s2", "rb": "sb"})
    slots = [f"CASE WHEN size(turns) >= {i} THEN struct(turns[{i - 1}].id AS id, turns[{i - 1}].bytes AS bytes) END AS t{i}"
             for i in range(1, WIDTH + 1)]
    rows = summed.selectExpr("conv_id", "block", "cast(r1 - s1 as decimal(38,0)) AS k1", "cast(r2 - s2 as decimal(38,0)) AS k2",
                             "rb - sb AS kb", *slots)
    return materialize(rows, "blocks"), whole


def _ends(whole: DataFrame) -> DataFrame:
    """Per node in which conversations end, the SHA-256 of their ids.  The ids of a node
    are sorted over the cluster and joined to pieces of digits first; a node's pieces then run
    through one hash in order, of which only its state is held."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def flush():
            return pa.RecordBatch.from_pylist(
                [dict(zip(NODE, node)) | {"first": ids[0], "ids": ",".join(map(str, ids))}], schema=piece_schema)

        for batch in batches:
            for *at, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (at != node or len(ids) == PIECE):
                    yield flush()
                    ids.clear()
                node = at
                ids.append(conv_id)
        if ids:
            yield flush()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def done():
            return pa.RecordBatch.from_pylist([dict(zip(NODE, node)) | {"ends": state.hexdigest()}], schema=digest_schema)

        for batch in batches:
            for *at, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if at == node:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    yield done()
                node, state = at, sha256(ids.encode())
        if state is not None:
            yield done()

    name = [("depth", pa.int64()), ("p1", pa.decimal128(38, 0)), ("p2", pa.decimal128(38, 0))]
    piece_schema = pa.schema([*name, ("first", pa.int64()), ("ids", pa.string())])
    digest_schema = pa.schema([*name, ("ends", pa.string())])
    shape = "depth long, p1 decimal(38,0), p2 decimal(38,0)"
    rows = whole.select(F.col("n").alias("depth"), "p1", "p2", "conv_id")
    n = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(n, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        pieces, f"{shape}, first long, ids string")
    return cut.repartition(n, *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, f"{shape}, ends string")


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the conversations ``conv_id, pos, id, bytes`` (as :func:`rebuild` gives them):
    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.  Intermediate tables, all without texts, are written to the scratch folder."""
    blocks, whole = _blocks(turns)
    sized = blocks.join(whole.select("conv_id", "n", "total"), "conv_id")
    owned = materialize(_rollup(sized, "min(conv_id) AS conv_id", "max(n) AS longest"), "owned")

    # Where each owner branches off, and who owns that place.
    branch = owned.groupBy("conv_id").agg(
        F.min("depth").alias("from"), *[F.min_by(c, "depth").alias(c) for c in ("up1", "up2", "before")],
        F.max((F.col("longest") == F.col("depth")).cast("int")).alias("leaf"))
    branch = materialize(branch, "branch")
    at = branch.where("from > 0").groupBy((F.col("from") - 1).alias("depth"), F.col("up1").alias("p1"), F.col("up2").alias("p2")).agg(
        F.count(F.lit(1)).alias("branches"))
    at = materialize(at.join(owned.select(*NODE, F.col("conv_id").alias("parent")), NODE), "branches")
    to = at.select((F.col("depth") + 1).alias("from"), F.col("p1").alias("up1"), F.col("p2").alias("up2"), "parent")
    owners = branch.join(to, ["from", "up1", "up2"], "left").select("conv_id", "from", "before", "leaf", "parent")
    owners = materialize(whole.select("conv_id", "n", "total").join(owners, "conv_id", "left").selectExpr(
        "conv_id", "n", "total", "from", "parent", "coalesce(leaf, 0) AS leaf",
        "CASE WHEN from IS NULL THEN 0L ELSE total - before END AS alone"), "owners")

    nodes = _rollup(blocks.join(owners.select("conv_id", "total", "alone", "leaf"), "conv_id"), "min(conv_id) AS conv_id",
                    "count(1) AS n_convs", "sum(total) AS all_bytes", "sum(alone) AS alone_bytes", "sum(leaf) AS n_leaves")
    owner = owners.select("conv_id", "n", "from", "parent", F.col("total").alias("own"), F.col("alone").alias("own_alone"))
    nodes = nodes.join(owner, "conv_id").join(at.select(*NODE, "branches"), NODE, "left").join(_ends(whole), NODE, "left")
    return nodes.selectExpr(
        "conv_id", "depth", "CASE WHEN depth = 0 THEN NULL WHEN from = depth THEN parent ELSE conv_id END AS parent_conv_id",
        "n_convs", "CASE WHEN n > depth THEN 1L ELSE 0L END + coalesce(branches, 0L) AS n_children", "n_leaves",
        "(all_bytes - n_convs * before) - (own - before + alone_bytes - own_alone) AS saved_tokens",
        f"coalesce(ends, '{sha256(b'').hexdigest()}') AS ends_sha256")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (:func:`rebuild`, :func:`trie`)."""
    return trie(materialize(rebuild(turn_ids(conversations)), "rebuilt"))

"""Vector code compression: product codes fitted with metric trees.

A vector becomes integers (``floor(4096 * x)``) and is cut into equal parts; each
part position has a codebook whose entries are refined by rounds of nearest
assignment and averaging, and a vector's code names the nearest entry per part.

Assignment is exact but rarely looks at single vectors.  The vectors are cut
into shards of :data:`SHARD` rows, and over each shard and part position an
anchors hierarchy is built once, *middle-out*: about the square root of the
points are picked as anchors, each the point farthest from its anchor so far,
and take over the points that are nearer to them (a point is only compared if the
triangle inequality allows it to move); each anchor's points are then split the
same way downwards, and the anchors are joined pair by pair upwards.  Every ball
caches the sum and the number of its points.  A round hands the list of
entries down the tree: in a ball of centre c and radius r, an entry f is out once
``|c-f|^2 - |c-e|^2 > 2 r |f-e|`` for the entry e nearest to c, since every
point of the ball is then strictly nearer to e.  Children inherit the shorter list, a
ball with one entry left is added as a whole, and only points of leaves
that still have several entries are compared one by one, in exact integers.

The trees are written once to the shared scratch folder; each round is one job
over them that returns sums and counts per (part, entry), which is all that
reaches the driver besides the first entries.

Defined cases: rows whose vector is null or holds a null or non-finite
component are left out, and so are rows whose vector cannot be cut like the others
(another length than the kept row with the smallest ``vec_id``, or no positive multiple of
the number of parts).  Starting entries are taken by ``vec_id``, equal ids by vector, rows without
an id last; with fewer rows than entries there are fewer entries.  Ties go to the lower entry.
Repeated rows are rows of their own.  An empty table gives an empty one.  Other columns are not read.
Components so large that squared distances of a part leave 64 bits are refused (``ValueError``).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actlens.sources.scratch import materialize

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096.0
#: Rows under one tree, and points in a ball that is not split further.  Results do not depend on them.
SHARD, LEAF = 2048, 32


class _Ball:
    __slots__ = ("rows", "left", "right", "total", "radius")

    def __init__(self, points: np.ndarray, rows: np.ndarray, left: _Ball | None = None, right: _Ball | None = None):
        own = points[rows]
        self.rows, self.left, self.right, self.total = rows, left, right, own.sum(0)
        off = own - self.total / len(rows)
        self.radius = float(np.sqrt((off * off).sum(1).max()))

    @property
    def center(self) -> np.ndarray:
        return self.total / len(self.rows)


def _anchors(points: np.ndarray) -> list[np.ndarray]:
    """The points (row numbers) of each of about sqrt(n) anchors."""
    wanted = max(2, int(np.sqrt(len(points))))
    pivots = points[:1].astype(float)
    off = points - pivots[0]
    dist, owner = np.sqrt((off * off).sum(1)), np.zeros(len(points), np.int64)
    while len(pivots) < wanted:
        far = int(dist.argmax())
        if dist[far] == 0:
            break
        new = points[far].astype(float)
        between = np.sqrt(((pivots - new) ** 2).sum(1))
        may = np.flatnonzero(dist > between[owner] / 2)
        off = points[may] - new
        near = np.sqrt((off * off).sum(1))
        moved = may[near < dist[may]]
        dist[moved], owner[moved] = near[near < dist[may]], len(pivots)
        pivots = np.vstack([pivots, new])
    order = np.argsort(owner, kind="stable")
    return [x for x in np.split(order, np.cumsum(np.bincount(owner, minlength=len(pivots)))[:-1]) if len(x)]


def _build(points: np.ndarray, rows: np.ndarray) -> _Ball:
    if len(rows) > LEAF:
        groups = _anchors(points[rows])
        if len(groups) > 1:
            return _join(points, [_build(points, rows[g]) for g in groups])
    return _Ball(points, rows)


def _join(points: np.ndarray, balls: list[_Ball]) -> _Ball:
    """Join the two balls that fit into the smallest one, until one is left."""
    centers, radii = np.array([b.center for b in balls]), np.array([b.radius for b in balls])
    cost = np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(2)) + radii[:, None] + radii[None]
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(balls) - 1):
        i, j = np.unravel_index(cost.argmin(), cost.shape)
        balls[i] = _Ball(points, np.concatenate([balls[i].rows, balls[j].rows]), balls[i], balls[j])
        centers[i], radii[i] = balls[i].center, balls[i].radius
        cost[j], cost[:, j] = np.inf, np.inf
        row = np.where(np.isinf(cost[i]), np.inf, np.sqrt(((centers - centers[i]) ** 2).sum(1)) + radii + radii[i])
        cost[i], cost[:, i] = row, row
        last = balls[i]
    return last


class Tree:
    """A hierarchy over the points of one shard and part, as flat arrays: the
    points in tree order, so that each ball is a range of them."""

    FIELDS = ("order", "lo", "hi", "left", "right", "radius", "total", "points")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def of(cls, points: np.ndarray) -> Tree:
        todo, balls, left, right, lo, order = [(_build(points, np.arange(len(points))), -1, 0)], [], [], [], [], []
        placed = 0
        while todo:
            ball, parent, side = todo.pop()
            at = len(balls)
            balls.append(ball)
            left.append(-1)
            right.append(-1)
            lo.append(placed)  # a ball comes before all that is in it, left to right
            if parent >= 0:
                (right if side else left)[parent] = at
            if ball.left is None:
                order.append(ball.rows)
                placed += len(ball.rows)
            else:
                todo += [(ball.right, at, 1), (ball.left, at, 0)]
        order = np.concatenate(order)
        narrow = np.int32 if np.abs(points).max(initial=0) < 2**31 else np.int64
        return cls(order=order.astype(np.int32), lo=np.array(lo, np.int32),
                   hi=np.array([x + len(b.rows) for x, b in zip(lo, balls)], np.int32),
                   left=np.array(left, np.int32), right=np.array(right, np.int32),
                   radius=np.array([b.radius for b in balls]), total=np.array([b.total for b in balls], np.int64),
                   points=points[order].astype(narrow))

    def pack(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in self.FIELDS}

    @classmethod
    def unpack(cls, data: dict[str, bytes], width: int) -> Tree:
        kinds = dict.fromkeys(("order", "lo", "hi", "left", "right"), np.int32) | {"radius": np.float64, "total": np.int64}
        out = {name: np.frombuffer(data[name], kind) for name, kind in kinds.items()}
        out["points"] = np.frombuffer(data["points"], f"i{len(data['points']) // (len(out['order']) * width)}").reshape(-1, width)
        out["total"] = out["total"].reshape(-1, width)
        return cls(**out)

    def assign(self, book: np.ndarray, each: bool = False):
        """(sums, counts) per entry of ``book``, or with ``each`` the entry and
        the squared distance of every point, in the shard's order."""
        entries, size = book.astype(np.float64), (self.hi - self.lo).astype(np.int64)
        apart = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(2))
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
        owner = np.empty(len(self.order), np.int64) if each else None
        # An entry equal to a lower one never wins.
        first = ~np.tril(apart == 0, -1).any(1)
        nodes, open_ = np.zeros(1, np.int64), first[None].copy()
        while len(nodes):
            centers = self.total[nodes] / size[nodes, None]
            square = ((centers[:, None] - entries[None]) ** 2).sum(2)
            square[~open_] = np.inf
            near = square.argmin(1)
            least = square[np.arange(len(nodes)), near]
            # What rounding may add to a distance is on the safe side.
            slack = 1e-9 * (least + (self.radius[nodes] + 1) ** 2 + (entries ** 2).sum(1).max())
            open_ &= square - least[:, None] <= 2 * self.radius[nodes, None] * apart[near] + slack[:, None]
            whole = open_.sum(1) == 1
            np.add.at(sums, near[whole], self.total[nodes[whole]])
            np.add.at(counts, near[whole], size[nodes[whole]])
            leaf = ~whole & (self.left[nodes] < 0)
            if leaf.any():
                n = size[nodes[leaf]]
                rows = np.repeat(self.lo[nodes[leaf]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                own = self.points[rows].astype(np.int64)
                square = _squares(own, book)
                square[~np.repeat(open_[leaf], n, axis=0)] = np.iinfo(np.int64).max
                best = square.argmin(1)
                np.add.at(sums, best, own)
                counts += np.bincount(best, minlength=len(book))
                if each:
                    owner[rows] = best
            if each:
                for lo, hi, e in zip(self.lo[nodes[whole]], self.hi[nodes[whole]], near[whole]):
                    owner[lo:hi] = e
            down = ~whole & ~leaf
            nodes = np.concatenate([self.left[nodes[down]], self.right[nodes[down]]]).astype(np.int64)
            open_ = np.concatenate([open_[down], open_[down]])
        if not each:
            return sums, counts
        off = self.points.astype(np.int64) - book[owner]
        entry, error = np.empty_like(owner), np.empty_like(owner)
        entry[self.order], error[self.order] = owner, (off * off).sum(1)
        return entry, error


def _squares(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances (points x entries) in exact integers."""
    return (points * points).sum(1)[:, None] - 2 * (points @ book.T) + (book * book).sum(1)[None]


def _integers(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``floor(4096 x)``; refuses what 64-bit squares cannot hold."""
    out = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(out) and 4 * width * np.abs(out).max() ** 2 >= 2.0**62:
        raise ValueError("a vector component is too large for exact squared distances")
    return out.astype(np.int64).reshape(len(column), -1)


def _kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).alias("vector"))
    return rows.where(F.col("vector").isNotNull() & F.forall("vector", finite))


def _trees(kept: DataFrame, width: int) -> DataFrame:
    """A row per shard: its ids and labels and one packed tree per part."""
    tree = T.StructType([T.StructField(name, T.BinaryType()) for name in Tree.FIELDS])
    schema = T.StructType([T.StructField("vec_ids", T.ArrayType(T.LongType())),
                           T.StructField("labels", T.ArrayType(kept.schema["label"].dataType)),
                           T.StructField("trees", T.ArrayType(tree))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD):
                rows = batch.slice(at, SHARD)
                numbers = _integers(rows.column(2), width)
                packed = [Tree.of(numbers[:, p * width:(p + 1) * width]).pack() for p in range(PARTS)]
                ends = pa.array([0, rows.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, rows.column(0)), pa.ListArray.from_arrays(ends, rows.column(1)),
                     pa.array([packed], pa.list_(pa.struct([(name, pa.binary()) for name in Tree.FIELDS])))],
                    ["vec_ids", "labels", "trees"])

    return kept.mapInArrow(run, schema)


def _round(trees: DataFrame, books: list[list[list[int]]], width: int) -> list[list[list[int]]]:
    """The codebooks after one round: entries become the floor of their parts' mean."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [np.array(b, np.int64) for b in books]
        sums, counts = [np.zeros_like(b) for b in own], [np.zeros(len(b), np.int64) for b in own]
        for batch in batches:
            for packed in batch.column(0):
                for p, tree in enumerate(packed.as_py()):
                    s, n = Tree.unpack(tree, width).assign(own[p])
                    sums[p] += s
                    counts[p] += n
        part = [p for p, n in enumerate(counts) for _ in n]
        entry = [e for n in counts for e in range(len(n))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(np.concatenate(counts)),
             pa.array([row.tolist() for s in sums for row in s], pa.list_(pa.int64()))], ["part", "entry", "n", "s"])

    partial = trees.select("trees").mapInArrow(run, "part int, entry int, n long, s array<long>").where("n > 0")
    total = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(width)])
    books = [[list(entry) for entry in b] for b in books]
    for row in total.collect():  # at most PARTS * ENTRIES rows
        books[row.part][row.entry] = [row[f"s{j}"] // row.n for j in range(width)]
    return books


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS) -> tuple[DataFrame, list[list[list[int]]]]:
    """Codes of the kept rows (``vec_id, label, code, error``; written to the
    scratch folder) and the final codebooks (part, entry, component).  ``code`` has two
    hex digits a part; ``error`` is the squared distance to the coded vector."""
    kept = _kept(vectors, id_col, vector_col, label_col)
    sized = kept.where((F.size("vector") > 0) & (F.size("vector") % PARTS == 0))
    first = sized.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(1).collect()
    schema = T.StructType([T.StructField("vec_id", T.LongType()), kept.schema["label"],
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not first:
        return vectors.sparkSession.createDataFrame([], schema), [[] for _ in range(PARTS)]
    width = len(first[0].vector) // PARTS
    kept = kept.where(F.size("vector") == width * PARTS)
    start = [_integers(pa.array([r.vector], pa.list_(pa.float64())), width)[0].tolist()
             for r in kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).collect()]
    books = [[v[p * width:(p + 1) * width] for v in start] for p in range(PARTS)]
    trees = materialize(_trees(kept, width), "trees")
    for _ in range(rounds):
        books = _round(trees, books, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [np.array(b, np.int64) for b in books]
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels, packed = (batch.column(c)[i] for c in range(3))
                found = [Tree.unpack(t, width).assign(own[p], each=True) for p, t in enumerate(packed.as_py())]
                codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array([row.tobytes().hex() for row in codes], pa.string()),
                     pa.array(sum(error for _, error in found), pa.int64())], ["vec_id", "label", "code", "error"])

    return materialize(trees.mapInArrow(run, schema), "codes"), books


def books_digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return sha256(",".join(str(x) for b in books for entry in b for x in entry).encode()).hexdigest()


def codes(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: the codes with the
    error summed over rows of equal label (null labels together).  The sums, a row a
    label, are written before they are joined back, so that they are broadcast if small
    and a hot label's rows can be split if not."""
    coded, books = compress(vectors)
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    sums = sums.withColumnRenamed("label", "_label")
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))

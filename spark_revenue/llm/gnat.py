"""Hard negatives by a multiway hyperplane tree with distance ranges between siblings (GNAT).

Vectors are lifted onto a sphere by one more coordinate, so that a lower bound and an upper bound of the inner
product with an anchor become an annulus around the anchor, exactly.  The tree's split points come from a bounded
sample; every row goes to the nearest split point of each level, and for each split point and each
sibling the least and largest distance to the sibling's rows are taken over all rows.  A subtree is passed over where
a sibling's range misses the annulus; what is left is searched to the end, so results are exact.

Rows of neighbouring leaves make a shard of bounded size.  An anchor travels once to each shard in which a leaf
survives; there it meets the shard's rows as a matrix, and at most ``keep`` rows a window come back.  Each search
is done twice: in the anchor's own leaf for a first bound, then with the narrowed annulus in all leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .shared import Scratch

FANOUT = 16
LEVELS = 3
# The tree is fitted on this many rows at most, those with the least hashes; all rows are indexed.
SAMPLE = 16_384
LEAF_ROWS = 1024
SHARD_ROWS = (256, 16_384)
KEEP = 5
_ANCHORS_AT_ONCE = 256
_LAST = np.iinfo(np.int64).max

_ROW = "rid long, vec_id long, label long, vec array<double>"


@dataclass
class Tree:
    """Split points of all inner nodes: ``points[node]`` is a matrix, its children are the next level's nodes."""

    radius: float
    points: dict[tuple[int, ...], np.ndarray]
    ranges: dict[tuple[int, ...], np.ndarray]
    leaves: dict[tuple[int, ...], int]


def lifted(rows: np.ndarray, radius: float) -> np.ndarray:
    """Rows with the coordinate that puts them on the sphere."""
    more = np.sqrt(np.maximum(radius * radius - (rows * rows).sum(axis=1), 0.0))
    return np.concatenate([rows, more[:, None]], axis=1)


def apart(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of every row to every point."""
    squared = (rows * rows).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(squared, 0.0))


def _spread(rows: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows out of some three times as many, each the farthest from those chosen before it."""
    rows = rows[:: max(1, len(rows) // (3 * n))]
    chosen = [0]
    least = apart(rows, rows[:1])[:, 0]
    while len(chosen) < n and least.max() > 1e-6:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, apart(rows, rows[chosen[-1]][None, :])[:, 0])
    return rows[chosen]


def fit(sample: np.ndarray, radius: float, levels: int) -> Tree:
    """A tree over a sample; where a node's sample is one point, or empty, the node is a leaf."""
    tree = Tree(radius, {}, {}, {})
    todo = [((), lifted(sample, radius))]
    while todo:
        node, rows = todo.pop()
        points = _spread(rows, FANOUT) if len(node) < levels and len(rows) else rows[:0]
        if len(points) < 2:
            tree.leaves[node] = -1
            continue
        tree.points[node] = points
        near = apart(rows, points).argmin(axis=1)
        todo += [((*node, j), rows[near == j]) for j in range(len(points))]
    for n, node in enumerate(sorted(tree.leaves)):
        tree.leaves[node] = n
    return tree


def _descend(tree: Tree, rows: np.ndarray) -> Iterator[tuple[tuple[int, ...], np.ndarray, np.ndarray, np.ndarray]]:
    """(inner node, its rows, the child of each, their distances to its split points), from the root down."""
    todo = [((), np.arange(len(rows)))]
    while todo:
        node, own = todo.pop()
        if node not in tree.points or not len(own):
            continue
        far = apart(rows[own], tree.points[node])
        child = far.argmin(axis=1)
        yield node, own, child, far
        todo += [((*node, j), own[child == j]) for j in np.unique(child).tolist()]


def leaf_of(tree: Tree, rows: np.ndarray) -> np.ndarray:
    """The leaf of each lifted row."""
    if () in tree.leaves:
        return np.full(len(rows), tree.leaves[()])
    out = np.zeros(len(rows), np.int64)
    for node, own, child, _ in _descend(tree, rows):
        for j in np.unique(child).tolist():
            if (*node, j) in tree.leaves:
                out[own[child == j]] = tree.leaves[(*node, j)]
    return out


def survivors(tree: Tree, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which leaves (columns) can hold a row of one of an anchor's windows (rows of ``low`` and ``high``)."""
    alive = np.zeros((len(anchors), len(tree.leaves)), bool)
    flat = np.concatenate([anchors, np.zeros((len(anchors), 1))], axis=1)
    base = (anchors * anchors).sum(axis=1)[:, None] + tree.radius**2
    slack = 1e-6 * (tree.radius + np.sqrt(base.max(initial=1.0))) + 1e-6
    with np.errstate(invalid="ignore"):
        inner = np.sqrt(np.maximum(base - 2 * high, 0.0)) - slack
        outer = np.sqrt(np.maximum(base - 2 * low, 0.0)) + slack
        # Windows that no row can lie in: empty ones, and those within a negative distance.
        none = ~(low <= high) | (base - 2 * low < -slack)
    inner, outer = np.where(none, np.inf, inner), np.where(none, -np.inf, outer)
    todo = [((), np.arange(len(anchors)))]
    while todo:
        node, own = todo.pop()
        if node in tree.leaves:
            alive[own, tree.leaves[node]] = True
            continue
        if node not in tree.ranges or not len(own):
            continue
        far = apart(flat[own], tree.points[node])[:, None, :]
        nearest = np.maximum(far - outer[own][:, :, None], inner[own][:, :, None] - far)[..., None]
        farthest = (far + outer[own][:, :, None])[..., None]
        least, most = tree.ranges[node][..., 0], tree.ranges[node][..., 1]
        meets = ((most >= nearest) & (least <= farthest)).all(axis=2).any(axis=1)
        todo += [((*node, j), own[meets[:, j]]) for j in range(meets.shape[1])]
    return alive


def best(scores: np.ndarray, ids: np.ndarray, rids: np.ndarray, among: np.ndarray, keep: int) -> np.ndarray:
    """The first rows of ``among`` by score downwards, then id, then row."""
    if len(among) > keep:
        among = among[scores[among] >= np.partition(scores[among], -keep)[-keep]]
    return among[np.lexsort((rids[among], ids[among], -scores[among]))[:keep]]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column; shorter vectors end in zeros."""
    out = np.zeros((len(column), dim))
    if len(column):
        flat = column.flatten().to_numpy(zero_copy_only=False)
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        if len(flat) == out.size:
            return flat.reshape(out.shape)
        out[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return out


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.zeros(0), kind))


def _assign(shared, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: Tree = shared.value
        for batch in batches:
            leaf = leaf_of(tree, lifted(_matrix(batch.column("vec"), dim), tree.radius))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], [*batch.schema.names, "leaf"])

    return run


def _ranges(shared, dim: int):
    """Least and largest distance between split points and the rows of siblings, per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: Tree = shared.value
        number = {node: n for n, node in enumerate(sorted(tree.points))}
        for batch in batches:
            out = []
            for node, _, child, far in _descend(tree, lifted(_matrix(batch.column("vec"), dim), tree.radius)):
                for j in np.unique(child).tolist():
                    part = far[child == j]
                    out += [(number[node], i, j, lo, hi) for i, (lo, hi) in enumerate(zip(part.min(axis=0), part.max(axis=0), strict=True))]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["node", "i", "j", "lo", "hi"]
            )

    return run


def _route(shared, shards, dim: int, home: bool):
    """Anchors to the shards in which they have to look, with the leaves to look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: Tree = shared.value
        first, parts = shards.value
        for batch in batches:
            for start in range(0, batch.num_rows, _ANCHORS_AT_ONCE):
                some = batch.slice(start, _ANCHORS_AT_ONCE)
                rows = _matrix(some.column("vec"), dim)
                if home:
                    alive = np.zeros((len(rows), len(tree.leaves)), bool)
                    alive[np.arange(len(rows)), leaf_of(tree, lifted(rows, tree.radius))] = True
                else:
                    windows = [_matrix(some.column(k), KEEP) for k in ("lo", "hi")]
                    # A missing window is one that nothing fits.
                    absent = np.arange(KEEP)[None, :] >= some.column("lo").value_lengths().to_numpy(zero_copy_only=False)[:, None]
                    alive = survivors(tree, rows, np.where(absent, np.inf, windows[0]), np.where(absent, -np.inf, windows[1]))
                anchor, leaf = np.nonzero(alive & (parts > 0)[None, :])
                at, shard, visits = [], [], []
                for a in np.unique(anchor).tolist():
                    own = leaf[anchor == a]
                    goes = {}
                    for x in own.tolist():
                        for s in range(first[x], first[x] + parts[x]):
                            goes.setdefault(s, []).append(x)
                    at += [a] * len(goes)
                    shard += list(goes)
                    visits += [np.array(v, np.int32) for v in goes.values()]
                sent = some.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), *sent.columns, _lists(visits, pa.int32())], ["shard", *sent.schema.names, "visits"]
                )

    return run


def _search(dim: int, same: bool, keep: int):
    """Rows sorted by shard, a shard's own rows first: the best rows of each anchor's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, own = None, [], None

        def look(some: pa.RecordBatch) -> pa.RecordBatch:
            rids, ids, labels, leaves, rows = own
            anchors = _matrix(some.column("vec"), dim)
            scores = np.rint(anchors @ rows.T).astype(np.int64)
            out = []
            for a, (rid, label, lows, highs, visits) in enumerate(zip(*[some.column(k).to_pylist() for k in ("rid", "label", "lo", "hi", "visits")], strict=True)):
                fits = np.isin(leaves, visits) & ((labels == label) == same) & (rids != rid)
                fits &= (scores[a] >= min(lows)) & (scores[a] <= max(highs))
                among = np.flatnonzero(fits)
                of = scores[a][among]
                for w, (low, high) in enumerate(zip(lows, highs, strict=True)):
                    for x in best(scores[a], ids, rids, among[(of >= low) & (of <= high)], keep).tolist():
                        out.append((rid, w, int(scores[a][x]), None if ids[x] == _LAST else int(ids[x]), int(rids[x])))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["rid", "w", "score", "other", "other_rid"])

        for batch in batches:
            number = batch.column("shard").to_numpy(zero_copy_only=False)
            query = batch.column("kind").to_numpy(zero_copy_only=False) == 1
            edges = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (query[1:] != query[:-1])]))
            for x, y in zip(edges.tolist(), [*edges[1:].tolist(), len(number)], strict=True):
                if number[x] != shard:
                    shard, held, own = number[x], [], None
                if not query[x]:
                    held.append(batch.slice(x, y - x))
                    continue
                if not held and own is None:
                    continue
                if own is None:
                    table = pa.Table.from_batches(held).combine_chunks()
                    read = lambda k: table.column(k).to_numpy()
                    ids = table.column("vec_id").fill_null(_LAST).to_numpy()
                    vectors = pa.concat_arrays([b.column("vec") for b in held])
                    own, held = (read("rid"), ids, read("label"), read("leaf"), _matrix(vectors, dim)), []
                for start in range(x, y, _ANCHORS_AT_ONCE):
                    yield look(batch.slice(start, min(y - start, _ANCHORS_AT_ONCE)))

    return run


def _divisible(column: str, by: int) -> Column:
    return F.coalesce(F.col(column) % by == 0, F.lit(False))


def prepare(rows: DataFrame, ident: str, vector: str, label: str, noise: int, labels: int) -> DataFrame:
    """Rows that take part, as ``(rid, vec_id, label, vec)`` with whole-numbered components."""
    usable = F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    moved = F.when(_divisible(ident, noise), (F.col(label).cast("long") + 1) % labels).otherwise(F.col(label).cast("long"))
    return rows.filter(usable).select(
        F.monotonically_increasing_id().alias("rid"), F.col(ident).cast("long").alias("vec_id"), moved.alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("vec"),
    )


class Index:
    """The tree, its rows dealt to shards, and searches over both."""

    def __init__(self, scratch: Scratch, rows: DataFrame):
        self.scratch, self.spark = scratch, rows.sparkSession
        length = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
        n, dim, square = rows.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.max(length)).first()
        self.dim = max(dim or 1, 1)
        radius = math.sqrt(square or 0.0)
        levels = min(LEVELS, max(1, math.ceil(math.log(max(n / LEAF_ROWS, 2), FANOUT))))
        least = rows.select("vec", F.xxhash64("vec").alias("h")).orderBy("h").limit(SAMPLE).select("vec").toArrow()
        self.tree = fit(_matrix(pa.concat_arrays(least.column("vec").chunks) if n else pa.array([], pa.list_(pa.float64())), self.dim), radius, levels)
        shared = self.spark.sparkContext.broadcast(self.tree)
        dealt = scratch.save(rows.mapInArrow(_assign(shared, self.dim), f"{_ROW}, leaf int"), "dealt")
        self._measure(dealt, shared)
        self.shared = self.spark.sparkContext.broadcast(self.tree)
        shared.unpersist()
        self._share_out(dealt, n)

    def _measure(self, dealt: DataFrame, shared) -> None:
        found = dealt.select("vec").mapInArrow(_ranges(shared, self.dim), "node int, i int, j int, lo double, hi double")
        nodes = sorted(self.tree.points)
        # An empty subtree has a range that meets nothing.
        self.tree.ranges = {k: np.tile([np.inf, -np.inf], (len(p), len(p), 1)) for k, p in self.tree.points.items()}
        for node, i, j, lo, hi in found.groupBy("node", "i", "j").agg(F.min("lo"), F.max("hi")).toLocalIterator():
            self.tree.ranges[nodes[node]][i, j] = lo, hi

    def _share_out(self, dealt: DataFrame, n: int) -> None:
        """Shards of neighbouring leaves; a leaf beyond a shard's size is cut by row number."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        size = min(max(n // (4 * tasks), SHARD_ROWS[0]), SHARD_ROWS[1])
        counts = np.zeros(len(self.tree.leaves), np.int64)
        for leaf, rows in dealt.groupBy("leaf").count().toLocalIterator():
            counts[leaf] = rows
        first, parts, shard, room = np.zeros(len(counts), np.int64), -(-counts // size), 0, size
        for leaf, rows in enumerate(counts.tolist()):
            if rows > room:
                shard, room = shard + 1, size
            first[leaf] = shard
            if rows > size:
                shard, room = shard + int(parts[leaf]), size
            else:
                room -= rows
        self.shards = self.spark.sparkContext.broadcast((first, parts))
        table = self.spark.createDataFrame(
            [(leaf, int(first[leaf]), int(parts[leaf])) for leaf in range(len(counts)) if parts[leaf]], "leaf int, first int, parts int"
        )
        # At most FANOUT ** LEVELS rows.
        placed = dealt.join(F.broadcast(table), "leaf").withColumn("shard", (F.col("first") + F.col("rid") % F.col("parts")).cast("int"))
        self.rows = self.scratch.save(placed.drop("first", "parts"), "rows")
        self.scratch.drop("dealt")

    def search(self, anchors: DataFrame, *, home: bool, same: bool, name: str) -> DataFrame:
        """``(rid, w, place, score, other, other_rid)``: the best rows of each window of ``(…, lo, hi)``."""
        shape = f"shard int, {_ROW}, lo array<double>, hi array<double>, visits array<int>"
        sent = anchors.select("rid", "vec_id", "label", "vec", "lo", "hi").mapInArrow(
            _route(self.shared, self.shards, self.dim, home), shape
        ).withColumns({"kind": F.lit(1), "leaf": F.lit(None).cast("int")})
        none = F.lit(None)
        rows = self.rows.withColumns(
            {"kind": F.lit(0), "lo": none.cast("array<double>"), "hi": none.cast("array<double>"), "visits": none.cast("array<int>")}
        )
        met = rows.unionByName(sent).repartition("shard").sortWithinPartitions("shard", "kind")
        found = met.mapInArrow(_search(self.dim, same, KEEP), "rid long, w int, score long, other long, other_rid long")
        order = Window.partitionBy("rid", "w").orderBy(F.desc("score"), F.asc_nulls_last("other"), "other_rid")
        return self.scratch.save(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= KEEP), name)


def _bounds(found: DataFrame) -> DataFrame:
    """The score that ``KEEP`` rows of a window are known to reach."""
    return found.filter(F.col("place") == KEEP).select("rid", "w", F.col("score").cast("double").alias("reached"))


def mine(
    rows: DataFrame, *, ident: str = "vec_id", vector: str = "embedding", label: str = "label", anchor_every: int = 100,
    noise: int = 7, labels: int = 10, least: int = 80,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Rows with a null label, a null vector, or a null or non-finite component take no part; the label of every
    ``noise``-th id is moved on by one first.  Anchors are the rows whose id is divisible by ``anchor_every``.  Positives are an anchor's
    first five other rows of its label, negatives of each the first five rows of other labels that reach
    ``least`` percent of its score and don't exceed it.  Ties go to the smaller id, null ids last, then to
    either row.  Repeated rows are rows of their own, so a copy of the anchor is another row.  Shorter vectors
    end in zeros.  An empty table, or one without anchors, gives no row; other columns don't matter.
    """
    scratch = Scratch(rows.sparkSession)
    ready = scratch.save(prepare(rows, ident, vector, label, noise, labels), "ready")
    index = Index(scratch, ready)
    anchors = ready.filter(_divisible("vec_id", anchor_every))
    endless = {"lo": F.array(F.lit(float("-inf"))), "hi": F.array(F.lit(float("inf")))}
    guess = index.search(anchors.withColumns(endless), home=True, same=True, name="guess")
    bounded = anchors.join(_bounds(guess), "rid", "left").withColumns(
        {"lo": F.array(F.coalesce("reached", F.lit(float("-inf")))), "hi": F.array(F.lit(float("inf")))}
    )
    positives = index.search(bounded, home=False, same=True, name="positives")

    # One window for each positive, in the order of the positives.
    score = F.col("score").cast("double")
    listed = F.sort_array(F.collect_list(F.struct("place", (score * least / 100).alias("lo"), score.alias("hi"))))
    windows = positives.groupBy("rid").agg(listed.alias("windows"))
    ranged = anchors.join(windows, "rid").withColumns({"lo": F.col("windows.lo"), "hi": F.col("windows.hi")})
    guess = index.search(ranged, home=True, same=False, name="guessed_negatives")
    reached = _bounds(guess).groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("w", "reached"))).alias("reached"))
    narrowed = ranged.join(reached, "rid", "left").withColumn(
        "lo", F.transform("lo", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("reached", i), x)))
    )
    negatives = index.search(narrowed, home=False, same=False, name="negatives")
    scratch.drop("guess", "guessed_negatives", "rows")
    positive = positives.select("rid", (F.col("place") - 1).alias("w"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        negatives.join(positive, ["rid", "w"])
        .join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
        .select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )

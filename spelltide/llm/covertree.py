"""Hard negatives: windows of inner products, searched with cover trees over norm-augmented vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spelltide.llm.scratch import stored

#: Candidates from which the upper level of the tree is fitted, and cells that it has at most.
SAMPLE, MOST_CELLS = 4_096, 256
#: Components of the candidates, and of the anchors, that one task compares.
TILE = 1 << 19
#: Children of a node and points of a leaf at most.
FAN_OUT, LEAF = 16, 64
#: Anchors that are searched for at once, leaves that each visits first, best bound first, and leaves after which
#: the floors are raised again.
TOGETHER, FIRST, RAISED = 512, 4, 8
#: Components are smaller than this, so that inner products fit in a long.
LARGEST = 1 << 24
#: Ends of a window without any.
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _augmented(x: np.ndarray, norm: float) -> np.ndarray:
    """The vectors with one more component that brings all of them to one norm."""
    return np.column_stack([x, np.sqrt(np.maximum(norm * norm - (x * x).sum(1), 0))])


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    away = x - centre
    return np.sqrt((away * away).sum(1))


def _net(x: np.ndarray, within: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, each the point farthest from those before, until all points are `within` one or there are `most`.

    Returns the centres' rows, each point's nearest centre and its distance.
    """
    chosen, near, away = [0], np.zeros(len(x), np.int64), _distances(x, x[0])
    while len(chosen) < most and away.max() > within:
        new = int(away.argmax())
        far = _distances(x, x[new])
        closer = far < away
        near[closer], away[closer] = len(chosen), far[closer]
        chosen.append(new)
    return np.array(chosen), near, away


@dataclass
class _Tree:
    """Levels from the root down: centres, covering radii, each node's parent in the level above; leaves hold points."""

    centres: list[np.ndarray]
    radii: list[np.ndarray]
    parents: list[np.ndarray]
    leaves: list[list[np.ndarray | None]]

    @staticmethod
    def build(x: np.ndarray) -> _Tree:
        """Each level covers its points by balls of half the radius above where FAN_OUT centres a node can."""
        away = _distances(x, x[0])
        tree = _Tree([x[:1]], [np.array([away.max()])], [np.zeros(1, np.int64)], [])
        now = [np.arange(len(x))]
        while now:
            centres, radii, parents, leaves, after = [], [], [], [], []
            for node, points in enumerate(now):
                radius = tree.radii[-1][node]
                if len(points) <= LEAF or radius == 0:
                    leaves.append(points)
                    continue
                leaves.append(None)
                chosen, near, far = _net(x[points], radius / 2, FAN_OUT)
                for i, c in enumerate(chosen):
                    held = near == i
                    centres.append(x[points[c]])
                    radii.append(far[held].max())
                    parents.append(node)
                    after.append(points[held])
            tree.leaves.append(leaves)
            now = after
            if after:
                tree.centres.append(np.array(centres))
                tree.radii.append(np.array(radii))
                tree.parents.append(np.array(parents))
        return tree


class _Found:
    """The best `most` scores of each window, higher first, then the smaller id."""

    def __init__(self, windows: int, most: int, ids: np.ndarray):
        self.most, self.windows, self.ids = most, windows, ids
        self.window, self.score, self.row = (np.zeros(0, np.int64) for _ in range(3))
        self.fresh: list[tuple[np.ndarray, ...]] = []

    def add(self, window: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        self.fresh.append((window, score, row))

    def settle(self) -> _Found:
        """Keep the best of what was added."""
        if self.fresh:
            window, score, row = (np.concatenate(p) for p in zip((self.window, self.score, self.row), *self.fresh))
            self.fresh = []
            order = np.lexsort((self.ids[row], -score, window))
            window, score, row = window[order], score[order], row[order]
            keep = np.arange(len(window)) - np.searchsorted(window, window) < self.most
            self.window, self.score, self.row = window[keep], score[keep], row[keep]
        return self

    def floor(self) -> np.ndarray:
        """The score that a window's next find must reach."""
        self.settle()
        out = np.full(self.windows, LOWEST)
        count = np.bincount(self.window, minlength=self.windows)
        last = np.cumsum(count) - 1
        full = count >= self.most
        out[full] = self.score[last[full]]
        return out


def _slack(q: np.ndarray, norm: float) -> np.ndarray:
    """More than the rounding of a bound of an inner product."""
    return 1 + 1e-9 * np.sqrt((q * q).sum(1)) * norm


def _search(tree: _Tree, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, norm: float, q: np.ndarray, own: np.ndarray, label: np.ndarray, low: np.ndarray, high: np.ndarray, alike: bool, most: int) -> _Found:
    """For each anchor and window (low to high) the best candidates of its label (alike) or of others.

    A node's inner products with q lie within |q| times its radius of that of its centre. Nodes outside all of
    an anchor's windows are not descended. Each anchor first visits its leaves with the best bounds; what it finds raises
    its windows' floors, and only leaves that can still reach a floor are verified after that.
    """
    count, width = low.shape
    size, slack = np.sqrt((q * q).sum(1)), _slack(q, norm)
    upper_leaves, lower_leaves, points = [], [], []
    alive = np.ones((count, 1), bool)
    for level, centres in enumerate(tree.centres):
        score = q @ centres[:, :-1].T
        reach = size[:, None] * tree.radii[level][None, :] + slack[:, None]
        upper, lower = score + reach, score - reach
        alive = alive[:, tree.parents[level]] & (upper >= low.min(1)[:, None]) & (lower <= high.max(1)[:, None])
        leaf = np.array([p is not None for p in tree.leaves[level]])
        upper_leaves.append(np.where(alive, upper, -np.inf)[:, leaf])
        lower_leaves.append(lower[:, leaf])
        points += [p for p in tree.leaves[level] if p is not None]
        alive = alive.copy()
    upper, lower = np.concatenate(upper_leaves, 1), np.concatenate(lower_leaves, 1)
    found, floor = _Found(count * width, most, ids), low.copy()
    exact = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(x.shape[1], 1) < 2**52
    whole, whole_q = (x, q) if exact else (x.astype(np.int64), q.astype(np.int64))

    def verify(leaf: int, some: np.ndarray) -> None:
        held = points[leaf]
        score = whole_q[some] @ whole[held].T
        fits = (labels[held][None, :] == label[some][:, None]) == alike
        fits &= ids[held][None, :] != own[some][:, None]
        parts = []
        for w in range(width):
            a, b = np.nonzero(fits & (score >= floor[some, w][:, None]) & (score <= high[some, w][:, None]))
            parts.append((some[a] * width + w, score[a, b].astype(np.int64), held[b]))
        window, value, row = (np.concatenate(p) for p in zip(*parts))
        if len(window):
            found.add(window, value, row)

    def raised() -> np.ndarray:
        return np.maximum(low, found.floor().reshape(low.shape))

    order = np.argsort(-upper, 1, kind="stable")[:, :FIRST]
    seen = np.zeros(upper.shape, bool)
    for turn in range(order.shape[1]):
        leaf = order[:, turn]
        ready = upper[np.arange(count), leaf] >= floor.min(1)
        for one in np.unique(leaf[ready]):
            verify(one, np.flatnonzero(ready & (leaf == one)))
        seen[np.arange(count), leaf] = True
        floor = raised()
    for nth, leaf in enumerate(np.argsort(-upper.max(0, initial=-np.inf), kind="stable"), 1):
        some = np.flatnonzero(~seen[:, leaf] & (upper[:, leaf] >= floor.min(1)) & (lower[:, leaf] <= high.max(1)))
        if len(some):
            verify(leaf, some)
        if nth % RAISED == 0:
            floor = raised()
    return found.settle()


def _tile(norm: float, width: int, alike: bool, most: int):
    """Compares a tile's anchors with its candidates; returns (anchor_id, window, id, score)."""
    schema = pa.schema([("anchor_id", pa.int64()), ("window", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        left = left.sort_by("id")
        x = _matrix(left["vector"].combine_chunks(), width)
        ids, labels = left["id"].to_numpy(), left["label"].to_numpy()
        # Of candidates equal in vector and label no more than these can be among the best of any window.
        _, group = np.unique(np.column_stack([x, labels]), axis=0, return_inverse=True)
        order = np.argsort(group.ravel(), kind="stable")
        ranked = group.ravel()[order]
        keep = np.sort(order[np.arange(len(ranked)) - np.searchsorted(ranked, ranked) <= most])
        x, ids, labels = x[keep], ids[keep], labels[keep]
        tree = _Tree.build(_augmented(x, norm))
        parts = []
        for begin in range(0, right.num_rows, TOGETHER):
            some = right.slice(begin, TOGETHER)
            own = some["id"].to_numpy()
            low, high = (np.stack(some[c].to_numpy()) for c in ("low", "high"))
            q = _matrix(some["vector"].combine_chunks(), width)
            found = _search(tree, x, ids, labels, norm, q, own, some["label"].to_numpy(), low, high, alike, most)
            anchor, window = np.divmod(found.window, low.shape[1])
            parts.append(pa.table([own[anchor], window.astype(np.int32), ids[found.row], found.score], schema=schema))
        return pa.concat_tables(parts)

    return run


def _cells(sample: pa.Table, width: int, norm: float, cells: int) -> np.ndarray:
    """Centres of the upper level: a net of the sample, in halving radii until it has as many centres as cells."""
    x = _augmented(_matrix(sample["vector"].combine_chunks(), width), norm)
    return x[_net(x, 0.0, cells)[0]] if len(x) else np.zeros((1, width + 1))


def hard_negatives(
    df: DataFrame, key: str, vector: str, label: str, anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), all long but rank.

    `vector` holds arrays of integers; scores are inner products, where a shorter vector counts as filled up with
    zeros. An anchor's positives are the first other rows of its label; its negatives for a positive of score p are the first
    rows of other labels with least * p <= 100 * score <= most * p, ranked from 1. Higher scores come
    first, ties by the smaller key.

    Rows with a null key, label, vector or component, or a component of 2^24 or more in size, take no part. Of
    rows that share a key, one takes part, that with the smallest label and, of those, the smallest hash of its
    vector. An anchor without positives, a positive without negatives, and an empty table give no rows. Other
    columns are dropped, whatever their names.

    Candidates get one more component, which brings them all to one norm, and are dealt to cells of the tree's
    upper level: up to 256 centres from a sample of 4 096 rows, one for every task's worth of candidates. Cells
    are cut into slices, and anchors into batches, of 2^19 components each; a task builds the cover tree of one slice and searches it
    for one batch. Only anchors with a window that a cell's covering radius allows go to its slices.
    """
    good = F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False))), F.lit(False))
    rows = df.where(good).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<long>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows.withColumn("square", F.aggregate("vector", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))), "negatives-rows")
    narrow = rows.select("id", "row", F.struct("label", F.xxhash64("vector").alias("hash"), "row").alias("place"))
    repeated = narrow.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("best")).where("n > 1")
    losers = narrow.join(stored(repeated, "negatives-repeated"), "id").where("row <> best.row").select("row")
    rows = rows.join(stored(losers, "negatives-losers"), "row", "left_anti")

    total, width, square = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max("square")).first()
    width, norm = width or 1, math.sqrt(square or 0.0) * (1 + 1e-12)
    size = max(LEAF, TILE // width)
    sample = rows.orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(min(SAMPLE, 8 * size)).select("vector").toArrow()
    centres = _cells(sample, width, norm, min(MOST_CELLS, math.ceil(total / size)))
    session = df.sparkSession.sparkContext
    shared = session.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x = _augmented(_matrix(batch.column(2), width), norm)
            away = np.stack([_distances(x, c) for c in shared.value], 1) if len(x) else np.zeros((0, 1))
            cell = away.argmin(1) if len(x) else np.zeros(0, np.int64)
            near = away[np.arange(len(x)), cell]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(near)], ["id", "label", "vector", "anchor", "cell", "away"])

    placed = rows.select("id", "label", "vector", "anchor").mapInArrow(assign, "id long, label long, vector array<long>, anchor boolean, cell int, away double")
    placed = stored(placed, "negatives-placed")
    # At most 256 rows, one for each cell.
    cells = {r.cell: (r.slices, r.radius) for r in placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("slices"), F.max("away").alias("radius")).collect()}
    count = placed.where("anchor").count()
    batches_of_anchors = max(1, math.ceil(count / size))
    slices = F.create_map(*[F.lit(v) for c, (n, _) in cells.items() for v in (c, n)]) if cells else F.create_map(F.lit(0), F.lit(1))
    candidates = placed.withColumn("slice", F.pmod(F.xxhash64("id"), slices[F.col("cell")]).cast("int"))
    candidates = candidates.select("cell", "slice", F.explode(F.sequence(F.lit(0), F.lit(batches_of_anchors - 1))).alias("batch"), "id", "label", "vector")

    def routed(anchors: DataFrame) -> DataFrame:
        """An anchor's row for each slice of the cells that its windows reach."""

        def reach(batches: Iterator[pa.RecordBatch]):
            order = sorted(cells)
            centre, radius = shared.value[order], np.array([cells[c][1] for c in order])
            for batch in batches:
                q = _matrix(batch.column(2), width)
                low, high = (np.array([[min(v), max(v)] for v in batch.column(i).to_pylist()]).reshape(-1, 2) for i in (3, 4))
                score = q @ centre[:, :-1].T
                by = np.sqrt((q * q).sum(1))[:, None] * radius[None, :] + _slack(q, norm)[:, None]
                meets = (score + by >= low[:, :1]) & (score - by <= high[:, 1:])
                at, which = np.nonzero(meets)
                chosen = pa.Table.from_batches([batch]).take(pa.array(at)).append_column("cell", pa.array(np.array(order, np.int32)[which]))
                yield from chosen.to_batches()

        columns = "id long, label long, vector array<long>, low array<long>, high array<long>"
        met = anchors.select("id", "label", "vector", "low", "high").mapInArrow(reach, f"{columns}, cell int")
        met = met.withColumn("slice", F.explode(F.sequence(F.lit(0), slices[F.col("cell")] - 1)))
        return met.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches_of_anchors)).cast("int"))

    def searched(anchors: DataFrame, alike: bool, keep: int) -> DataFrame:
        tile = ["cell", "slice", "batch"]
        met = candidates.groupBy(*tile).cogroup(routed(anchors).groupBy(*tile)).applyInArrow(_tile(norm, width, alike, keep), "anchor_id long, window int, id long, score long")
        best = W.partitionBy("anchor_id", "window").orderBy(F.col("score").desc(), "id")
        return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)

    all_scores = [F.array(F.lit(s)).alias(n) for n, s in (("low", LOWEST), ("high", HIGHEST))]
    anchors = placed.where("anchor").select("id", "label", "vector")
    near = stored(searched(anchors.select("*", *all_scores), True, positives), "negatives-positives")
    held = F.array_sort(F.collect_list(F.struct("rank", F.col("id").alias("positive_id"), "score")))
    chosen = stored(near.groupBy(F.col("anchor_id").alias("id")).agg(held.alias("p")), "negatives-chosen")

    def floor(share: int, sign: int) -> Column:
        """sign * floor(sign * share * score / 100) of each positive."""

        def edge(s: Column) -> Column:
            whole = s * (sign * share)
            return ((whole - F.pmod(whole, F.lit(100))) / 100).cast("long") * sign

        return F.transform("p.score", edge)

    windows = anchors.join(chosen.hint("merge"), "id").select("id", "label", "vector", floor(least, -1).alias("low"), floor(most, 1).alias("high"))
    found = stored(searched(windows, False, negatives), "negatives-found")
    picked = chosen.select(F.col("id").alias("anchor_id"), F.posexplode("p").alias("window", "p"))
    out = found.join(picked.hint("merge"), ["anchor_id", "window"])
    return out.select("anchor_id", "p.positive_id", "rank", F.col("id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))

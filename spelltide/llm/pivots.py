"""Near-duplicate vectors through a pivot-permutation index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spelltide.llm.graph import components
from spelltide.llm.scratch import stored

COSINE = 0.9
#: Pivots per square root of the number of distinct vectors, and at most.
PIVOT_FACTOR, MOST_PIVOTS = 4.0, 65_536
#: Nearest pivots that describe a vector, and how many of them two vectors must share to be compared.
NEAREST, SHARED = 12, 3
#: Pivots closer than this to another one are left out.
APART = 0.7
#: Vectors of a pivot's list that are compared by one task; longer lists are cut into pairs of slices.
SLICE = 2_048


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, scaled by their largest component and filled up with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out / np.abs(out).max(1, keepdims=True, initial=1e-300)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _apart(x: np.ndarray) -> np.ndarray:
    """The unit vectors that are not close to an earlier one that stays. Pivots within a dense group would
    describe its members by their noise."""
    keep = np.zeros((0, x.shape[1]))
    for low in range(0, len(x), 256):
        part = x[low : low + 256]
        part = part[(part @ keep.T < APART).all(1)]
        near = np.triu(part @ part.T >= APART, 1)
        alone = np.ones(len(part), bool)
        for i in range(len(part)):
            if alone[i]:
                alone &= ~near[i]
        keep = np.concatenate([keep, part[alone]])
    return keep


def _canonical(order: np.ndarray, a: np.ndarray, b: np.ndarray, pivot: int) -> np.ndarray:
    """Whether the list's pivot is the rarest one that the pair shares, which has the smallest number."""
    out = np.zeros(len(a), bool)
    for low in range(0, len(a), 65_536):
        one, two = order[a[low : low + 65_536]], order[b[low : low + 65_536]]
        shared = (one[:, :, None] == two[:, None, :]).any(2)
        out[low : low + 65_536] = np.where(shared, one, np.iinfo(np.int32).max).min(1) == pivot
    return out


def _compare(table: pa.Table) -> pa.Table:
    """Links among the vectors of a list, or between two slices of it.

    Pairs that share enough pivots are verified. A pair may meet in several lists and counts in that of
    the rarest pivot it shares. Returns per vector the weight of its links, and edges that connect
    what is linked: two rows per vector at most.
    """
    pivot, node, copies, piece, size = (table[c].to_numpy() for c in ("pivot", "node", "copies", "slice", "dims"))
    order = np.array(table["nearest"].to_pylist(), np.int32).reshape(len(node), -1)
    x = _matrix(table["embedding"].combine_chunks(), int(size.max()))
    norm = np.sqrt((x * x).sum(1))
    n, split = len(node), len(np.unique(piece)) > 1
    words, local = np.unique(order, return_inverse=True)
    marks = np.zeros((n, len(words)), np.float32)
    marks[np.arange(n)[:, None], local.reshape(order.shape)] = 1
    weight, root = np.zeros(n, np.int64), np.arange(n)
    for low in range(0, n, 512):
        high = min(n, low + 512)
        met = marks[low:high] @ marks.T >= min(SHARED, order.shape[1])
        met &= np.arange(n)[None, :] > np.arange(low, high)[:, None]
        met &= size[low:high, None] == size[None, :]
        met &= node[low:high, None] != node[None, :]
        if split:
            met &= piece[low:high, None] != piece[None, :]
        a, b = np.nonzero(met)
        a += low
        for part in range(0, len(a), 1 << 18):
            one, two = a[part : part + (1 << 18)], b[part : part + (1 << 18)]
            near = np.einsum("ij,ij->i", x[one], x[two]) >= COSINE * (norm[one] * norm[two])
            one, two = one[near], two[near]
            counts = _canonical(order, one, two, int(pivot[0]))
            one, two = one[counts], two[counts]
            np.add.at(weight, one, copies[two])
            np.add.at(weight, two, copies[one])
            while len(one):
                least = np.minimum(root[one], root[two])
                before = root.copy()
                np.minimum.at(root, root[one], least)
                np.minimum.at(root, root[two], least)
                root = root[root]
                if np.array_equal(root, before):
                    break
    linked = np.flatnonzero(weight)
    return pa.table({"node": node[linked], "weight": weight[linked], "other": node[root[linked]]})


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Two vectors of equal length link at a cosine of 0.9 or more, in double precision. n_links counts the
    other rows linked directly, component_id is the smallest key reachable by links, kept marks the row
    that has it. Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing. Rows with a null key link with nothing and have a null component. Rows that repeat a key are
    one vector with several embeddings. An empty table gives no rows.

    Equal vectors are one node with a number of copies. Each node is described by its 12 nearest pivots,
    in order; pivots are 4 * sqrt(nodes) nodes, 65 536 at most, those whose keys have the smallest
    hashes, without those at a cosine of 0.7 or more to another. Nodes that share 3 pivots (all, if there are
    fewer) are verified, so the result holds no wrong link and misses those whose surroundings share fewer. Of 12 pivots in
    the order of their frequency, the first 3 shared ones begin among the first 10, so a node is posted in the lists of its 10
    rarest alone, and the longest lists stay short. A list is compared in slices of 2 048; what leaves a
    task are sums and a spanning forest, not pairs.
    """
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"), F.coalesce(good, F.lit(False)).alias("_good"))
    usable = rows.where("_good and vec_id is not null")
    nodes = stored(
        usable.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")).withColumn("dims", F.size("embedding")),
        "vectors",
    )
    total, width = nodes.agg(F.count(F.lit(1)), F.max("dims")).first()
    pivots = min(MOST_PIVOTS, math.ceil(PIVOT_FACTOR * math.sqrt(total)))
    chosen = nodes.orderBy(F.xxhash64(F.lit(3), "node"), "node").limit(pivots).select("embedding").toArrow()["embedding"]
    centres = _apart(_unit(_matrix(chosen.combine_chunks(), width))) if total else np.zeros((0, 1))
    shared = df.sparkSession.sparkContext.broadcast(centres)

    def describe(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for low in range(0, batch.num_rows, 1_024):
                part = batch.slice(low, 1_024)
                x = _unit(_matrix(part.column(0), shared.value.shape[1]))
                count = min(NEAREST, len(shared.value))
                near = -(x @ shared.value.T)
                some = np.argpartition(near, count - 1, axis=1)[:, :count]
                order = np.take_along_axis(some, np.argsort(np.take_along_axis(near, some, 1), 1, kind="stable"), 1)
                flat = pa.array(order.astype(np.int32).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * count), flat)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], ["embedding", "node", "copies", "dims", "nearest"])

    kind = dict(nodes.dtypes)["embedding"]
    described = nodes.mapInArrow(describe, f"embedding {kind}, node long, copies long, dims int, nearest array<int>")
    described = stored(described, "vectors-described")
    # At most 65 536 rows, one for each pivot. From here on a pivot goes by its rank, the rarest first.
    lengths = described.select(F.explode("nearest").alias("pivot")).groupBy("pivot").agg(F.count(F.lit(1)).alias("size")).toArrow()
    length = np.zeros(len(centres), np.int64)
    length[lengths["pivot"].to_numpy()] = lengths["size"].to_numpy()
    ranked = np.argsort(length, kind="stable")
    rank = np.empty(len(centres), np.int32)
    rank[ranked] = np.arange(len(centres))
    ranks = df.sparkSession.sparkContext.broadcast((rank, length[ranked]))

    def post(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rank, size = ranks.value
            nearest = batch.column(4)
            order = np.sort(rank[nearest.flatten().to_numpy()].reshape(batch.num_rows, -1), 1)
            held = order[:, : order.shape[1] - min(SHARED, order.shape[1]) + 1]
            row, at = np.nonzero(size[held] > 1)
            out = batch.take(pa.array(row))
            sorted_ = pa.FixedSizeListArray.from_arrays(pa.array(order[row].ravel()), order.shape[1]).cast(pa.list_(pa.int32()))
            pivot = held[row, at]
            slices = -(-size[pivot] // SLICE)
            yield pa.RecordBatch.from_arrays([*out.columns[:4], sorted_, pa.array(pivot), pa.array(slices.astype(np.int32))], [*out.schema.names[:5], "pivot", "slices"])

    lists = described.mapInArrow(post, f"embedding {kind}, node long, copies long, dims int, nearest array<int>, pivot int, slices int") if total else described.withColumns({"pivot": F.lit(0), "slices": F.lit(1)})
    lists = lists.withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    lists = lists.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    lists = lists.withColumns({"i": F.least("slice", "other"), "j": F.greatest("slice", "other")})
    lists = lists.select("pivot", "i", "j", "slice", "node", "copies", "dims", "nearest", "embedding")
    found = stored(lists.groupBy("pivot", "i", "j").applyInArrow(_compare, "node long, weight long, other long"), "vector-links")

    links = found.groupBy("node").agg(F.sum("weight").alias("weight"))
    member = rows.where("_good").join(nodes.hint("merge"), "embedding").select("vec_id", "node", "copies")
    member = stored(member.unionAll(rows.where("not _good").select("vec_id", F.col("vec_id").alias("node"), F.lit(1).cast("long"))), "vector-members")
    member = member.withColumn("node", F.when(F.col("vec_id").isNotNull(), F.col("node")))
    repeats = member.groupBy("vec_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    repeats = member.join(stored(repeats, "vector-repeats").hint("merge"), "vec_id").select(F.col("node").alias("a"), F.col("low").alias("b"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")).unionAll(repeats))
    known = stored(links.join(roots, "node", "full").select("node", "weight", "root"), "vector-known")
    out = member.join(known.hint("merge"), "node", "left")
    own = F.when(F.col("node").isNull(), 0).otherwise(F.coalesce("weight", F.lit(0)) + F.col("copies") - 1)
    part = F.coalesce("root", "node")
    return out.select(
        F.col("vec_id").alias(key), own.cast("long").alias("n_links"), part.alias("component_id"),
        F.coalesce(F.col("vec_id") == part, F.lit(False)).alias("kept"),
    )

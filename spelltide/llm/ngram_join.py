"""Documents whose word shingles overlap: a join on group counts of shingles, verified on whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spelltide.llm.graph import components
from spelltide.llm.scratch import stored
from spelltide.llm.words import mix, pieces, word_hashes

WORDS = 5
#: Least Jaccard similarity of two linked documents, in hundredths.
PERCENT = 75
GROUPS = 256
#: Smallest shingle hashes of a set by which documents meet, and the part of them that two linked sets share.
BOTTOM, SHARED = 64, 0.3
#: Documents of a block that are compared by one task; larger blocks are cut into pairs of slices.
SLICE = 2_048
#: Rows of blocks that share a tree.
GROUP_ROWS = 4_096
#: Hash values by which texts are sorted out before they are shuffled.
SIEVE = 1 << 20
LEAF, FANOUT = 16, 8
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their rows, by row and hash. A text of fewer words is one shingle."""
    word, row = word_hashes(data, offsets)
    count = np.bincount(row, minlength=len(offsets) - 1)
    start = np.flatnonzero(row[: -(WORDS - 1)] == row[WORDS - 1 :]) if len(word) >= WORDS else np.zeros(0, np.int64)
    total = np.zeros(len(start), np.uint64)
    for i in range(WORDS):
        total = total * _ODD + word[start + i]
    hashed, owner = [mix(total)], [row[start]]
    first = np.cumsum(count) - count
    for size in range(1, WORDS):
        short = np.flatnonzero(count == size)
        total = np.full(len(short), size, np.uint64)
        for i in range(size):
            total = total * _ODD + word[first[short] + i]
        hashed.append(mix(total + np.uint64(1)))
        owner.append(short)
    hashed, owner = np.concatenate(hashed), np.concatenate(owner)
    order = np.argsort(hashed)
    kind = np.uint16 if len(count) < 1 << 16 else np.int64
    order = order[np.argsort(owner[order].astype(kind), kind="stable")]
    hashed, owner = hashed[order], owner[order]
    new = np.append(True, (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1]))[: len(hashed)]
    return hashed[new], owner[new]


def _lists(values: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(values.view(np.int64)))


def signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: doc_id, n_shingles, two hashes of the whole set, its smallest hashes, and its count vector (256 uint32)."""

    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(1)):
                rows = high - low
                hashed, owner = shingles(data, offsets)
                size = np.bincount(owner, minlength=rows)
                ends = np.concatenate([[0], np.cumsum(size)])
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(hashed ^ np.uint64(salt)))]) for salt in (1, 2)]
                counts = np.bincount(owner * GROUPS + (hashed & np.uint64(GROUPS - 1)).astype(np.int64), minlength=rows * GROUPS)
                vectors = counts.astype(np.uint32).reshape(rows, GROUPS)
                small = np.arange(len(hashed)) - ends[owner] < BOTTOM
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(low, rows), "n_shingles": pa.array(size, pa.int64()),
                    "k1": (sums[0][ends[1:]] - sums[0][ends[:-1]]).view(np.int64),
                    "k2": (sums[1][ends[1:]] - sums[1][ends[:-1]]).view(np.int64),
                    "bottom": _lists(hashed[small], np.minimum(size, BOTTOM)),
                    "vector": pa.array([v.tobytes() for v in vectors], pa.binary()),
                })

    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(build, "doc_id long, n_shingles long, k1 long, k2 long, bottom array<long>, vector binary")


def _sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """Whole shingle sets of the rows."""

    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(1)):
                hashed, owner = shingles(data, offsets)
                size = np.bincount(owner, minlength=high - low)
                yield pa.RecordBatch.from_pydict({"node": batch.column(0).slice(low, high - low), "shingles": _lists(hashed, size)})

    rows = df.select(F.col(key).cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(build, "node long, shingles array<long>")


def least_overlap(a, b):
    """The smallest intersection of sets of sizes a and b that links them."""
    return -(-(PERCENT * (a + b)) // (100 + PERCENT))


class CountTree:
    """An R-tree over count vectors of the sets of many blocks, packed by block and set size.

    A node keeps its largest count per group and its ranges of sizes and blocks. The intersection of two
    sets is at most the sum over groups of the smaller count, so a node whose largest counts give too
    little for its smallest size holds no partner, and none where its blocks leave out that of the set.
    """

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, block: np.ndarray | None = None):
        block = np.zeros(len(sizes), np.int64) if block is None else block
        self.order = np.lexsort((*vectors.T[:4], sizes, block))
        self.vectors, self.sizes, self.block = vectors[self.order], sizes[self.order], block[self.order]
        self.levels = []
        high, low, top, first, last = self.vectors, self.sizes, self.sizes, self.block, self.block
        width = LEAF
        while len(high) > 1:
            cut = np.arange(0, len(high), width)
            high = np.maximum.reduceat(high, cut)
            low, first = (np.minimum.reduceat(x, cut) for x in (low, first))
            top, last = (np.maximum.reduceat(x, cut) for x in (top, last))
            self.levels.append((width, (high, low, top, first, last)))
            width = FANOUT

    def _fits(self, query: np.ndarray, node: np.ndarray, level: tuple[np.ndarray, ...]) -> np.ndarray:
        high, low, top, first, last = level
        size, low, top, block = self.sizes[query], low[node], top[node], self.block[query]
        fits = (100 * top >= PERCENT * size) & (PERCENT * low <= 100 * size) & (first[node] <= block) & (block <= last[node])
        at = np.flatnonzero(fits)
        for part in np.array_split(at, -(-len(at) // 4_096) or 1):
            bound = np.minimum(self.vectors[query[part]], high[node[part]]).sum(1, dtype=np.int64)
            least = np.maximum(low[part], -(-PERCENT * size[part] // 100))
            fits[part] = bound >= least_overlap(size[part], least)
        return fits

    def pairs(self, wanted=None, queries: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all pairs of a block, each once, whose bound allows a link and that `wanted` says yes to.

        With `queries`, of all pairs that begin with one of these positions.
        """
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        asked = np.arange(len(self.order)) if queries is None else np.sort(place[queries])
        points = (self.vectors, self.sizes, self.sizes, self.block, self.block)
        steps = [(level, width) for width, level in reversed(self.levels)]
        out = []
        for low in range(0, len(asked), 256):
            query = asked[low : low + 256]
            node = np.zeros(len(query), np.int64)
            for i, (level, width) in enumerate(steps):
                fits = self._fits(query, node, level)
                query, node = query[fits], node[fits]
                length = len(steps[i + 1][0][1]) if i + 1 < len(steps) else len(self.order)
                query = np.repeat(query, width)
                node = (node[:, None] * width + np.arange(width)).ravel()
                query, node = query[node < length], node[node < length]
            other = query != node if queries is not None else query < node
            query, node = query[other], node[other]
            if wanted is not None:
                fits = wanted(self.order[query], self.order[node])
                query, node = query[fits], node[fits]
            fits = self._fits(query, node, points)
            out.append((self.order[query[fits]], self.order[node[fits]]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2


def _token_rows(lists: pa.ListArray) -> np.ndarray:
    """The nodes' shared tokens as small numbers, rarest first, each row filled up with -1."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out = np.full((len(size), BOTTOM), -1, np.int32)
    out[row, place] = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return out


def _block_pairs(group: pa.Table) -> pa.Table:
    """Pairs of the group's blocks that could be linked and are neither of one component nor compared already.

    One R-tree holds the points of all blocks of the group, and every pair comes out of it. It must also share as many
    of its smallest hashes as linked sets do. A pair may meet in many blocks and counts in that of the
    first token that both have: it lies before all others that they share, so neither has left it out.
    """
    group = group.sort_by([(c, "ascending") for c in ("token", "i", "j")]).combine_chunks()
    token, i, j, node, part, slice_, pivot, size, of, slices = (
        group[c].to_numpy() for c in ("token", "i", "j", "node", "component", "slice", "pivot", "n_shingles", "of", "slices")
    )
    vectors = np.frombuffer(b"".join(group["vector"].to_pylist()), np.uint32).reshape(len(node), GROUPS)
    lists = group["tokens"].chunk(0)
    tokens, least = _token_rows(lists), np.ceil(of * SHARED).astype(np.int64)
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    spot = np.flatnonzero(flat == np.repeat(token, np.diff(np.append(0, ends))))
    own = tokens[np.arange(len(node)), spot - np.append(0, ends[:-1])]
    changes = (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    block = np.append(0, np.cumsum(changes))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def wanted(a, b):
        fits = (part[a] != part[b]) & (node[a] != pivot[a]) & (node[b] != pivot[b])
        return fits & ((slices[a] == 1) | (slice_[a] != slice_[b]) | (i[a] == j[a]))

    one, two = CountTree(vectors, size, block).pairs(wanted)
    for low in range(0, len(one), 4_096):
        a, b = one[low : low + 4_096], two[low : low + 4_096]
        common = (tokens[a][:, :, None] == tokens[b][:, None, :]).any(2) & (tokens[a] >= 0)
        enough = common.sum(1) >= np.maximum(least[a], least[b])
        here = enough & (tokens[a, common.argmax(1)] == own[a])
        found.append((node[a[here]], node[b[here]]))
    a, b = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _pivot_pairs(group: pa.Table) -> pa.Table:
    """Pairs of a node and its block's pivot that the tree over the group's points allows."""
    pivot, slice_, node, asks, size = (group[c].to_numpy() for c in ("pivot", "slice", "node", "asks", "n_shingles"))
    vectors = np.frombuffer(b"".join(group["vector"].to_pylist()), np.uint32).reshape(len(node), GROUPS)
    block = np.unique(np.stack([pivot, slice_], 1), axis=0, return_inverse=True)[1].ravel()
    a, b = CountTree(vectors, size, block).pairs(lambda a, b: ~asks[b], np.flatnonzero(asks))
    pairs = np.unique(np.stack([node[b], node[a]], 1), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _starred(stars: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of a node and a pivot whose sizes and count vectors allow a link.

    The nodes that meet a pivot are its block; blocks are cut into slices, each with a copy of the pivot,
    and slices share trees, which the pivots' points are searched in. So no pivot gathers its block in one task.
    """
    wide = nodes.select("node", "n_shingles", "vector")
    sizes = stored(stars.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"), F.count(F.lit(1)).alias("n")), "shingle-blocks")
    rows = sizes.agg(F.sum(F.col("n") + F.col("slices"))).first()[0] or 0
    held = stars.join(sizes.select("b", "slices").hint("merge"), "b").withColumn("slice", F.pmod(F.xxhash64("a"), F.col("slices")).cast("int"))
    held = held.select(F.col("b").alias("pivot"), "slice", F.col("a").alias("node"), F.lit(False).alias("asks"))
    pivots = sizes.select(F.col("b").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.col("b").alias("node"), F.lit(True).alias("asks"))
    met = held.unionAll(pivots).join(wide.hint("merge"), "node")
    dealt = F.pmod(F.xxhash64("pivot", "slice"), F.lit(-(-rows // GROUP_ROWS) or 1)).alias("group")
    return met.select(dealt, *met.columns).groupBy("group").applyInArrow(_pivot_pairs, "a long, b long").distinct()


def _verified(pairs: DataFrame, df: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs whose whole sets are similar enough.

    Only texts whose id hashes to a value that occurs among the pairs are turned into sets and shuffled;
    those values are at most 2^20, which bounds the broadcast.
    """
    ids = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    sieve = lambda c: F.pmod(F.xxhash64(c), F.lit(SIEVE))
    wanted = ids.select(sieve(F.col("node")).alias("_sieve")).distinct()
    texts = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
    texts = texts.withColumn("_sieve", sieve(F.col("node"))).join(F.broadcast(wanted), "_sieve", "left_semi")
    sets = _sets(texts, "node", "text").join(ids.distinct().hint("merge"), "node", "left_semi")
    sets = stored(sets, "shingle-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("one")).hint("merge"), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("two")).hint("merge"), "b")
    common = F.size(F.array_intersect("one", "two"))
    similar = 100 * common >= PERCENT * (F.size("one") + F.size("two") - common)
    return both.where(similar).select("a", "b").distinct()


def link_documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Words are runs other than white space (0x20, 0x09-0x0D), A-Z lower-cased. A set holds the distinct
    5-word shingles of the whole text, or its whole word sequence if shorter. Two documents link when
    their sets have a Jaccard similarity of 0.75 or more; the component is the smallest id reachable.
    Null and empty texts have no shingles and link with nothing. Rows with a null id have their number of
    shingles and a null component, and link with nothing. Rows that repeat an id are one document with
    several texts. An empty table gives no rows.

    1. Equal sets are one node from here on, so copies cost nothing more.
    2. Nodes meet in blocks, one for each of their 64 smallest shingle hashes. Of linked sets, each of the
       64 smallest hashes of the union is in both with a probability of at least 0.75, so they share 30 %
       of them but for a chance of about 3e-13. Hence each node leaves out the 30 % that are most
       frequent in the corpus, and passages that many documents share hardly make blocks.
    3. An R-tree over the count vectors of many blocks, the block being one more coordinate, is searched
       with each block's smallest node; what it allows is verified, which joins most copies without all pairs.
    4. For blocks that still hold several components, a second such tree joined with itself gives the other
       pairs across components. Blocks are cut into slices of 2 048 nodes that meet pairwise.
    5. The survivors are verified on their whole sets, and the components built from all links.
    """
    signed = stored(signatures(df, key, text), "shingle-signatures")
    real = signed.where("doc_id is not null and n_shingles > 0")
    same = ["k1", "k2", "n_shingles"]
    nodes = stored(
        real.groupBy(*same).agg(F.min(F.struct(F.col("doc_id").alias("node"), "bottom", "vector")).alias("_first")).select(*same, "_first.*"),
        "shingle-nodes",
    )
    # A document that repeats its id may be a node with several sets, which k1 tells apart.
    postings = nodes.select("node", "k1", F.explode("bottom").alias("token"), F.size("bottom").alias("of"))
    frequent = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(frequent, "shingle-tokens")
    met = postings.join(shared.hint("merge"), "token").groupBy("node", "k1", "of").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("list"))
    # A token that occurs once stands before all others, so the list's last ones are the most frequent.
    kept = F.greatest(F.lit(0), F.size("list") - (F.ceil(F.col("of") * SHARED).cast("int") - 1))
    lists = stored(met.select("node", "k1", "of", F.col("list.token").alias("tokens"), kept.alias("kept")), "shingle-lists")
    blocks = lists.select("node", "k1", F.explode(F.slice("tokens", F.lit(1), F.col("kept"))).alias("token"))
    small = stored(blocks.groupBy("token").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1"), "shingle-pivots")
    stars = blocks.join(small.select("token", "pivot").hint("merge"), "token").where("node <> pivot")
    stars = stored(stars.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), "shingle-stars")
    links = stored(_verified(stored(_starred(stars, nodes), "shingle-pairs"), df, key, text), "shingle-links")

    first = components(links)
    placed = blocks.join(first.hint("merge"), blocks["node"] == first["node"], "left")
    placed = stored(placed.select("token", blocks["node"], "k1", F.coalesce("root", blocks["node"]).alias("component")), "shingle-placed")
    mixed = placed.groupBy("token").agg(
        F.min("node").alias("pivot"), F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = stored(mixed.where("size > 2 and low <> high").select("token", "pivot", "size"), "shingle-mixed")
    slices = F.ceil(F.col("size") / SLICE).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    met = placed.join(mixed.hint("merge"), "token").withColumn("slices", slices).withColumn("slice", own)
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    met = met.withColumn("other", other).withColumn("i", F.least("slice", "other")).withColumn("j", F.greatest("slice", "other"))
    met = met.join(nodes.select("node", "k1", "n_shingles", "vector").hint("merge"), ["node", "k1"])
    met = met.join(lists.select("node", "k1", "of", "tokens").hint("merge"), ["node", "k1"])
    rows = mixed.agg(F.sum(F.col("size") * slices)).first()[0] or 0
    dealt = F.pmod(F.xxhash64("token", "i", "j"), F.lit(-(-rows // GROUP_ROWS) or 1)).alias("group")
    found = met.select(dealt, "token", "i", "j", "node", "component", "slice", "slices", "pivot", "n_shingles", "vector", "of", "tokens")
    pairs = found.groupBy("group").applyInArrow(_block_pairs, "a long, b long").distinct()
    more = stored(_verified(stored(pairs, "shingle-pairs"), df, key, text), "shingle-links")

    member = signed.select("doc_id", *same).join(nodes.select(*same, "node").hint("merge"), same, "left")
    member = member.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")).alias("node"))
    member = stored(member, "shingle-members")
    least = stored(member.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high"), "shingle-repeats")
    repeats = member.join(least.hint("merge"), "doc_id").select(F.col("node").alias("a"), F.col("low").alias("b"))
    known = first.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(known.unionAll(more).unionAll(repeats))
    placed = member.join(roots.hint("merge"), "node", "left")
    return placed.select(F.col("doc_id").alias(key), "n_shingles", F.coalesce("root", "node").alias("component_id"))

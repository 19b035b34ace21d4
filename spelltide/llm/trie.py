"""Prefix trie of conversations, with subtree totals by a roll-up over bands of depths."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spelltide.llm.scratch import stored

#: Depths in a band. A node explodes to no more than this many ancestors.
BAND = 8
#: Turns of a conversation that one window numbers or folds.
BLOCK = 1_024
#: Conversation ids in a chunk of a node's list.
CHUNK = 2_048


def turn_keys(df: DataFrame, conv: str, order: str, role: str, text: str) -> DataFrame:
    """(conv, pos, a, b, size) of every turn: its place from 1, two 64-bit hashes of role and text, the text's UTF-8 bytes.

    Turns are ordered by `order`, nulls first; turns that tie are taken in the order of their hashes. Null
    role or text becomes empty. Rows without a conversation are left out. Other columns are dropped. An empty
    table gives no rows.

    The texts are read once and not shuffled. Turns are ranked within ranges of (conv, order) and shifted
    by the turns of the ranges before, so a conversation with most of the rows is ranked by many tasks.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(order).alias("ord"),
        F.xxhash64(F.lit(1), *said).alias("a"),
        F.xxhash64(F.lit(2), *said).alias("b"),
        F.octet_length(said[1]).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    place = ["ord", "a", "b", "row"]
    rows = stored(rows, "trie-turns").repartitionByRange("conv", *[F.asc_nulls_first(c) for c in place])
    rows = stored(rows.withColumn("part", F.spark_partition_id()), "trie-ranges")
    counts = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = stored(counts.select("conv", "part", F.coalesce(before, F.lit(0)).alias("start")).where("start > 0"), "trie-starts")
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy("conv", "part").orderBy(*[F.asc_nulls_first(c) for c in place])))
    pos = (F.col("rank") + F.coalesce("start", F.lit(0))).cast("long")
    return ranked.join(starts, ["conv", "part"], "left").select("conv", pos.alias("pos"), "a", "b", "size")


def _prefixes(keys: DataFrame) -> DataFrame:
    """(conv, pos, x, y, size): two 64-bit digests of the first `pos` turns of a conversation.

    A digest is the exclusive or of hashes of each turn together with its place, so it can be folded over
    blocks of a conversation apart: first in blocks, then over the blocks before.
    """
    tagged = keys.select(
        "conv", "pos", F.xxhash64(F.lit(3), "pos", "a").alias("x"), F.xxhash64(F.lit(4), "pos", "b").alias("y"), "size", F.expr(f"(pos - 1) div {BLOCK}").alias("block")
    )
    inside = W.partitionBy("conv", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    folded = tagged.withColumns({"x": F.bit_xor("x").over(inside), "y": F.bit_xor("y").over(inside)})
    last = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = tagged.groupBy("conv", "block").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    earlier = blocks.select("conv", "block", F.bit_xor("bx").over(last).alias("bx"), F.bit_xor("by").over(last).alias("by")).where("block > 0")
    both = folded.join(stored(earlier, "trie-blocks"), ["conv", "block"], "left")
    zero = F.lit(0).cast("long")
    return both.select("conv", "pos", F.col("x").bitwiseXOR(F.coalesce("bx", zero)).alias("x"), F.col("y").bitwiseXOR(F.coalesce("by", zero)).alias("y"), "size")


def _lists(batches: Iterator[pa.RecordBatch]):
    """Chunks of ids from rows sorted by (rep, depth, conv): (rep, depth, first, ids)."""
    key, first, ids, found = None, 0, [], []

    def close():
        if ids:
            found.append({"rep": key[0], "depth": key[1], "first": first, "ids": ",".join(ids)})

    for batch in batches:
        for rep, depth, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if key != (rep, depth) or len(ids) >= CHUNK:
                close()
                key, first, ids = (rep, depth), conv, []
            ids.append(str(conv))
        yield pa.RecordBatch.from_pylist(found, _CHUNKS)
        found.clear()
    close()
    yield pa.RecordBatch.from_pylist(found, _CHUNKS)


_CHUNKS = pa.schema([("rep", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_HASHES = pa.schema([("rep", pa.int64()), ("depth", pa.int64()), ("sha", pa.string())])


def _hashes(batches: Iterator[pa.RecordBatch]):
    """The hash of each node's chunks, which follow one another."""
    key, state, found = None, None, []
    for batch in batches:
        for rep, depth, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if key == (rep, depth):
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                found.append({"rep": key[0], "depth": key[1], "sha": state.hexdigest()})
            key, state = (rep, depth), hashlib.sha256(ids.encode())
        if found:
            yield pa.RecordBatch.from_pylist(found, _HASHES)
            found = []
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"rep": key[0], "depth": key[1], "sha": state.hexdigest()}], _HASHES)


def id_hashes(ends: DataFrame) -> DataFrame:
    """(rep, depth, sha) of rows (rep, depth, conv): SHA-256 of each group's ids, ascending, comma-joined.

    A hash runs over its list in order, whatever its length, so what can be shared out is the list: ranges of
    (rep, depth, conv) become chunks of 2 048 ids, and only these chunks meet in the group's task, which
    reads them one by one and keeps nothing but the state of the hash.
    """
    columns = ["rep", "depth", "conv"]
    chunks = ends.select(*columns).repartitionByRange(*columns).sortWithinPartitions(*columns).mapInArrow(_lists, "rep long, depth long, first long, ids string")
    chunks = stored(chunks, "trie-chunks")
    placed = chunks.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first").select("rep", "depth", "ids")
    return placed.mapInArrow(_hashes, "rep long, depth long, sha string")


def _sums(columns: list[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def band_totals(paths: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """(rep, pos, values): for each node the sums of the values over its subtree.

    `paths` has a row (conv, pos, rep, values) for every node on a conversation's way from the root, pos 0;
    a node is (rep, pos), where rep is one conversation through it, the same in all rows of the node. Values, longs, stand in the rows where
    rep is conv, and are 0 elsewhere.

    Depths are cut into bands of `band`. Within a band each node adds to its ancestors there: the rows of a
    conversation in a band, `band` at most, are one group, and leave it as one sum per row. Then the band roots are a trie
    of their own, whose totals are found in the same way, and the complete total of a band root is added to the
    nodes of the band above it. So there are as many rounds as the depth has digits to the base `band`,
    and no step has more rows than there are path rows.
    """
    own = F.col("rep") == F.col("conv")
    held = F.sort_array(F.collect_list(F.struct("pos", "rep", *values)))
    groups = paths.groupBy("conv", F.expr(f"pos div {band}").alias("band")).agg(held.alias("way"))
    groups = stored(groups, "trie-bands")

    def below(i: Column) -> Column:
        """Sums over the ways' entries from the i-th on, as a struct of the values."""
        rest = F.slice("way", i + 1, F.size("way"))

        def added(name: str) -> Column:
            return F.aggregate(rest, F.lit(0).cast("long"), lambda a, x: a + x[name])

        return F.struct(*[added(v).alias(v) for v in values])

    def step(x: Column, i: Column) -> Column:
        total = below(i)
        return F.struct(x["rep"].alias("rep"), x["pos"].alias("pos"), *[total[v].alias(v) for v in values])

    spread = groups.select(F.inline(F.transform("way", step))).where(" or ".join(f"{v} <> 0" for v in values))
    inside = stored(spread.groupBy("rep", "pos").agg(*_sums(values)), "trie-inside")
    if groups.agg(F.max("band")).first()[0] in (None, 0):
        return inside

    tops = paths.where(F.col("pos") % band == 0).select("conv", "pos", "rep")
    owned = tops.where(own).join(inside.hint("merge"), ["rep", "pos"], "left").select("conv", "pos", "rep", *[F.coalesce(v, F.lit(0).cast("long")).alias(v) for v in values])
    others = tops.where(~own).select("conv", "pos", "rep", *[F.lit(0).cast("long").alias(v) for v in values])
    up = stored(owned.unionAll(others).withColumn("pos", F.expr(f"pos div {band}")), "trie-tops")
    complete = band_totals(up, values, band).withColumn("pos", F.col("pos") * band)
    complete = stored(complete, "trie-complete")

    handed = complete.where("pos > 0").select(F.col("rep").alias("conv"), F.expr(f"pos div {band} - 1").alias("band"), F.struct(*values).alias("total"))
    ways = groups.select("conv", "band", F.transform(F.slice("way", 2, band), lambda x: F.struct(x["pos"].alias("pos"), x["rep"].alias("rep"))).alias("way"))
    met = ways.join(handed.hint("merge"), ["conv", "band"]).select("total.*", F.inline("way"))
    deeper = met.select("rep", "pos", *values)
    rest = inside.where(F.col("pos") % band != 0).unionByName(deeper).groupBy("rep", "pos").agg(*_sums(values))
    return rest.unionByName(complete)


def trie(keys: DataFrame, members: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, n_ends, ends_sha256).

    `keys` are rows (conv, pos, a, b, size) as `turn_keys` gives them, pos being 1, 2, ... in each conversation;
    `members` has one row (conv) per conversation, also of those without turns. A node is a distinct sequence
    of first turns, told by 128 bits of hashes of them; two of n nodes are taken for one by a chance of about n^2 / 2^129.
    It goes by its smallest member and its depth. The root has depth 0, all conversations and no parent.
    Without members there are no rows.

    A conversation is the smallest member of all nodes on its way from some depth on, so its own nodes form a
    chain: all but the first have itself as parent.
    """
    members = stored(members.select("conv"), "trie-members")
    rows = stored(_prefixes(keys), "trie-prefixes")
    root = members.agg(F.min("conv")).first()[0]
    zero = F.lit(0).cast("long")
    if root is None:
        root = 0
    nodes = rows.groupBy("pos", "x", "y").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.min("size").alias("size"))
    nodes = stored(nodes, "trie-nodes")
    # The rows of a node that most conversations share are split by AQE, as both sides come straight from storage.
    on = ["pos", "x", "y"]
    met = rows.select("conv", *on).join(nodes.select(*on, "rep").hint("merge"), on).select("conv", "pos", "rep")
    top = members.select("conv", zero.alias("pos"), F.lit(root).cast("long").alias("rep"))
    paths = stored(met.unionAll(top), "trie-paths")

    own = F.col("rep") == F.col("conv")
    last = F.max(F.struct("pos", "rep"))
    chains = paths.groupBy("conv").agg(
        last.alias("last"), F.min(F.when(own, F.col("pos"))).alias("first"), F.max(F.when(~own, F.struct("pos", "rep"))).alias("above")
    )
    chains = stored(chains, "trie-chains")
    ends = chains.select(F.col("last.rep").alias("rep"), F.col("last.pos").alias("depth"), "conv")
    ended = ends.groupBy("rep", "depth").agg(F.count(F.lit(1)).alias("n_ends"))
    heads = chains.where("first is not null and above is not null").groupBy(F.col("above.rep").alias("rep"), F.col("above.pos").alias("depth"))
    heads = heads.agg(F.count(F.lit(1)).alias("heads"))

    full = nodes.select("rep", F.col("pos").alias("depth"), "n_convs", "size")
    crown = members.agg(F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    full = full.unionAll(crown.select(F.lit(root).cast("long").alias("rep"), zero.alias("depth"), "n_convs", zero.alias("size")))
    at = ["rep", "depth"]
    chain = chains.where("first is not null").select(F.col("conv").alias("rep"), "first", F.col("above.rep").alias("above"), F.col("last.pos").alias("deepest"))
    full = full.join(stored(ended, "trie-ended").hint("merge"), at, "left").join(stored(heads, "trie-heads").hint("merge"), at, "left").join(chain.hint("merge"), "rep")
    full = full.select(
        *at, "n_convs", F.coalesce("n_ends", zero).alias("n_ends"), (F.coalesce("heads", zero) + (F.col("depth") < F.col("deepest")).cast("long")).alias("n_children"),
        F.when(F.col("depth") > F.col("first"), F.col("rep")).otherwise(F.col("above")).alias("parent"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    full = stored(full, "trie-full")

    values = ["n_leaves", "saved_tokens"]
    worth = full.select("rep", F.col("depth").alias("pos"), (F.col("n_children") == 0).cast("long").alias(values[0]), F.col("saved").alias(values[1]))
    owned = paths.where(own).join(worth.hint("merge"), ["rep", "pos"]).select("conv", "pos", "rep", *values)
    valued = stored(owned.unionAll(paths.where(~own).select("conv", "pos", "rep", *[zero.alias(v) for v in values])), "trie-valued")
    totals = band_totals(valued, values, band).withColumnRenamed("pos", "depth")
    empty = F.sha2(F.lit(""), 256)
    out = full.join(totals.hint("merge"), at, "left").join(id_hashes(ends).hint("merge"), at, "left")
    return out.select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("n_leaves", zero).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"), "n_ends", F.coalesce("sha", empty).alias("ends_sha256"),
    )


def prefix_trie(df: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text", band: int = BAND) -> DataFrame:
    """The trie of a table of turns, as `trie` gives it; turns are read as `turn_keys` does."""
    keys = stored(turn_keys(df, conv, order, role, text), "trie-keys")
    return trie(keys, keys.select("conv").distinct(), band)

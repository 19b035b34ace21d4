"""The prefix trie against a plain one in Python."""

import hashlib
import random
from collections import defaultdict

import pytest

from spelltide.llm import trie as module
from spelltide.llm.queries import op11_prefix_trie
from spelltide.llm.scratch import stored
from spelltide.llm.trie import band_totals, id_hashes, prefix_trie, trie, turn_keys

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(ways):
    """Rows (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, n_ends, sha) of {conv: list of (role, text)}."""
    members = defaultdict(list)
    for conv, way in sorted(ways.items()):
        for d in range(len(way) + 1):
            members[tuple(way[:d])].append(conv)
    out = set()
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = [c for c in convs if len(ways[c]) == len(node)]
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.add((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children), len(leaves), saved, len(ends), sha))
    return out


def frame(spark, ways):
    rows = [(c, i, r, t) for c, way in ways.items() for i, (r, t) in enumerate(way)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def random_ways(seed, convs, deepest, words):
    pick = random.Random(seed)
    ways = {}
    for c in pick.sample(range(-50, 900), convs):
        start = list(ways[pick.choice(list(ways))]) if ways and pick.random() < 0.8 else []
        start = start[: pick.randint(0, len(start))]
        grown = [(pick.choice("ua"), pick.choice(words)) for _ in range(pick.randint(0 if start else 1, max(1, deepest - len(start))))]
        ways[c] = start + grown
    return ways


@pytest.mark.parametrize("seed, convs, deepest, band", [(1, 40, 6, 2), (2, 60, 30, 3), (3, 30, 90, 2), (4, 80, 12, 8)])
def test_random_tries(spark, seed, convs, deepest, band):
    ways = random_ways(seed, convs, deepest, ["", "é", "yes", "no no"])
    assert {tuple(r) for r in prefix_trie(frame(spark, ways), band=band).collect()} == plain(ways)


def test_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 4)
    ways = {1: [("u", "x")] * 19, 2: [("u", "x")] * 19 + [("a", "y")], 3: [("u", "x")] * 8 + [("u", "z")] * 9}
    assert {tuple(r) for r in prefix_trie(frame(spark, ways)).collect()} == plain(ways)


def test_long_id_lists(spark):
    ends = spark.range(9_000).selectExpr("1L as rep", "0L as depth", "id * 7 as conv").unionAll(spark.createDataFrame([(2, 0, -5)], "rep long, depth long, conv long"))
    want = hashlib.sha256(",".join(str(i * 7) for i in range(9_000)).encode()).hexdigest()
    assert {tuple(r) for r in id_hashes(ends.repartition(5)).collect()} == {(1, 0, want), (2, 0, hashlib.sha256(b"-5").hexdigest())}


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, None, None, "late"), (1, 1, "u", None), (1, 1, "u", None), (2, None, "", "late"), (None, 1, "u", "x"), (2, 5, "a", "tie"), (2, 5, "a", "other")]
    df = spark.createDataFrame([r + (0,) * 8 for r in rows], SCHEMA + ", conv int, pos int, a int, size int, ord int, part int, rep int, depth int")
    have = {(r.conv_id, r.depth): r for r in prefix_trie(df).collect()}
    assert set(have) == {(1, 0), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3)}
    assert have[1, 1].n_convs == 2 and have[1, 1].saved_tokens == 4 and have[1, 0].n_leaves == 2
    again = {tuple(r) for r in prefix_trie(df.repartition(4)).collect()}
    assert again == {tuple(r) for r in have.values()}


def test_empty_table_and_conversations_without_turns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty).count() == 0
    keys = stored(turn_keys(empty, "conv_id", "turn", "role", "text"), "none")
    rows = trie(keys, spark.createDataFrame([(3,), (2,)], "conv long")).collect()
    assert [tuple(r) for r in rows] == [(2, 0, None, 2, 0, 1, 0, 2, hashlib.sha256(b"2,3").hexdigest())]


def test_a_long_text(spark):
    text = "é" * 2_000_000
    ways = {1: [("u", text)], 2: [("u", text), ("a", "x")]}
    assert {tuple(r) for r in prefix_trie(frame(spark, ways)).collect()} == plain(ways)


def test_one_conversation_holds_most_turns(spark):
    """Turns of a hot conversation are ranked by several tasks."""
    ways = {0: [("u", str(i % 7)) for i in range(4_000)], **{c: [("u", "0")] for c in range(1, 200)}}
    keys = turn_keys(frame(spark, ways).repartition(8), "conv_id", "turn", "role", "text")
    assert sorted(r.pos for r in keys.where("conv = 0").collect()) == list(range(1, 4_001))
    totals = band_totals(
        spark.range(4_001).selectExpr("0L as conv", "id as pos", "0L as rep", "1L as n"), ["n"], 8
    )
    assert {r.pos: r.n for r in totals.collect()} == {i: 4_001 - i for i in range(4_001)}


def test_query_rebuilds(spark, sf):
    import zlib

    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role or "", r.text or ""))
    ways = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        ways[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    want = {r[:7] + r[8:] for r in plain(ways)}
    assert {tuple(r) for r in op11_prefix_trie(spark, sf).collect()} == want

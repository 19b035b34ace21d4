import random
import re

import numpy as np
import pytest

from spelltide.llm import graph, ngram_join


def sets_of(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def expected(rows):
    sets = [(i, sets_of(t)) for i, t in rows]
    links = [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[n + 1 :] if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    found = roots({i for i, _ in rows}, links)
    return sorted((i, len(s), found[i]) for i, s in sets)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    texts = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4 and texts:
            base = rng.choice(texts).split()
            for _ in range(rng.randint(0, max(1, len(base) // 20))):
                if base:
                    base[rng.randrange(len(base))] = rng.choice(words)
            texts.append(" ".join(base))
        elif kind < 0.7:
            texts.append(" ".join(passage + [rng.choice(words) for _ in range(rng.randint(2, 30))]))
        else:
            texts.append(" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 40, 90, 300]))))
    return list(enumerate(texts))


def found(df):
    return sorted(tuple(r) for r in ngram_join.link_documents(df).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_comparing_all_pairs(spark, documents, seed):
    rows = corpus(seed, 160)
    assert found(documents(rows)) == expected(rows)


def test_small_slices_give_the_same(spark, documents, monkeypatch):
    rows = corpus(3, 120)
    monkeypatch.setattr(ngram_join, "SLICE", 4)
    assert found(documents(rows)) == expected(rows)


def test_short_empty_null_and_repeated(spark, documents):
    rows = [(1, "A  b\tC"), (2, "a b c"), (3, "a b"), (4, ""), (5, None), (6, " \n"), (7, "A b c"), (7, "a b c"), (8, "x " * 60_000), (9, "X " * 60_000 + "y")]
    rows += [(10, "repeated id one two three"), (10, "a b c")]
    df = documents(rows + [(None, "a b c")]).selectExpr("*", "1 as node", "2 as token", "3 as k1")
    out = {}
    for r in ngram_join.link_documents(df).collect():
        out.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert out[1] == out[2] == [(1, 1)] and out[7] == [(1, 1)] * 2 and out[None] == [(1, None)]
    assert out[3] == [(1, 3)] and out[4] == [(0, 4)] and out[5] == [(0, 5)] and out[6] == [(0, 6)]
    assert sorted(out[10]) == [(1, 1), (1, 1)]
    assert out[8] == [(1, 8)] and out[9] == [(2, 9)]


def test_repeated_ids_with_unlike_texts(spark, documents):
    """Ids 0 to 9 have several texts each, which meet in the same blocks."""
    texts = [t for _, t in corpus(5, 90) if len(t.split()) > 30]
    rows = [(i % 10, t) for i, t in enumerate(texts)]
    sets = [(i, sets_of(t)) for i, t in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 75 * len(x | y)]
    want = roots(set(range(10)), links)
    assert found(documents(rows)) == sorted((i, len(s), want[i]) for i, s in sets)


def test_empty_table(spark, documents):
    assert found(documents([])) == []


def test_tree_finds_all_pairs_within_the_bound():
    rng = np.random.Generator(np.random.PCG64(6))
    base = rng.poisson(4, (60, ngram_join.GROUPS))
    vectors = np.maximum(0, base[rng.integers(0, 60, 900)] + rng.integers(-1, 2, (900, ngram_join.GROUPS)) * (rng.random((900, 1)) < 0.5))
    sizes = vectors.sum(1)
    a, b = ngram_join.CountTree(vectors.astype(np.uint32), sizes).pairs()
    have = {tuple(sorted(x)) for x in zip(a.tolist(), b.tolist())}
    bound = np.minimum(vectors[:, None], vectors[None]).sum(2)
    want = bound >= ngram_join.least_overlap(sizes[:, None], sizes[None])
    assert have == {(i, j) for i, j in zip(*np.nonzero(want)) if i < j} and len(have) == len(a)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(300, 340)] + [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(500, k) for k in range(501, 700)]
    out = {r.node: r.root for r in graph.components(spark.createDataFrame(edges + edges[:9], "a long, b long").repartition(5)).collect()}
    want = roots({x for e in edges for x in e}, edges)
    assert out == {n: r for n, r in want.items() if n != r}
    assert graph.components(spark.createDataFrame([(4, 4)], "a long, b long")).count() == 0


def test_tree_keeps_blocks_apart_and_searches_for_some():
    rng = np.random.Generator(np.random.PCG64(8))
    vectors = rng.poisson(3, (40, ngram_join.GROUPS))[rng.integers(0, 40, 700)].astype(np.uint32)
    sizes, block = vectors.sum(1).astype(np.int64), rng.integers(0, 90, 700)
    tree = ngram_join.CountTree(vectors, sizes, block)
    bound = np.minimum(vectors[:, None], vectors[None]).sum(2) >= ngram_join.least_overlap(sizes[:, None], sizes[None])
    want = {(i, j) for i, j in zip(*np.nonzero(bound & (block[:, None] == block[None]))) if i != j}
    assert {tuple(sorted(x)) for x in zip(*(x.tolist() for x in tree.pairs()))} == {p for p in want if p[0] < p[1]}
    some = rng.choice(700, 60, replace=False)
    a, b = tree.pairs(lambda a, b: b % 3 > 0, some)
    assert set(zip(a.tolist(), b.tolist())) == {p for p in want if p[0] in set(some.tolist()) and p[1] % 3}


def test_every_candidate_comes_out_of_the_tree(spark, documents, monkeypatch):
    """Both searches yield nothing without the tree, and what the tree gives holds all links of the corpus."""
    rows = corpus(4, 150)
    given, plain = [], ngram_join.CountTree.pairs
    keep = {}

    def counted(self, wanted=None, queries=None):
        pairs = plain(self, wanted, queries)
        given.append(len(pairs[0]))
        return pairs

    monkeypatch.setattr(ngram_join.CountTree, "pairs", counted)
    for name in ("_pivot_pairs", "_block_pairs"):
        group = getattr(ngram_join, name)
        keep[name] = []
        table = GROUPS_OF[name]()
        found_ = group(table)
        assert found_.num_rows and given and given[-1] >= found_.num_rows
        monkeypatch.setattr(ngram_join.CountTree, "pairs", lambda self, wanted=None, queries=None: (np.zeros(0, np.int64),) * 2)
        assert group(table).num_rows == 0
        monkeypatch.setattr(ngram_join.CountTree, "pairs", counted)
    assert found(documents(rows)) == expected(rows)


def _vectors(n):
    return [v.tobytes() for v in np.random.Generator(np.random.PCG64(1)).poisson(4, (1, ngram_join.GROUPS)).astype(np.uint32).repeat(n, 0)]


def _pivot_group():
    size = int(np.frombuffer(_vectors(1)[0], np.uint32).sum())
    return ngram_join.pa.table({"pivot": [1, 1, 1, 7], "slice": [0, 0, 0, 0], "node": [1, 2, 3, 9], "asks": [True, False, False, False], "n_shingles": [size] * 4, "vector": _vectors(4)})


def _block_group():
    size, tokens = int(np.frombuffer(_vectors(1)[0], np.uint32).sum()), [[5, 6, 7]] * 3
    columns = {"token": [5] * 3, "i": [0] * 3, "j": [0] * 3, "node": [1, 2, 3], "component": [1, 2, 3], "slice": [0] * 3, "slices": [1] * 3, "pivot": [1] * 3}
    return ngram_join.pa.table({**columns, "n_shingles": [size] * 3, "vector": _vectors(3), "of": [3] * 3, "tokens": tokens})


GROUPS_OF = {"_pivot_pairs": _pivot_group, "_block_pairs": _block_group}

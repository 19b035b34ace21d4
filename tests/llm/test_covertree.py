"""Hard negatives against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spelltide.llm import covertree
from spelltide.llm.covertree import _augmented, _Tree, hard_negatives

SCHEMA = "id long, vec array<long>, label long"


def plain(rows, step=10, least=80, most=100, k=5):
    """Rows of the result from (id, vector, label), each id once."""
    width = max((len(v) for _, v, _ in rows), default=0)
    x = np.array([list(v) + [0] * (width - len(v)) for _, v, _ in rows], np.int64).reshape(len(rows), width)
    score, out = x @ x.T, set()
    for i, (a, _, label) in enumerate(rows):
        if a % step:
            continue
        order = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-score[i, j], rows[j][0]))
        for p in [j for j in order if rows[j][2] == label][:k]:
            s = score[i, p]
            hard = [j for j in order if rows[j][2] != label and least * s <= 100 * score[i, j] <= most * s][:k]
            out |= {(a, rows[p][0], r, rows[j][0], int(s), int(score[i, j])) for r, j in enumerate(hard, 1)}
    return out


def found(df, step=10, **options):
    return {tuple(r) for r in hard_negatives(df, "id", "vec", "label", F.col("id") % step == 0, **options).collect()}


def clustered(seed, n, width, spread=0.3, scale=256):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(6, width))
    x = centres[pick.integers(0, 6, n)] + spread * pick.normal(size=(n, width))
    x *= scale * np.exp(pick.normal(size=(n, 1)) / 2)
    return [(i, np.floor(v).astype(int).tolist(), int(pick.integers(0, 4))) for i, v in enumerate(x)]


@pytest.mark.parametrize("seed, n, width, tile", [(1, 300, 8, 1 << 19), (2, 900, 5, 1_000), (3, 700, 24, 2_400), (4, 40, 1, 64)])
def test_against_all_pairs(spark, monkeypatch, seed, n, width, tile):
    monkeypatch.setattr(covertree, "TILE", tile)
    rows = clustered(seed, n, width)
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_other_shares_and_counts(spark):
    rows = clustered(7, 200, 6)
    have = found(spark.createDataFrame(rows, SCHEMA), positives=3, negatives=3, least=55, most=95)
    assert have == plain(rows, least=55, most=95, k=3)


def test_ties_and_many_copies(spark, monkeypatch):
    """A third of all rows are copies of one vector; ties go to the smaller id."""
    monkeypatch.setattr(covertree, "TILE", 400)
    rows = clustered(5, 300, 4) + [(1_000 + i, [300, 40, -7, 90], i % 2) for i in range(150)] + [(2_000 + i, [0, 0, 0, 0], i % 2) for i in range(20)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_rows_that_take_no_part(spark):
    good = [(0, [10, 0], 1), (1, [9, 1], 1), (2, [8, 0], 2), (3, [7], 2), (5, [], 2)]
    bad = [(None, [10, 0], 2), (6, None, 2), (7, [None, 1], 2), (8, [8, 0], None), (9, [covertree.LARGEST, 0], 2), (2, [9, 0], 3)]
    df = spark.createDataFrame([r + (1, 2, 3, 4, 5) for r in good + bad], SCHEMA + ", row int, anchor int, cell int, low int, window int")
    assert found(df) == plain(good) != set()


def test_empty_and_small_tables(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == set()
    assert found(spark.createDataFrame([(0, [1], 1)], SCHEMA)) == set()
    assert found(spark.createDataFrame([(0, [1], 1), (1, [1], 1), (2, [-1], 2)], SCHEMA)) == set()


def test_tree_covers_its_points_and_skips_nodes(monkeypatch):
    pick = np.random.default_rng(2)
    x = np.floor(np.concatenate([c + pick.normal(size=(200, 6)) for c in 60 * pick.normal(size=(8, 6))]))
    norm = np.sqrt((x * x).sum(1)).max()
    wide = _augmented(x, norm)
    assert np.allclose((wide * wide).sum(1), norm * norm)
    tree = _Tree.build(wide)
    held = np.sort(np.concatenate([p for level in tree.leaves for p in level if p is not None]))
    assert (held == np.arange(len(x))).all()
    for level, leaves in enumerate(tree.leaves):
        for node, points in enumerate(leaves):
            if points is not None:
                at = node
                for up in range(level, -1, -1):
                    away = np.sqrt(((wide[points] - tree.centres[up][at]) ** 2).sum(1))
                    assert away.max() <= tree.radii[up][at] + 1e-6 or up < level and tree.radii[up][at] > 0
                    at = tree.parents[up][at]
    ids, labels = np.arange(len(x)), np.zeros(len(x), np.int64)
    met = []

    class Counted(covertree._Found):
        def add(self, window, score, row):
            met.append(len(np.unique(row)))
            super().add(window, score, row)

    monkeypatch.setattr(covertree, "_Found", Counted)
    low, high = np.full((1, 1), covertree.LOWEST), np.full((1, 1), covertree.HIGHEST)
    got = covertree._search(tree, wide[:, :-1], ids, labels, norm, x[:1], np.array([-1]), np.array([0]), low, high, True, 5)
    best = np.lexsort((ids, -(x @ x[0])))[:5]
    assert got.row.tolist() == best.tolist() and sum(met) < len(x) / 2

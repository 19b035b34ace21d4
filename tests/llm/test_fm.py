import numpy as np
import pyarrow as pa
import pytest

from spelltide.llm import fm
from spelltide.llm.words import utf8


def make(documents, n=400):
    rng = np.random.Generator(np.random.PCG64(3))
    words = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "tree"]
    rows, labels = [], []
    for i in range(n):
        chosen = [words[k] for k in rng.integers(0, 8, 60)]
        good = i % 4 > 0
        rows.append((i, " ".join(chosen) + "." if good else "### ".join(chosen) + "$$$"))
        labels.append((i, int(good)))
    return documents(rows), labels


def test_learns_and_scores_all_rows(spark, documents):
    df, labels = make(documents)
    known = spark.createDataFrame([x for x in labels if x[0] < 300] + [(None, 1), (5, 1 - labels[5][1])], "doc_id long, quality int")
    model = fm.fit(df, known, "doc_id", "quality")
    extra = df.unionByName(documents([(1000, None), (1001, ""), (1002, "word " * 200_000)])).selectExpr("*", "1 as _key", "2 as label")
    out = {r.doc_id: r.score for r in fm.score(extra, model).collect()}
    assert len(out) == 403 and all(0 <= s <= 1 for s in out.values())
    assert sum((out[i] >= 0.5) == bool(y) for i, y in labels if i >= 300) >= 98
    again = fm.fit(df.repartition(5), known, "doc_id", "quality")
    assert np.allclose(again.linear, model.linear) and again.bias == pytest.approx(model.bias)


def test_sum_of_squares_identity():
    rng = np.random.Generator(np.random.PCG64(4))
    size = (1 << fm.WORD_BITS) + fm.STATISTICS
    model = fm.Model(0.5, 0.3, rng.normal(size=size), rng.normal(size=(size, fm.FACTORS)), np.zeros(fm.STATISTICS), np.ones(fm.STATISTICS))
    texts = ["one two two three", "", "a b c d e f g\nh"]
    x = fm.features(*utf8(pa.array(texts)), np.array([1.0, np.nan, 3.0]))
    margin = model.margin(x, 3)
    for r in range(3):
        full = np.zeros(size)
        full[x.word[x.row == r]] = x.weight[x.row == r]
        full[1 << fm.WORD_BITS :] = np.clip(x.dense[r], -4, 4) / np.sqrt(fm.STATISTICS)
        at = np.flatnonzero(full)
        pairs = sum(model.factors[i] @ model.factors[j] * full[i] * full[j] for n, i in enumerate(at) for j in at[n + 1 :])
        assert margin[r] == pytest.approx(0.3 + model.linear @ full + pairs)


@pytest.mark.parametrize(("labels", "score"), [([], 1.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0), ([(1, 7)], 1.0)])
def test_without_both_classes_the_score_is_constant(spark, documents, labels, score):
    df = documents([(1, "a"), (2, None)])
    model = fm.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"), "doc_id", "quality")
    assert [r.score for r in fm.score(df, model).collect()] == [score] * 2


def test_empty_table(spark, documents):
    df, labels = make(documents, 40)
    model = fm.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"), "doc_id", "quality")
    assert fm.score(documents([]), model).count() == 0
    assert fm.fit(documents([]), spark.createDataFrame(labels, "doc_id long, quality int"), "doc_id", "quality").linear is None

import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from spelltide.llm import sampling
from spelltide.llm.words import mix, pieces

TEXTS = ["Hello  world\n x", "", " lead", "a▁b", "é😀\x00\t", "the end of  ", "x", "ÄÖ\n\n\n", "▁", "  ", "中文 text 中文", "a" * 700 + " tail " + "é" * 300]


@pytest.fixture(scope="module")
def vocabulary():
    return sampling.load_vocabulary()


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=sampling.MODEL_FILE)


def lists(found):
    ids, offsets = found[:2]
    return [tuple(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]


def brute(vocabulary, model, text):
    """All segmentations and their probabilities."""
    pieces = {model.id_to_piece(i): i for i in range(vocabulary.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    line, out = "▁" + text.replace(" ", "▁"), {}

    def go(at, ids, weight):
        if at == len(line):
            out[tuple(ids)] = weight
            return
        for end in range(at + 1, min(len(line), at + 16) + 1):
            if line[at:end] in pieces:
                go(end, [*ids, pieces[line[at:end]]], weight + vocabulary.weight[pieces[line[at:end]]])

    go(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: math.exp(v - total) for k, v in out.items()}


def test_round_trip_and_library(vocabulary, model):
    for samples in (1, 3):
        for found in sampling.encode_texts(vocabulary, TEXTS, np.arange(len(TEXTS), dtype=np.uint64), samples):
            decoded = sampling.decode_ids(vocabulary, *found[:2])
            for text, back, ids, alive in zip(TEXTS, decoded, lists(found), found[2]):
                if alive:
                    assert back.decode() == text and model.decode(list(ids)) == text


def test_samples_follow_the_distribution_without_replacement(vocabulary, model):
    want = brute(vocabulary, model, "an it")
    n = 30_000
    first, second = map(lists, sampling.encode_texts(vocabulary, ["an it"] * n, mix(np.arange(n, dtype=np.uint64)), 2))
    assert all(a != b for a, b in zip(first, second))
    pairs = Counter(zip(first, second))
    for (a, b), times in pairs.most_common(12):
        p = want[a] * want[b] / (1 - want[a])
        assert abs(times / n - p) < 5 * math.sqrt(p / n)
    assert set(first) <= set(want)


def test_scores_and_inclusion(vocabulary, model):
    want = brute(vocabulary, model, "it is")
    n = 20_000
    found = sampling.encode_texts(vocabulary, ["it is"] * n, mix(np.arange(n, dtype=np.uint64) + np.uint64(7)), 3)
    for x in found:
        assert np.allclose(np.exp(x[3]), [want[k] for k in lists(x)], rtol=1e-4)
    assert (found[0][4] >= found[1][4]).all() and (found[1][4] >= found[2][4]).all()
    # Samples weighted by 1 / inclusion estimate sums over all segmentations.
    sums = sum(np.exp(x[3] - x[5]) for x in found)
    assert sums.mean() == pytest.approx(1, abs=0.03)


def test_all_segmentations_of_a_short_text(vocabulary, model):
    want = brute(vocabulary, model, "an")
    found = sampling.encode_texts(vocabulary, ["an", ""], np.array([5, 6], np.uint64), len(want) + 2)
    assert {lists(x)[0] for x in found if x[2][0]} == set(want)
    assert sum(x[2][0] for x in found) == len(want) and sum(x[2][1] for x in found) == 1
    assert all(x[5][0] == 0 for x in found if x[2][0])


def test_long_units_agree_with_short_ones(vocabulary, monkeypatch):
    texts = ["internationalisation", "understandings of x"]
    plain = sampling.build_lattice(vocabulary, texts).chance
    monkeypatch.setattr(sampling, "LONG_UNIT", 3)
    assert np.allclose(sampling.build_lattice(vocabulary, texts).chance, plain, rtol=1e-5)


def test_samples_depend_on_key_and_text_alone(spark, documents):
    rows = list(enumerate(TEXTS)) + [(50, None), (3, TEXTS[3]), (None, "no key"), (60, "long words and more " * 5_000)]
    df = documents(rows).selectExpr("*", "1 as _sp_seed2")
    one = sampling.encode(df, "doc_id").collect()
    two = sampling.encode(df.repartition(3), "doc_id", columns=["doc_id"]).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.sample, tuple(r.ids))
    assert sorted(map(key, one)) == sorted(map(key, two))
    empty = [r for r in one if r.doc_id == 50]
    assert [(r.ids, r.log_prob, r.log_inclusion) for r in empty] == [([], 0.0, 0.0)]
    assert len([r for r in one if r.doc_id == 3]) == 4
    back = sampling.decode(sampling.encode(df, "doc_id")).where("coalesce(text, '') <> decoded")
    assert back.isEmpty()


def test_empty_table(spark, documents):
    assert sampling.decode(sampling.encode(documents([]), "doc_id")).count() == 0


def test_only_edges_that_are_there_are_drawn(vocabulary, monkeypatch):
    texts = ["the quick brown fox jumps over the lazy dog " * 3, "=" * 32, "a b", "中文 text"]
    lattice = sampling.build_lattice(vocabulary, texts)
    drawn, plain = [], sampling._gumbel
    monkeypatch.setattr(sampling, "_gumbel", lambda *parts: drawn.append(plain(*parts)) or drawn[-1])
    heads, _ = sampling.search(lattice, np.arange(4, dtype=np.uint64), 2)
    steps = sum(int(h.length.sum()) for h in heads)
    most = np.sort((lattice.chance > 0).sum(1))[-steps:].sum()
    assert lattice.edge.shape[1] > 8
    assert sum(x.size for x in drawn) <= len(texts) + 2 * most < steps * lattice.edge.shape[1]


def test_memory_of_a_batch_is_bounded(vocabulary):
    number = np.random.default_rng(5).integers(0, 1 << 40, 250_000)
    column = pa.array([" ".join(f"{x:x}" for x in part) for part in np.split(number, 1000)])
    seeds = np.arange(len(column), dtype=np.uint64)
    sampling.encode_texts(vocabulary, ["warm"], seeds[:1], 2)
    tracemalloc.start()
    for low, high, _, _ in pieces(column, sampling.PIECE_BYTES):
        sampling.encode_texts(vocabulary, column[low:high].to_pylist(), seeds[low:high], 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20

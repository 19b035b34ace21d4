import dataclasses
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spelltide.llm import katz

LOW = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOW)) if w] + ["</s>"]


class Direct:
    """The model on plain counts."""

    def __init__(self, texts):
        self.words, self.pairs = Counter(), defaultdict(Counter)
        for text in texts:
            history = "<s>"
            for word in tokens(text):
                self.words[word] += 1
                self.pairs[history][word] += 1
                history = word
        self.total = sum(self.words.values())
        self.d1 = katz.good_turing([sum(c == r for c in self.words.values()) for r in range(1, 7)])
        times = Counter(c for own in self.pairs.values() for c in own.values())
        self.d2 = katz.good_turing([times[r] for r in range(1, 7)])
        self.unknown = 1 - sum(self.lower(self.d1, c) for c in self.words.values()) / self.total if self.total else 1.0

    @staticmethod
    def lower(discount, c):
        return c * discount.ratios[c - 1] if c <= katz.K else c - discount.high

    def one(self, word):
        return self.lower(self.d1, self.words[word]) / self.total if self.words[word] else self.unknown

    def alpha(self, history):
        own = self.pairs[history]
        return (1 - sum(self.lower(self.d2, c) for c in own.values()) / sum(own.values())) / (1 - sum(map(self.one, own)))

    def two(self, history, word):
        own = self.pairs.get(history)
        if not own:
            return self.one(word)
        return self.lower(self.d2, own[word]) / sum(own.values()) if own[word] else self.alpha(history) * self.one(word)

    def score(self, text):
        line = tokens(text)
        return sum(math.log10(self.two(h, w)) for h, w in zip(["<s>", *line], line))


def corpus(n=150, seed=4):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(3_000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 60, 200]))) for _ in range(n)]
    return [*texts, None, "", " \n ", "W1 w2 unknown-word w1", texts[0], "w1 " * 40_000]


def run(documents, texts, held, **options):
    df = documents(list(enumerate(texts))).withColumn("held", F.lit(False) if not held else F.col("doc_id").isin(*held))
    return {r.doc_id: r for r in katz.katz_scores(df.selectExpr("*", "1 as block", "2 as part"), "doc_id", "text", "held", **options).collect()}


@pytest.mark.parametrize("slice_", [1 << 18, 50])
def test_equals_a_direct_computation(spark, documents, monkeypatch, slice_):
    monkeypatch.setattr(katz, "HISTORY_SLICE", slice_)
    texts = corpus()
    held = [i for i in range(len(texts)) if i % 5 == 2 or i == 153]
    out = run(documents, texts, held)
    model = Direct([t for i, t in enumerate(texts) if i not in held])
    for i, text in enumerate(texts):
        line = tokens(text)
        assert (out[i].n_tokens, out[i].train_tokens, out[i].held_out) == (len(line), model.total, i in held)
        assert out[i].n_known == sum(model.words[w] > 0 for w in line)
        base = sum(math.log10((model.words[w] + 1) / (model.total + len(model.words) + 1)) for w in line)
        assert out[i].base_score == pytest.approx(base) and out[i].score == pytest.approx(model.score(text))


def test_probabilities_sum_to_one():
    model = Direct(t for t in corpus() if t)
    for history in ("<s>", "w1", "w2", *list(model.pairs)[:40]):
        own = model.pairs[history]
        rest = 1 - sum(map(model.one, own))
        assert sum(model.two(history, w) for w in own) + model.alpha(history) * rest == pytest.approx(1)
        assert 0 < model.alpha(history)
    assert sum(map(model.one, model.words)) + model.unknown == pytest.approx(1)


@pytest.mark.parametrize("times", [[1000, 300, 140, 80, 52, 36], [10, 50, 3, 0, 1, 7], [5, 5, 5, 5, 5, 5], [0, 0, 0, 0, 0, 0], [7, 0, 0, 0, 0, 0]])
def test_discounts_are_between_zero_and_one(times):
    discount = katz.good_turing(times)
    assert all(0 < d <= 1 for d in discount.ratios) and 0 < discount.high < 1


def test_no_training_rows_and_empty_table(spark, documents):
    out = run(documents, ["a b", None], [0, 1])
    assert [(out[i].n_tokens, out[i].n_known, out[i].train_tokens, out[i].score) for i in (0, 1)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert run(documents, [], []) == {}


@pytest.mark.parametrize("fan", [2, 5])
def test_folded_blocks_give_the_same(spark, documents, fan):
    """Tens of blocks, folded at several heights, against the plain counts."""
    texts = corpus(60)
    held = [i for i in range(len(texts)) if i % 5 == 2]
    out = run(documents, texts, held, block_bytes=3_000, fan=fan)
    model = Direct([t for i, t in enumerate(texts) if i not in held])
    for i, text in enumerate(texts):
        assert out[i].n_known == sum(model.words[w] > 0 for w in tokens(text)) and out[i].train_tokens == model.total
        assert out[i].score == pytest.approx(model.score(text))


def test_rows_grow_with_the_blocks(spark, documents, monkeypatch):
    """Requests, unions and replies of all heights are a bounded number for each block, not for each pair of them."""
    rng = random.Random(8)
    plain, counts = katz.stored, {}

    def counted(df, label, **options):
        kept = plain(df, label, **options)
        counts[label] = counts.get(label, 0) + kept.count()
        return kept

    monkeypatch.setattr(katz, "stored", counted)
    per_block = []
    for blocks in (10, 90):
        counts.clear()
        texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(150)) for _ in range(blocks)]
        df = documents(list(enumerate(texts))).coalesce(1).withColumn("held", F.lit(False))
        katz.katz_scores(df, "doc_id", "text", "held", block_bytes=500, fan=8)
        per_block.append(sum(n for label, n in counts.items() if label.startswith(("katz-words", "katz-pairs"))) / blocks)
    assert per_block[1] < 2.5 * per_block[0] and "katz-pairs-above-folded" in counts


def test_nothing_stays_behind_after_an_error(spark, documents, monkeypatch):
    def broken(*_):
        raise ValueError("stop")

    monkeypatch.setattr(katz, "_totals", broken)
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(ValueError, match="stop"):
        run(documents, ["a b c"], [])
    assert {t.name for t in spark.catalog.listTables()} == before


def test_blocks_of_a_batch_are_copied_one_at_a_time():
    weights = pa.array([[{"h": h, "alpha": 0.5} for h in range(20_000)]] * 8 + [None])
    batch = pa.RecordBatch.from_pydict({"words": pa.array([b"x" * (4 << 20)] * 9, pa.binary()), "weights": weights})
    tracemalloc.start()
    seen = 0
    for words, found in katz._rows(batch):
        seen += len(words) + (0 if found is None else int(found.field("h").to_numpy().sum()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 9 * (4 << 20) + 8 * 20_000 * 19_999 // 2 and peak < 10 << 20


def test_python_gets_few_blocks_at_a_time(documents, spark, monkeypatch):
    option, seen, plain = "spark.sql.execution.arrow.maxRecordsPerBatch", [], katz._scored
    before = spark.conf.get(option)
    monkeypatch.setattr(katz, "_scored", lambda *a: seen.append(int(spark.conf.get(option))) or plain(*a))
    df = documents([(1, "a b c"), (2, "a b")]).withColumn("held", F.lit(False))
    assert katz.katz_scores(df, "doc_id", "text", "held").count() == 2
    assert seen == [katz.BATCH_BLOCKS] and seen[0] < 10 and spark.conf.get(option) == before


def test_unions_are_opened_once_and_ask_in_few_ranges(spark, documents, monkeypatch, tmp_path):
    """A union is read once for all its members, and asks in as many ranges within its own as there are unions."""
    plain, kind, rows = katz.stored, katz._pair_kind, {}
    opened = str(tmp_path / "opened")

    def counted(df, label, **options):
        kept = plain(df, label, **options)
        rows[label] = kept.count()
        return kept

    def noted(*args):
        made = kind(*args)

        def answer(*args):
            with open(opened, "a") as f:
                f.write("x")
            return made.answer(*args)

        return dataclasses.replace(made, answer=answer)

    monkeypatch.setattr(katz, "stored", counted)
    monkeypatch.setattr(katz, "_pair_kind", noted)
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(150)) for _ in range(90)]
    df = documents(list(enumerate(texts))).coalesce(1).withColumn("held", F.lit(False))
    out = {r.doc_id: r.score for r in katz.katz_scores(df, "doc_id", "text", "held", block_bytes=500, fan=32).collect()}
    unions, ranges = 3, 32
    with open(opened) as f:
        assert len(f.read()) <= unions * ranges
    assert rows["katz-pairs-above"] <= ranges * unions * (unions + 1)
    model = Direct(texts)
    assert all(out[i] == pytest.approx(model.score(text)) for i, text in enumerate(texts))


def test_requests_hold_what_went_in():
    """Also where one history ends a request and begins the next."""
    history, word = np.array([0, 0, 7, 7, 7, 9 << 40]), np.array([1, 5 << 45, 2, 3, 4, 1])
    of_history, count, seen = np.array([300, 300, 0, 0, 0, 1 << 33]), np.array([0, 1, 2, 3, 70_000, 1 << 40]), np.arange(6)
    requests = list(katz._pack_pairs(history, of_history, word, count, seen, np.array([0, 3, 6])))
    (heads, head_counts, lengths), pairs, of_heads, of_pairs = katz._unpack_pairs(requests)
    assert (heads.tolist(), head_counts.tolist(), lengths.tolist()) == ([0, 7, 7, 9 << 40], [300, 0, 0, 1 << 33], [2, 1, 2, 1])
    assert [x.tolist() for x in pairs] == [word.tolist(), count.tolist(), seen.tolist()] and (of_heads.tolist(), of_pairs.tolist()) == ([0, 2, 4], [0, 3, 6])
    assert katz._unpack_all(katz._pack_all(count, np.array([0, 2, 2, 6]))).tolist() == count.tolist()
    for x in ([], [0], [0, 255], [1 << 56, 3]):
        assert katz._unpack(katz._pack(np.array(x, np.int64))).tolist() == x

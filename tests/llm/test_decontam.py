import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spelltide.llm import decontam
from spelltide.llm.words import utf8

RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 7))) for _ in range(600)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


ITEMS = [(i, f"{prose(12)}? {prose(6)}.") for i in range(30)] + [(30, prose(150) + ". " + prose(20) + "."), (31, prose(10).capitalize() + "."), (32, "two words")]
ITEM = "item_id long, text string"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([*ITEMS, (33, None), (34, ""), (None, "no id at all here")], ITEM)


def test_planted_items_are_found_and_clean_texts_are_not(spark, documents, items):
    rows, want = [], set()
    for d in range(80):
        text = prose(RNG.choice([0, 3, 60, 64, 65, 128, 700]))
        if d % 2:
            i = RNG.randrange(len(ITEMS) - 1)
            copy = ITEMS[i][1].upper() if d % 3 else ITEMS[i][1].replace(" ", "\n  ")
            text = f"{text}, {copy} {prose(RNG.choice([0, 5, 200]))}"
            want.add((d, ITEMS[i][0]))
        rows.append((d, text))
    df = documents(rows + [(1000, None), (1001, "")]).selectExpr("*", "1 as _found", "2 as item_id")
    out = decontam.with_leaks(df, items).selectExpr("doc_id", "explode(leaks) as leak").collect()
    assert {(r.doc_id, r.leak.item_id) for r in out} == want
    assert all(0.5 <= r.leak.score <= 1 for r in out)


def test_question_without_its_answer_is_no_leak(spark, documents, items):
    question = ITEMS[3][1].split("?")[0] + "?"
    df = documents([(1, f"{prose(50)} {question} {prose(50)}"), (2, f"{prose(50)} {ITEMS[3][1]} {prose(50)}")])
    out = decontam.with_leaks(df, items)
    assert [r.doc_id for r in out.where("size(leaks) > 0").collect()] == [2]


def test_blocks_of_items_give_the_same(spark, documents, items, monkeypatch):
    df = documents([(i, f"{prose(40)} {ITEMS[i][1]} {prose(90)}") for i in range(12)])
    whole = {r.doc_id: sorted(x.item_id for x in r.leaks) for r in decontam.with_leaks(df, items).collect()}
    monkeypatch.setattr(decontam, "INDEX_BYTES", 1_000)
    parts = {r.doc_id: sorted(x.item_id for x in r.leaks) for r in decontam.with_leaks(df, items).collect()}
    assert whole == parts and all(i in whole[i] for i in range(12))


def test_split_into_question_and_answer():
    assert decontam.question_and_answer("Who is it? It is me.") == ("Who is it?", " It is me.")
    assert decontam.question_and_answer("A first one. And a last one.") == ("A first one. ", "And a last one.")
    assert decontam.question_and_answer("Only one") == ("Only one", "")
    assert decontam.question_and_answer("Only a question?") == ("Only a question?", "")


def test_retrieval_equals_scoring_everything():
    items = [(i, t.lower()) for i, t in ITEMS]
    _, entries = decontam._entries(items)
    frequency = Counter(int(h) for e in entries for h in np.unique(e))
    mean = sum(map(len, entries)) / len(entries)
    index = decontam.build_index(items, len(entries), mean, frequency, 0.3)
    texts = [" ".join(w for _ in range(8) for w in (prose(15), " ".join(RNG.choice(ITEMS)[1].split()[: RNG.randint(3, 18)]))).lower() for _ in range(40)]
    tokens, row = decontam.token_hashes(*utf8(pa.array(texts)))
    have = {(r, a, e): s for r, a, e, s in zip(*(x.tolist() for x in decontam.retrieve(index, tokens, row)))}

    idf = {h: math.log1p((len(entries) - n + 0.5) / (n + 0.5)) for h, n in frequency.items()}

    def impacts(e):
        tf, norm = Counter(e.tolist()), 1 - decontam.B + decontam.B * len(e) / mean
        own = {h: idf[h] * n * (decontam.K1 + 1) / (n + decontam.K1 * norm) for h, n in tf.items()}
        return {h: w / sum(own.values()) for h, w in own.items()}

    weights = [impacts(e) for e in entries]
    want = {}
    for r in range(len(texts)):
        begin, end = np.searchsorted(row, [r, r + 1])
        for j in range(max(1, -(-(end - begin) // 64) - 1)):
            words = set(tokens[begin + 64 * j : min(end, begin + 64 * j + 128)].tolist())
            for e, w in enumerate(weights):
                score = sum(x for h, x in w.items() if h in words)
                if score >= 0.3:
                    want[r, begin + 64 * j, e] = score
    assert want and have.keys() == want.keys()
    assert all(have[k] == pytest.approx(want[k]) for k in want)


def test_empty_tables(spark, documents, items):
    assert decontam.with_leaks(documents([]), items).count() == 0
    none = decontam.with_leaks(documents([(1, "a b c")]), spark.createDataFrame([], ITEM)).collect()
    assert [r.leaks for r in none] == [[]]


def test_letters_are_lower_cased_words():
    tokens, _ = decontam.token_hashes(*utf8(pa.array(["é-a1,b\tc"])))
    assert len(tokens) == len(re.findall(r"[^\W_]+", "é-a1,b\tc"))

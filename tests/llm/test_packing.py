"""Packed sequences against a plain encoding of every text."""

import json
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spelltide.llm import packing
from spelltide.llm.packing import pack, sequences
from spelltide.llm.queries import op13_concat_cut

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain(text, end=(1,)):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, *end]


def checked(rows, texts, length, end=(1,)):
    """Pieces cover each text's ids once, fill sequences without gaps, and are padded at the end alone."""
    want = defaultdict(int)
    for key, text in texts:
        want[key, tuple(plain(text, end))] += 1
    by_sequence, have = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        by_sequence[r.sequence_id].append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    docs, open_ids = defaultdict(int), []
    for i, held in sorted(by_sequence.items()):
        at = 0
        for r in held:
            ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
            assert (r.offset, r.start, r.length) == (at, len(open_ids), len(ids)) and ids
            at += r.length
            open_ids += ids
            if len(open_ids) == r.doc_tokens:
                docs[r.doc_id, tuple(open_ids)] += 1
                open_ids = []
        assert at == length or i == len(by_sequence) - 1
        assert held[0].padded_to == (at if at & (at - 1) == 0 else length)
    assert not open_ids and docs == {k: n for k, n in want.items() if k[1]}


LONG = "Lorem ipsum, dolor! " * 3_000
TEXTS = [
    (1, "The cat's whiskers: 42 times."), (2, None), (3, ""), (None, "no id"), (4, "same"), (4, "same"), (5, LONG), (6, " \t\n"), (7, "a" * 5_000),
    (8, "H̱e été, ÀÉ; İstanbul KK ſ 中文，。 x y z \x1c\x85 <|endoftext|>, <|startoftext|>x. don't 'S 3.14e5 (a),b;c!?")
]


@pytest.mark.parametrize("length, end", [(2048, 1), (16, 1), (1, 1), (64, None)])
def test_pieces(spark, documents, length, end):
    df = documents(TEXTS).repartition(3)
    ends = () if end is None else (end,)
    checked(pack(df, "doc_id", "text", PATH, length, end).collect(), TEXTS, length, ends)


def test_whole_sequences(spark, documents):
    pieces = pack(documents(TEXTS), "doc_id", "text", PATH, 32)
    rows = sequences(pieces, "doc_id", pad=7).orderBy("sequence_id").collect()
    ids = [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in rows]
    assert all(len(x) == 32 for x in ids[:-1]) and ids[-1][rows[-1].n_tokens :] == [7] * (len(ids[-1]) - rows[-1].n_tokens)
    flat = [x for r, held in zip(rows, ids) for x in held[: r.n_tokens]]
    assert len(flat) == sum(len(plain(t)) for _, t in TEXTS)
    assert all([b.offset for b in r.boundaries] == np.cumsum([0, *[b.length for b in r.boundaries[:-1]]]).tolist() for r in rows)


def test_clashing_columns_empty_table_and_odd_keys(spark, documents):
    assert pack(documents([]), "doc_id", "text", PATH).count() == 0
    names = ["row", "key", "ids", "part", "before", "n_tokens", "base", "all", "first", "start", "length", "piece", "offset", "sequence_id", "padded_to"]
    df = spark.createDataFrame([("k", "one two") + (9,) * len(names)], ["name", "words", *names])
    assert [(r.name, r.length, r.doc_tokens) for r in pack(df, "name", "words", PATH).collect()] == [("k", 3, 3)]
    nested = spark.sql("SELECT named_struct('a b', 1, 'm', map('x', 2)) AS k, 'one' AS t")
    assert pack(nested, "k", "t", PATH).first().k["a b"] == 1


def test_texts_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(packing, "PIECE_BYTES", 50)
    text = ("ab cd,\té " * 40) + "x" * 120 + " " + "y" * 70
    words = packing._Words(PATH)
    cut = [words.ids(packing.pa.array([c.decode()]))[0] for c in packing._cuts(text.encode())]
    assert len(cut) > 5 and np.concatenate(cut).tolist() == plain(text, ())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAzZ éÉßİŉſ.,;:!?'s ṯ́  \t\n09-<|>中K"), max_size=40), max_size=5))
def test_ids_are_those_of_the_tokenizer(texts):
    words = packing._words(PATH)
    assert [x.tolist() for x in words.ids(packing.pa.array(texts, packing.pa.string()))] == [plain(t, ()) for t in texts]


def test_capital_letters_travel_with_plain_words():
    words, told = packing._Words(PATH), []
    joined = words._plain
    words._plain = lambda some: told.extend(some) or joined(some)
    text = "Été ÀÖÞ Straße Łódź Ÿes plain 12 a-b"
    assert words.ids(packing.pa.array([text]))[0].tolist() == plain(text, ())
    assert set(told) >= {"été", "àöþ", "straße", "łódź", "ÿes", "plain"}


def test_every_plain_letter_has_the_ids_of_the_whole_tokenizer():
    words = packing._Words(PATH)
    assert words.short is not None
    letters = [chr(c) for c in range(0x180) if re.match(packing.LETTERS, chr(c))]
    texts = [f"{c} a{c}b {c}{c} x{c}, s{c}" for c in letters]
    assert len(letters) > 200 and [x.tolist() for x in words.ids(packing.pa.array(texts))] == [plain(t, ()) for t in texts]


def test_no_step_is_left_out_of_an_unknown_tokenizer():
    steps = json.loads(Tokenizer.from_file(PATH).to_str())
    assert packing._shortened(steps) is not None
    assert packing._shortened({**steps, "normalizer": None}) is None
    assert packing._shortened({**steps, "pre_tokenizer": {"type": "Whitespace"}}) is None
    assert packing._shortened({**steps, "added_tokens": [{"content": "abc"}]}) is None


def test_query(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    whole = {k: np.array(plain(t), "<u4") for k, t in texts}
    rows = op13_concat_cut(spark, sf).collect()
    assert sum(r.length for r in rows) == sum(map(len, whole.values()))
    for r in rows:
        assert r.doc_tokens == len(whole[r.doc_id]) and r.ids_crc32 == zlib.crc32(whole[r.doc_id][r.start : r.start + r.length].tobytes())

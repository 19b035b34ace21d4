"""Token sequences of one length from documents of any length: concatenate, then cut."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spelltide.llm.scratch import stored

#: Bytes of text that a task turns into tokens at once. Longer texts are cut at white space.
PIECE_BYTES = 12 << 20
#: Words that go to the tokenizer as one text, and distinct words that a task remembers.
WORDS, REMEMBERED = 2_000, 1 << 20
#: ASCII white space, which no token of a tokenizer that drops white space can span.
WHITE = b"\t\n\x0b\x0c\r "
#: One word for the tokenizer: letters alone, each a character that it neither composes with another nor splits.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-įı-ňŊ-ſ]+$"
#: Steps of a tokenizer that only lower such words, or cut a text of them at white space.
LOWERING, CUTTING = {"NFC", "Replace", "Lowercase"}, r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A word that ends in such a letter, and the punctuation behind it.
TAIL = r"^(?P<head>.*[a-z\x{df}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{148}\x{14a}-\x{17f}])(?P<tail>[.,;:!?]+)$"
WORD_END = "</w>"


def _shortened(steps: dict) -> dict | None:
    """The tokenizer for texts of lower-case plain words and spaces alone: the same model without the steps that leave
    them as they are. Nothing where a step is none of those known."""
    normal, before = steps["normalizer"] or {}, (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
    spaces = [n for n in normal.get("normalizers", []) if n["type"] == "Replace"]
    known = (
        all(any(not c.isalpha() and c != " " for c in t["content"]) for t in steps["added_tokens"])
        and normal.get("type") == "Sequence" and {n["type"] for n in normal["normalizers"]} <= LOWERING
        and any(n["type"] == "Lowercase" for n in normal["normalizers"])
        and all(n["pattern"] == {"Regex": "\\s+"} and n["content"] == " " for n in spaces)
        and [b["type"] for b in before] == ["Split", "ByteLevel"]
        and before[0]["pattern"] == {"Regex": CUTTING} and before[0]["behavior"] == "Removed" and before[0]["invert"]
        and not before[1]["add_prefix_space"] and not before[1]["use_regex"]
    )
    if not known:
        return None
    return {**steps, "normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, before[1]]}}


class _Words:
    """Ids of many texts by a tokenizer that drops white space, by way of their distinct words.

    Words repeat, so a piece of the corpus is split at ASCII white space, and each distinct word goes to
    the tokenizer once; a million words are remembered from piece to piece. Punctuation behind a word of letters is a word of its own, as the tokenizer
    splits there too. Plain words travel together, and the marks of word ends tell their ids apart.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        short = _shortened(json.loads(self.model.to_str()))
        self.short = Tokenizer.from_str(json.dumps(short)) if short else None
        size = self.model.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([(self.model.id_to_token(i) or "").endswith(WORD_END) for i in range(size)], bool)
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where distinct words are among those remembered; new ones are encoded first."""
        if len(self.known) > REMEMBERED:
            self._forget()
        found = pc.index_in(words, value_set=self.known)
        fresh = words.filter(found.is_null())
        place = found.fill_null(0).to_numpy().astype(np.int64)
        if len(fresh):
            place[found.is_null().to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(fresh))
            ids, starts = self.table(fresh)
            self.known = pa.concat_arrays([self.known, fresh])
            self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])
            self.flat = np.concatenate([self.flat, ids])
        return place

    def _each(self, words: list[str], model=None) -> list[np.ndarray]:
        # The fast way makes the same ids without the words' places in the text.
        return [np.array(e.ids, np.uint32) for e in (model or self.model).encode_batch_fast(words, add_special_tokens=False)]

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and how many each has; one by one where the ends don't tell."""
        flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for low in range(0, len(words), WORDS):
            part = words[low : low + WORDS]
            (ids,) = self._each([" ".join(part)], self.short)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(part) and last[-1] == len(ids) - 1:
                count = np.diff(last, prepend=-1)
            else:
                some = self._each(part)
                ids, count = np.concatenate(some), np.array([len(x) for x in some])
            flat.append(ids)
            sizes.append(count)
        return np.concatenate(flat), np.concatenate(sizes)

    def table(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and the places where each begins, with the end of the last."""
        plain = pc.match_substring_regex(words, LETTERS).to_numpy(zero_copy_only=False)
        flat, sizes = self._plain(pc.utf8_lower(words.filter(pa.array(plain))).to_pylist())
        others = self._each(words.filter(pa.array(~plain)).to_pylist())
        count = np.zeros(len(words), np.int64)
        count[plain] = sizes
        count[~plain] = [len(x) for x in others]
        starts = np.concatenate([[0], np.cumsum(count)])
        ids = np.zeros(starts[-1], np.uint32)
        ids[np.repeat(plain, count)] = flat
        if others:
            ids[np.repeat(~plain, count)] = np.concatenate(others)
        return ids, starts

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = split.flatten().dictionary_encode()
        # Lower case commutes with the tokenizer's own steps only where no mark can be composed with a letter.
        lower = pc.if_else(pc.string_is_ascii(words.dictionary), pc.ascii_lower(words.dictionary), words.dictionary)
        parts = pc.extract_regex(lower, TAIL)
        heads = pc.if_else(pc.is_valid(parts), pc.struct_field(parts, "head"), lower)
        tails = pc.if_else(pc.is_valid(parts), pc.struct_field(parts, "tail"), pa.scalar("", lower.type))
        pairs = pa.concat_arrays([heads, tails]).dictionary_encode()
        code = self.places(pairs.dictionary)[pairs.indices.to_numpy()]
        ids, starts = self.flat, self.starts
        head, tail = code[: len(heads)], code[len(heads) :]
        use = words.indices.to_numpy()
        order = np.stack([head[use], tail[use]], 1).ravel()
        count = (starts[1:] - starts[:-1])[order]
        after = np.concatenate([[0], np.cumsum(count)])
        out = ids[np.repeat(starts[order] - after[:-1], count) + np.arange(after[-1])]
        bounds = after[2 * split.offsets.to_numpy().astype(np.int64)]
        return np.split(out, bounds[1:-1]) if len(texts) else []


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def _cuts(text: bytes) -> Iterator[bytes]:
    """A text in runs of about PIECE_BYTES that end at ASCII white space."""
    low = 0
    while len(text) - low > PIECE_BYTES:
        high = max(text.rfind(bytes([w]), low, low + PIECE_BYTES) for w in WHITE) + 1
        if high <= low:
            found = [i for w in WHITE if (i := text.find(bytes([w]), low + PIECE_BYTES)) >= 0]
            high = min(found) + 1 if found else len(text)
        yield text[low:high]
        low = high
    yield text[low:]


def _gathered(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until a column holds about PIECE_BYTES, so that more of its words repeat."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= PIECE_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _encoder(path: str, end: int | None):
    """Arrow batches (row, key, text) to (part, before, n_tokens, key, ids)."""

    def run(batches: Iterator[pa.RecordBatch]):
        words = _words(path)
        stop = np.array([] if end is None else [end], "<u4")
        before = 0

        def out(batch: pa.RecordBatch, ids: list[np.ndarray]):
            nonlocal before
            count = np.array([len(x) for x in ids], np.int64)
            places = before + np.cumsum(count) - count
            before += int(count.sum())
            part = batch.column(0).to_numpy() >> 33
            data = pa.array([x.tobytes() for x in ids], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(part), pa.array(places), pa.array(count), batch.column(1), data], ["part", "before", "n_tokens", "key", "ids"])

        for batch in _gathered(batches, 2):
            texts = batch.column(2).cast(pa.large_string()).fill_null("")
            size = pc.binary_length(texts).to_numpy()
            total = np.concatenate([[0], np.cumsum(size)])
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(total, total[low] + PIECE_BYTES, "right")) - 1)
                if size[low] > PIECE_BYTES:
                    ids = [np.concatenate([words.ids(pa.array([cut], pa.binary()).cast(pa.string()))[0] for cut in _cuts(texts[low].as_buffer().to_pybytes())])]
                else:
                    ids = words.ids(texts.slice(low, high - low))
                yield out(batch.slice(low, high - low), [np.concatenate([x, stop]).astype("<u4") for x in ids])
                low = high

    return run


def pack(df: DataFrame, key: str, text: str, path: str, length: int = 2048, end: int | None = 1) -> DataFrame:
    """Pieces of documents that fill sequences of `length` tokens: (key, start, length, ids, doc_tokens,
    sequence_id, offset, padded_to).

    A document's ids are those of the tokenizer in the file `path`, which must drop white space, without
    special tokens, then `end` (None: nothing). All documents follow one another; window i of `length`
    tokens is sequence i, and a document that crosses windows has a piece in each: `start` is the number of
    its ids before the piece, `offset` the piece's place in the sequence, `ids` its ids as little-endian
    unsigned 32-bit numbers. Only the last sequence can be shorter; it is padded to `length` unless its
    size is a power of two (`padded_to`).

    Null and empty texts are `end` alone, or without `end` have no piece. Null keys, repeated keys and
    repeated rows are documents like others. Other columns are dropped, whatever their names. An empty table gives
    no rows. The order of documents is that of the table's partitions, so another layout of the same table gives
    other sequences.

    Texts become ids once. The first pass stores them with the tokens before each document in its
    partition; partition totals, one row a partition, give the tokens before each partition. The second
    pass only cuts. Nothing but those totals is shuffled.
    """
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("part", "before", "n_tokens")] + [rows.schema["key"], T.StructField("ids", T.BinaryType())]
    )
    tokens = stored(rows.mapInArrow(_encoder(path, end), schema), "packing-tokens", compression="zstd")
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = F.coalesce(F.expr("sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0).cast("long"))
    # Stored, so that Spark knows its size, one row a partition, when it decides on a broadcast.
    bases = stored(totals.select("part", earlier.alias("base"), F.expr("sum(n) OVER ()").alias("all")), "packing-totals")
    placed = tokens.where("n_tokens > 0").join(bases, "part").withColumn("first", F.col("base") + F.col("before"))
    size, first, count = F.lit(length).cast("long"), F.col("first"), F.col("n_tokens")
    fill = F.expr(f"`all` - (`all` - 1) div {length} * {length}")

    def piece(i):
        start = F.greatest(i * size - first, F.lit(0).cast("long"))
        cut = F.least((i + 1) * size - first, count) - start
        tail = F.when(((i + 1) * size > F.col("all")) & (F.bit_count(fill) == 1), fill).otherwise(size)
        return F.struct(
            start.alias("start"),
            cut.alias("length"),
            F.substr(F.col("ids"), (start * 4 + 1).cast("int"), (cut * 4).cast("int")).alias("ids"),
            i.alias("sequence_id"),
            (first + start - i * size).alias("offset"),
            tail.alias("padded_to"),
        )

    windows = F.sequence(F.expr(f"first div {length}"), F.expr(f"(first + n_tokens - 1) div {length}"))
    cut = placed.select("key", F.col("n_tokens").alias("doc_tokens"), F.explode(F.transform(windows, piece)).alias("piece"))
    return cut.select(F.col("key").alias(key), "piece.start", "piece.length", "piece.ids", "doc_tokens", "piece.sequence_id", "piece.offset", "piece.padded_to")


def sequences(pieces: DataFrame, key: str, pad: int = 0) -> DataFrame:
    """One row per sequence: (sequence_id, n_tokens, ids padded with `pad`, boundaries: array of (offset, key, start, length)).

    A sequence has as many pieces as tokens at most, so no group is larger than the sequence length.
    """
    held = F.struct("offset", F.col(key).alias("key"), "start", "length", "ids")
    grouped = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(held)).alias("p"), F.sum("length").alias("n_tokens"), F.max("padded_to").alias("padded_to"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    filler = F.unhex(F.repeat(F.lit(pad.to_bytes(4, "little").hex()), (F.col("padded_to") - F.col("n_tokens")).cast("int")))
    bounds = F.transform("p", lambda x: F.struct(x["offset"].alias("offset"), x["key"].alias("key"), x["start"].alias("start"), x["length"].alias("length")))
    return grouped.select("sequence_id", "n_tokens", F.concat(joined, filler).alias("ids"), bounds.alias("boundaries"))

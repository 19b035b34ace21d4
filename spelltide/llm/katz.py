"""A bigram language model with Katz backoff, trained on and applied to whole corpora.

Texts are kept in blocks of some megabytes, as numbers of the block's own words. Counts are merged by
hash range: a block asks for its distinct n-grams and is sent their counts, in the order in which it
asked. So only distinct n-grams per block are shuffled, packed as arrays, and never a row per token. The
ranges of a block are bounded; where blocks are many, unions of blocks ask in their stead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from spelltide.llm.scratch import stored
from spelltide.llm.words import PIECE_BYTES, mix, pieces, word_hashes
from spelltide.sources.scratch import drop_path, scratch_path

BLOCK_BYTES = 8 << 20
#: Text in a bucket of blocks, which one task works on, and the fewest buckets.
BUCKET_BYTES, LEAST_BUCKETS = 32 << 20, 8
#: Counts above this are hardly discounted.
K = 5
#: What a count above K is lowered by, so that every history leaves something to unseen words.
HIGH_DISCOUNT = 0.05
#: A history is dealt to one more partition for so many of its tokens.
HISTORY_SLICE = 1 << 18
#: Hash ranges of words and of bigrams: at least so many, and one per so many blocks.
LEAST_RANGES, BLOCKS_PER_WORD_RANGE, BLOCKS_PER_PAIR_RANGE = 64, 2, 1
#: Blocks that Spark hands to Python at a time; by thousands, all blocks of a task would be held at once, on both sides.
BATCH_BLOCKS, BATCH_OPTION = 2, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Requests that meet in one task; of more blocks, so many are folded into one first. Also the most ranges of a block.
FAN = 8192

END, START = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a word's id, of a count and of a number of bigrams in a request.
ID, COUNT, LENGTH = 7, 6, 4


@lru_cache(maxsize=1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Made once a process: making them takes longer than a short request."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _planes(x: np.ndarray, width: int) -> np.ndarray:
    """Numbers from 0 as `width` rows of bytes, the low bytes of all first."""
    return np.ascontiguousarray(np.ascontiguousarray(x, "<i8").view(np.uint8).reshape(-1, 8)[:, :width].T)


def _numbers(planes: np.ndarray) -> np.ndarray:
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, : len(planes)] = planes.T
    return wide.view("<i8").ravel()


def _pack(x: np.ndarray) -> bytes:
    """Numbers from 0 as bytes, the low bytes of all first, compressed; first, how many bytes a number takes."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return _zstd()[0].compress(bytes([width]) + _planes(x, width).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    data = np.frombuffer(_zstd()[1].decompress(data), np.uint8)
    return _numbers(data[1:].reshape(data[0], -1))


def _pack_all(x: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """The counts from each cut to the next, packed."""
    planes, compress = _planes(x, COUNT), _zstd()[0].compress
    return [compress(planes[:, a:b].tobytes()) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def _unpack_all(packed: list[bytes]) -> np.ndarray:
    """All counts, one after the other."""
    return _numbers(np.concatenate([np.frombuffer(_zstd()[1].decompress(x), np.uint8).reshape(COUNT, -1) for x in packed], axis=1))


def _rows(batch: pa.RecordBatch) -> Iterator[list]:
    """The rows of a batch one by one, so that only one block is copied out of it at a time; lists of many small structs
    stay Arrow arrays."""
    kept = [pa.types.is_list(c.type) and pa.types.is_struct(c.type.value_type) and not any(pa.types.is_binary(f.type) for f in c.type.value_type) for c in batch.columns]
    for i in range(batch.num_rows):
        yield [c[i].values if whole else c[i].as_py() for c, whole in zip(batch.columns, kept)]


@dataclass(frozen=True)
class Discount:
    """The factor of a count: Good-Turing up to K, close to 1 above."""

    ratios: tuple[float, ...]
    high: float

    def __call__(self, count: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        low = np.append(0.0, np.arange(1, K + 1) * np.array(self.ratios))
        return np.where(count <= K, low[np.minimum(count, K)], count - self.high)


def _katz_ratios(n: list[float]) -> list[float]:
    """d_r = (r*/r - m) / (1 - m) with r* = (r + 1) n_{r+1} / n_r and m = (K + 1) n_{K+1} / n_1, or nothing where that is no discount."""
    m = (K + 1) * n[K + 1] / n[1]
    ratios = [((r + 1) * n[r + 1] / (r * n[r]) - m) / (1 - m) if m < 1 else 0 for r in range(1, K + 1)]
    return ratios if all(0 < d <= 1 for d in ratios) else []


def good_turing(times: list[int]) -> Discount:
    """Katz's discounts from how many n-grams occur 1, 2, ... K + 1 times.

    Where these numbers are too uneven for 0 < d_r <= 1, a line through their logarithms takes their
    place, as in simple Good-Turing estimation. Where even that does not fall steeply enough, or too few
    are known, all counts are lowered by n_1 / (n_1 + 2 n_2), kept between 0.1 and 0.9.
    """
    n = [0.0, *map(float, times)]
    known = [r for r in range(1, K + 2) if n[r]]
    if len(known) == K + 1 and (ratios := _katz_ratios(n)):
        return Discount(tuple(ratios), HIGH_DISCOUNT)
    if len(known) > 2:
        slope, level = np.polyfit(np.log(known), [np.log(n[r]) for r in known], 1)
        ratios = _katz_ratios([0.0, *(float(np.exp(level + slope * np.log(r))) for r in range(1, K + 2))])
        if ratios:
            return Discount(tuple(ratios), HIGH_DISCOUNT)
    b = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]))) if n[1] + n[2] else 0.5
    return Discount(tuple((r - b) / r for r in range(1, K + 1)), b)


@dataclass(frozen=True)
class Unigrams:
    """All tokens, distinct ones, and what turns a count into a probability; unknown words share one."""

    tokens: int
    distinct: int
    discount: Discount
    unknown: float

    def probability(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.discount(count) / max(self.tokens, 1), self.unknown)


def _blocks(df: DataFrame, key: str, text: str, held: str, block_bytes: int) -> DataFrame:
    """Blocks of whole texts: ids, the sorted hashes of their words, counts in training texts, and all tokens."""

    def block(ids: list, held: list, sizes: list, tokens: list) -> pa.RecordBatch:
        size, token = np.concatenate(sizes), np.concatenate(tokens)
        words, number = np.unique(token, return_inverse=True)
        trains = np.repeat(~np.array(held, bool), size)
        return pa.RecordBatch.from_pydict({
            "block": pa.array([uuid.uuid4().int >> 65], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
            "held": pa.array([held], pa.list_(pa.bool_())), "words": pa.array([words.tobytes()], pa.binary()),
            "counts": pa.array([_pack(np.bincount(number[trains], minlength=len(words)))], pa.binary()),
            "sizes": pa.array([_pack(size)], pa.binary()), "tokens": pa.array([_pack(number)], pa.binary()),
        })

    def build(batches: Iterator[pa.RecordBatch]):
        ids, held, sizes, tokens, total = [], [], [], [], 0
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(2), min(PIECE_BYTES, block_bytes)):
                word, row = word_hashes(data, offsets)
                rows = high - low
                token = np.full(len(word) + rows, END)
                token[np.arange(len(word)) + row] = word
                ids += batch.column(0).slice(low, rows).to_pylist()
                held += batch.column(1).slice(low, rows).to_pylist()
                sizes.append(np.bincount(row, minlength=rows) + 1)
                tokens.append(token)
                total += len(data)
                if total >= block_bytes:
                    yield block(ids, held, sizes, tokens)
                    ids, held, sizes, tokens, total = [], [], [], [], 0
        if ids:
            yield block(ids, held, sizes, tokens)

    rows = df.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(held), F.lit(False)).alias("held"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(build, "block long, ids array<long>, held array<boolean>, words binary, counts binary, sizes binary, tokens binary")


def _cuts(words: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range begins among sorted hashes, and the end."""
    return np.append(np.searchsorted(words, [np.uint64(((1 << 64) * i) // ranges) for i in range(ranges)]), len(words))


def _word_requests(blocks: DataFrame, ranges: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block, words, counts in _rows(batch):
                words, counts = np.frombuffer(words, np.uint64), _unpack(counts)
                cut = _cuts(words, ranges)
                full = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_pydict({
                    "part": full, "block": np.full(len(full), block),
                    "words": pa.array([words[cut[i] : cut[i + 1]].tobytes() for i in full], pa.binary()),
                    "counts": pa.array([_pack(counts[cut[i] : cut[i + 1]]) for i in full], pa.binary()),
                })

    return blocks.select("block", "words", "counts").mapInArrow(ask, "part long, block long, words binary, counts binary")


def _merge_words(group: pa.Table) -> pa.Table:
    """A reply per request: the words' counts and their numbers, range and place in it. In a row without block, how many words
    occur once, twice, ..., all tokens and distinct words."""
    words = [np.frombuffer(w, np.uint64) for w in group["words"].to_pylist()]
    counts = np.concatenate([_unpack(c) for c in group["counts"].to_pylist()])
    known, place = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(place, counts, len(known)).astype(np.int64)
    cut = np.cumsum([len(w) for w in words])[:-1]
    times = [*np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1 : K + 2], total.sum(), (total > 0).sum()]
    part = group["part"][0].as_py()
    return pa.table({
        "block": pa.array([*group["block"].to_pylist(), None], pa.int64()), "part": pa.array([part] * (len(words) + 1), pa.int64()),
        "counts": pa.array([*map(_pack, np.split(total[place], cut)), None], pa.binary()),
        "places": pa.array([*map(_pack, np.split(place + (part << 32) + 1, cut)), None], pa.binary()),
        "times": pa.array([*[None] * len(words), [int(t) for t in times]], pa.list_(pa.int64())),
    })


def _gathered(replies: DataFrame, name: str, *columns: str) -> DataFrame:
    """The replies to a block in one row, by part."""
    rows = replies.where("block is not null").groupBy("block")
    return rows.agg(F.sort_array(F.collect_list(F.struct("part", *columns))).alias(name))


@dataclass
class Block:
    """A block's texts with the counts of its words."""

    words: np.ndarray  # hashes, that of the start last
    ids: np.ndarray  # range and place in it from 1, the same in all blocks and shorter than a hash once packed; 0 is the start
    counts: np.ndarray  # in training texts; of the start, how many these are
    history: np.ndarray  # by token
    token: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, words: bytes, sizes: bytes, tokens: bytes, replies: list[dict]) -> Block:
        words = np.append(np.frombuffer(words, np.uint64), START)
        ids = np.concatenate([_unpack(r["places"]) for r in replies])
        counts = np.concatenate([_unpack(r["counts"]) for r in replies])
        counts = np.append(counts, counts[np.searchsorted(words[:-1], END)])
        sizes, token = _unpack(sizes), _unpack(tokens).astype(np.int32)
        history = np.append(np.int32(len(words) - 1), token[:-1])
        history[np.cumsum(sizes)[:-1]] = len(words) - 1
        return cls(words, np.append(ids, 0), counts, history, token, sizes)

    def pairs(self, ranges: int) -> tuple[np.ndarray, ...]:
        """History and word of the distinct bigrams by part, which of them each token is, and where the parts begin.

        A history's bigrams are dealt to parts by its hash, those of a frequent one by the word too.
        """
        wide = len(self.words)
        pair, place = _distinct(self.history * np.int64(wide) + self.token)
        history, word = (x.astype(np.int32) for x in np.divmod(pair, wide))
        del pair
        slices = (1 + self.counts // HISTORY_SLICE).astype(np.uint64)[history]
        spread = mix(self.words[history] + self.words[word] % slices * _ODD)
        part = (spread % np.uint64(ranges)).astype(np.uint16 if ranges <= 1 << 16 else np.uint32)
        del slices, spread
        order = np.argsort(part, kind="stable")
        back = np.empty(len(order), np.int32)
        back[order] = np.arange(len(order), dtype=np.int32)
        cut = np.append(0, np.cumsum(np.bincount(part, minlength=ranges)))
        return history[order], word[order], back[place], cut


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, and which of them each is; in less memory than `np.unique`."""
    order = np.argsort(x)
    x = x[order]
    new = np.append(np.ones(min(1, len(x)), bool), x[1:] != x[:-1])
    place = np.empty(len(x), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return x[new], place


#: Of a request: its heads' ids, counts in training texts and numbers of bigrams; its bigrams' words, these words' counts, and theirs.
HEAD, PAIR = (ID, COUNT, LENGTH), (ID, COUNT, COUNT)
PAIRS = "pairs binary"


def _pack_pairs(history: np.ndarray, of_history: np.ndarray, word: np.ndarray, count: np.ndarray, seen: np.ndarray, cut: np.ndarray) -> Iterator[bytes]:
    """Requests of the bigrams from each cut to the next, those of a history side by side."""
    new = np.append(True, history[1:] != history[:-1])
    new[cut[:-1][cut[:-1] < len(new)]] = True
    first = np.flatnonzero(new)
    heads = [_planes(x, w) for x, w in zip((history[first], of_history[first], np.diff(np.append(first, len(history)))), HEAD)]
    pairs = [_planes(x, w) for x, w in zip((word, count, seen), PAIR)]
    compress = _zstd()[0].compress
    bounds = np.searchsorted(first, cut)
    for a, b, c, d in zip(cut[:-1].tolist(), cut[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
        yield compress(b"".join([(d - c).to_bytes(4, "little"), *(x[:, c:d].tobytes() for x in heads), *(x[:, a:b].tobytes() for x in pairs)]))


def _unpack_pairs(requests: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Ids, counts and lengths of all heads, and words, counts and training counts of all bigrams; where each request's heads and
    bigrams begin, and the end."""
    fields, sizes = [[] for _ in (*HEAD, *PAIR)], []
    for request in requests:
        data = np.frombuffer(_zstd()[1].decompress(request), np.uint8)
        heads = int.from_bytes(data[:4].tobytes(), "little")
        pairs, low = (len(data) - 4 - heads * sum(HEAD)) // sum(PAIR), 4
        sizes.append((heads, pairs))
        for field, width, n in zip(fields, (*HEAD, *PAIR), (heads,) * 3 + (pairs,) * 3):
            field.append(data[low : low + width * n].reshape(width, n))
            low += width * n
    out = []
    for i in range(len(fields)):
        out.append(_numbers(np.concatenate(fields[i], axis=1)))
        fields[i] = None
    of_heads, of_pairs = (np.append(0, np.cumsum(x)) for x in zip(*sizes))
    return out[:3], out[3:], of_heads, of_pairs


def _pair_requests(joined: DataFrame, ranges: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for number, held, words, sizes, tokens, replies in _rows(batch):
                block = Block.of(words, sizes, tokens, replies)
                history, word, place, cut = block.pairs(ranges)
                seen = np.bincount(place[np.repeat(~np.array(held, bool), block.sizes)], minlength=len(word))
                ids, counts = block.ids, block.counts
                del block, place, words, tokens, replies
                full = np.flatnonzero(np.diff(cut))
                requests = _pack_pairs(ids[history], counts[history], ids[word], counts[word], seen, np.append(cut[full], len(word)))
                yield pa.RecordBatch.from_pydict({"part": full, "block": np.full(len(full), number), "pairs": pa.array(requests, pa.binary())})

    return joined.select("block", "held", "words", "sizes", "tokens", "word_replies").mapInArrow(ask, f"part long, block long, {PAIRS}")


_HISTORY = pa.struct([("h", pa.int64()), *((f"n{r}", pa.int64()) for r in range(1, K + 1)), ("big", pa.int64()), ("many", pa.int64()), ("p1", pa.float64())])


def _pair_merger(unigrams: Unigrams):
    def merge(group: pa.Table) -> pa.Table:
        """A reply per request with the histories whose backoff weight it needs; in a row without block what
        those histories' continuations add up to, and how many bigrams occur once, twice, ..."""
        (heads, head_counts, lengths), (words, word_counts, seen), of_heads, cut = _unpack_pairs(group["pairs"].to_pylist())
        number = len(cut) - 1
        history, of_history = np.repeat(heads, lengths), np.repeat(head_counts, lengths)
        key = mix(mix(history.view(np.uint64)) + words.view(np.uint64) * _ODD)
        del words
        key, place = _distinct(key)
        first = np.empty(len(key), np.int64)
        first[place] = np.arange(len(place))
        del key
        total = np.bincount(place, seen, len(first)).astype(np.int64)
        del seen
        count = total[place]
        del place
        open_ = (count == 0) & (of_history > 0)
        # Bigrams of a history lie side by side in a request, so a head is needed where one of them is open.
        needed = np.add.reduceat(open_, np.cumsum(lengths) - lengths, dtype=np.int64) > 0
        need = pa.ListArray.from_arrays(pa.array(np.append(np.append(0, np.cumsum(needed))[of_heads], needed.sum()), pa.int32()), pa.array(heads[needed]))

        own, known = np.unique(history, return_inverse=True)
        told = np.zeros(len(own), bool)
        told[known[open_ | (of_history >= HISTORY_SLICE)]] = True
        there = total > 0
        known, count_of, p1 = known[first][there], total[there], unigrams.probability(word_counts[first][there])
        sums = [np.bincount(known, count_of == r, len(own)) for r in range(1, K + 1)]
        sums += [np.bincount(known, np.where(count_of > K, x, 0), len(own)) for x in (count_of, 1)]
        fields = [pa.array(own[told]), *(pa.array(s[told].astype(np.int64)) for s in sums), pa.array(np.bincount(known, p1, len(own)).astype(float)[told])]
        table = pa.StructArray.from_arrays(fields, fields=list(_HISTORY))
        histories = pa.ListArray.from_arrays(pa.array([0] * (number + 1) + [len(table)], pa.int32()), table)
        times = [int(t) for t in np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1 : K + 2]]
        return pa.table({
            "block": pa.array([*group["block"].to_pylist(), None], pa.int64()), "part": pa.array([group["part"][0].as_py()] * (number + 1), pa.int64()),
            "counts": pa.array([*_pack_all(count, cut), None], pa.binary()), "need": need, "histories": histories,
            "times": pa.array([*[None] * number, times], pa.list_(pa.int64())),
        })

    return merge


@dataclass(frozen=True)
class _Kind:
    """How requests of a kind are merged, and folded where too many would meet."""

    payload: str  # columns of a request besides part and block
    reply: str
    merge: Callable[[pa.Table], pa.Table]
    fold: Callable[[list[dict]], tuple[dict, list[np.ndarray]]]  # requests of one range to their union and each one's places in it
    split: Callable[[dict, int, int], Iterator[tuple[int, dict]]]  # a union by so many ranges within its range, in its order
    answer: Callable[[dict, list[dict], int, int], Callable[[np.ndarray], dict]]  # from a union and the replies to it in order, a member's reply by its places


def _replies(requests: DataFrame, nodes: int, ranges: int, kind: _Kind, fan: int, label: str) -> DataFrame:
    """The replies to the requests of so many blocks, merged by range.

    Up to `fan` blocks meet in their ranges. Of more, about `fan` at a time are folded into one by range, and the
    unions ask in their stead, each in as many ranges within every range as there are unions, `fan` at most; the replies to a
    union are then handed down to its members. So a block makes as many requests as the first height has ranges, a union at most
    `fan` for each of its ranges, and no task gets more than about `fan` of them, however many blocks there are. A union
    is opened once for all its members.
    """
    if nodes <= fan:
        return stored(requests.groupBy("part").applyInArrow(kind.merge, kind.reply), label)
    above = -(-nodes // fan)
    subs = min(fan, above)
    met = requests.withColumn("above", F.pmod(F.xxhash64(F.lit(ranges), "block"), F.lit(above)))

    def fold(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        union, places = kind.fold(rows)
        where = {"above": rows[0]["above"], "part": rows[0]["part"]}
        held = [{**where, "block": r["block"], "places": _pack(p)} for r, p in zip(rows, places)]
        return pa.Table.from_pylist([*held, {**where, **union}], schema=folded_schema)

    columns = ["above", "part", "block", "places", *(c.split()[0] for c in kind.payload.split(", "))]
    folded_schema = pa.schema([(c, pa.int64() if c in ("above", "part", "block") else pa.binary()) for c in columns])
    folded = stored(met.groupBy("above", "part").applyInArrow(fold, f"above long, part long, block long, places binary, {kind.payload}"), f"{label}-folded")

    def split(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for union in batch.to_pylist():
                for sub, request in kind.split(union, ranges, subs):
                    yield pa.RecordBatch.from_pylist([{"part": union["part"] * subs + sub, "block": union["above"], **request}], schema=request_schema)

    request_schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), *((c, pa.binary()) for c in columns[4:])])
    asked = folded.where("block is null").mapInArrow(split, f"part long, block long, {kind.payload}")
    told = _replies(asked, above, ranges * subs, kind, fan, f"{label}-above")

    def hand_down(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, replies = left.to_pylist(), sorted(right.to_pylist(), key=lambda r: r["sub"])
        answer = kind.answer(next(r for r in rows if r["block"] is None), replies, ranges, subs)
        out = [{"block": r["block"], "part": r["part"], **answer(_unpack(r["places"]))} for r in rows if r["block"] is not None]
        return pa.Table.from_arrays([pa.array([r.get(f.name) for r in out], f.type) for f in reply_schema], schema=reply_schema)

    reply_schema = to_arrow_schema(T.StructType.fromDDL(kind.reply))
    there = told.where("block is not null").withColumnsRenamed({"block": "above", "part": "sub"}).withColumn("part", F.expr(f"sub div {subs}"))
    down = folded.groupBy("above", "part").cogroup(there.groupBy("above", "part")).applyInArrow(hand_down, kind.reply)
    return stored(down.unionByName(told.where("block is null")), label)


def _word_kind(reply: str) -> _Kind:
    def fold(rows: list[dict]) -> tuple[dict, list[np.ndarray]]:
        words = [np.frombuffer(r["words"], np.uint64) for r in rows]
        known, place = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(place, np.concatenate([_unpack(r["counts"]) for r in rows]), len(known)).astype(np.int64)
        return {"words": known.tobytes(), "counts": _pack(total)}, np.split(place, np.cumsum([len(w) for w in words])[:-1])

    def split(union: dict, ranges: int, subs: int) -> Iterator[tuple[int, dict]]:
        words, counts = np.frombuffer(union["words"], np.uint64), _unpack(union["counts"])
        first = union["part"] * subs
        edges = [np.uint64(((1 << 64) * (first + i)) // (ranges * subs)) for i in range(subs)]
        cut = np.append(np.searchsorted(words, edges), len(words))
        for i in np.flatnonzero(np.diff(cut)):
            own = slice(cut[i], cut[i + 1])
            yield int(i), {"words": words[own].tobytes(), "counts": _pack(counts[own])}

    def answer(union: dict, replies: list[dict], ranges: int, subs: int) -> Callable[[np.ndarray], dict]:
        whole = {c: np.concatenate([_unpack(r[c]) for r in replies]) for c in ("counts", "places")}
        return lambda places: {c: _pack(x[places]) for c, x in whole.items()}

    return _Kind("words binary, counts binary", reply, _merge_words, fold, split, answer)


def _wide(requests: list[dict]) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """History, its count, word, its count and training count of each bigram of all requests; where each request begins, and the end."""
    (heads, head_counts, lengths), pairs, _, cut = _unpack_pairs([r["pairs"] for r in requests])
    return (np.repeat(heads, lengths), np.repeat(head_counts, lengths), *pairs), cut


def _sub_range(history: np.ndarray, of_history: np.ndarray, word: np.ndarray, ranges: int, subs: int) -> np.ndarray:
    """A history's range within its range, by another hash at each height; of a frequent one by the word too."""
    slices = (1 + of_history // HISTORY_SLICE).astype(np.uint64)
    spread = mix(mix(history.view(np.uint64) ^ np.uint64(ranges)) + mix(word.view(np.uint64)) % slices * _ODD)
    return (spread % np.uint64(subs)).astype(np.int64)


def _pair_kind(unigrams: Unigrams, reply: str) -> _Kind:
    def ordered(wide: tuple[np.ndarray, ...], ranges: int, subs: int) -> tuple[np.ndarray, np.ndarray]:
        sub = _sub_range(wide[0], wide[1], wide[2], ranges, subs)
        return np.lexsort((wide[2], wide[0], sub)), sub

    def fold(rows: list[dict]) -> tuple[dict, list[np.ndarray]]:
        (history, of_history, word, count, seen), cut = _wide(rows)
        order = np.lexsort((word, history))
        new = np.append(True, (history[order][1:] != history[order][:-1]) | (word[order][1:] != word[order][:-1]))
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        first = order[new]
        total = np.bincount(place, seen, len(first)).astype(np.int64)
        union = _pack_pairs(history[first], of_history[first], word[first], count[first], total, np.array([0, len(first)]))
        return {"pairs": next(union)}, np.split(place, cut[1:-1])

    def split(union: dict, ranges: int, subs: int) -> Iterator[tuple[int, dict]]:
        wide, _ = _wide([union])
        order, sub = ordered(wide, ranges, subs)
        cut = np.searchsorted(sub[order], np.arange(subs + 1))
        full = np.flatnonzero(np.diff(cut))
        for i, request in zip(full, _pack_pairs(*(x[order] for x in wide), np.append(cut[full], len(order)))):
            yield int(i), {"pairs": request}

    def answer(union: dict, replies: list[dict], ranges: int, subs: int) -> Callable[[np.ndarray], dict]:
        wide, _ = _wide([union])
        history, of_history = wide[:2]
        count = np.empty(len(history), np.int64)
        count[ordered(wide, ranges, subs)[0]] = _unpack_all([r["counts"] for r in replies])
        open_ = (count == 0) & (of_history > 0)
        return lambda places: {"counts": _pack_all(count[places], np.array([0, len(places)]))[0], "need": np.unique(history[places[open_[places]]])}

    return _Kind(PAIRS, reply, _pair_merger(unigrams), fold, split, answer)


def _totals(replies: DataFrame, size: int) -> list[int]:
    """The parts' statistics added up: one short row."""
    row = replies.where("block is null").agg(*(F.sum(F.col("times")[i]) for i in range(size))).first()
    return [int(x or 0) for x in row]


def backoff_weights(histories: DataFrame, discount: Discount) -> DataFrame:
    """(h, alpha): what the seen continuations of a history leave, by the unigram probability of all others."""
    counts = [f"n{r}" for r in range(1, K + 1)]
    merged = histories.groupBy("h").agg(*(F.sum(c).alias(c) for c in (*counts, "big", "many", "p1")))
    tokens = sum((r * F.col(c) for r, c in enumerate(counts, 1)), F.col("big"))
    held = sum((F.lit(r * d) * F.col(c) for r, (d, c) in enumerate(zip(discount.ratios, counts), 1)), F.col("big") - discount.high * F.col("many"))
    return merged.where(tokens > 0).select("h", ((1 - held / tokens) / (1 - F.col("p1"))).alias("alpha"))


def _scores(joined: DataFrame, ranges: int, unigrams: Unigrams, discount: Discount) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for ids, held, words, sizes, tokens, word_replies, pair_replies, weights in _rows(batch):
                block = Block.of(words, sizes, tokens, word_replies)
                del words, tokens, word_replies
                history, word, place, _ = block.pairs(ranges)
                alpha = np.ones(len(block.words))
                if weights is not None and len(weights):
                    by_id = np.argsort(block.ids)
                    at = np.searchsorted(block.ids[by_id], weights.field("h").to_numpy(zero_copy_only=False))
                    alpha[by_id[at]] = weights.field("alpha").to_numpy(zero_copy_only=False)
                count = _unpack_all([r["counts"] for r in pair_replies])
                del pair_replies, weights
                seen = np.flatnonzero(count)
                # By bigram: what is seen by its own count, all else by backoff.
                log_p = alpha[history] * unigrams.probability(block.counts)[word]
                log_p[seen] = discount(count[seen]) / block.counts[history[seen]]
                del history, word, count, seen
                with np.errstate(divide="ignore"):
                    np.log10(log_p, out=log_p)
                base = np.log10((block.counts + 1) / (unigrams.tokens + unigrams.distinct + 1))
                row = np.repeat(np.arange(len(block.sizes)), block.sizes)
                by_row = lambda x: np.bincount(row, x, len(block.sizes))
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()), "n_tokens": block.sizes.astype(np.int64),
                    "n_known": by_row((block.counts > 0)[block.token]).astype(np.int64), "base_score": by_row(base[block.token]), "score": by_row(log_p[place]),
                })

    columns = joined.select("ids", "held", "words", "sizes", "tokens", "word_replies", "pair_replies", "weights")
    return columns.mapInArrow(build, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def katz_scores(df: DataFrame, key: str, text: str, held_out: str, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row's whole text.

    Tokens are the words of a text (runs other than 0x20 and 0x09-0x0D, A-Z lower-cased) and one end. The
    model learns from all rows where the boolean `held_out` is not true. With c the training counts, a
    word after a known history has the probability d(c(h, w)) / c(h) where c(h, w) > 0 and
    alpha(h) P(w) elsewhere; after an unknown history, P(w). P(w) = d(c(w)) / N for known words, and one
    class of unknown words has the rest. The history of the first word is the start of the text.
    Discounts are Good-Turing's up to counts of 5, see `good_turing`; alpha(h) is exactly what makes the
    words and the unknown class after h sum to 1. `score` is the log10 probability of the text,
    `base_score` that of a unigram model with add-one smoothing.

    Null and empty texts are one end. Null keys stay null, repeated rows are scored each and count each.
    Without training rows every token is unknown and scores 0.

    Blocks are written once, in buckets of at most about 32 MB of text, so each later step only shuffles requests and
    replies to them. Requests are merged within hash ranges, `fan` of a block at most; more blocks than that fold into
    unions, which ask in finer ranges (`_replies`), so rows grow with the blocks and not with their
    square. `block_bytes` of text make a block; up to `fan` requests meet in a task. A history with many tokens is dealt to several ranges. Backoff weights are looked up only for histories that
    stand before an unseen word.
    """
    spark = df.sparkSession
    name = f"katz_blocks_{uuid.uuid4().hex}"
    size = df.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    # With fewer buckets than shuffles have partitions, Spark would shuffle the blocks for every join.
    buckets = max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    place, batch = scratch_path(spark, "katz-blocks"), spark.conf.get(BATCH_OPTION)
    # Bucketing needs a catalog table; its files lie in the shared folder, and it goes whatever happens.
    try:
        _blocks(df, key, text, held_out, block_bytes).write.bucketBy(buckets, "block").format("parquet").option("path", place).saveAsTable(name)
        spark.conf.set(BATCH_OPTION, BATCH_BLOCKS)
        return _scored(spark.table(name), key, fan)
    finally:
        spark.conf.set(BATCH_OPTION, batch)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(spark, place)


def _scored(blocks: DataFrame, key: str, fan: int) -> DataFrame:
    """The result from stored blocks, itself stored."""
    number = blocks.count()
    word_ranges = min(fan, max(LEAST_RANGES, number // BLOCKS_PER_WORD_RANGE))
    pair_ranges = min(fan, max(LEAST_RANGES, number // BLOCKS_PER_PAIR_RANGE))

    reply = "block long, part long, counts binary, places binary, times array<long>"
    words = _replies(_word_requests(blocks, word_ranges), number, word_ranges, _word_kind(reply), fan, "katz-words")
    times = _totals(words, K + 3)
    discount = good_turing(times[: K + 1])
    tokens, distinct = times[K + 1 :]
    low = sum(r * d * n for r, (d, n) in enumerate(zip(discount.ratios, times), 1))
    high = tokens - sum(r * n for r, n in enumerate(times[:K], 1))
    many = distinct - sum(times[:K])
    unknown = 1 - (low + high - discount.high * many) / tokens if tokens else 1.0
    unigrams = Unigrams(tokens, distinct, discount, unknown)

    known = blocks.join(_gathered(words, "word_replies", "counts", "places").hint("merge"), "block")
    fields = ", ".join(f"{f.name}: {'double' if f.name == 'p1' else 'long'}" for f in _HISTORY)
    reply = f"block long, part long, counts binary, need array<long>, histories array<struct<{fields}>>, times array<long>"
    pairs = _replies(_pair_requests(known, pair_ranges), number, pair_ranges, _pair_kind(unigrams, reply), fan, "katz-pairs")
    discount = good_turing(_totals(pairs, K + 1))
    weights = stored(backoff_weights(pairs.where("block is null").select(F.inline("histories")), discount), "katz-weights")
    need = pairs.where("block is not null").select("block", F.explode("need").alias("h")).distinct()
    found = need.join(weights.hint("merge"), "h").groupBy("block").agg(F.collect_list(F.struct("h", "alpha")).alias("weights"))
    ready = known.join(_gathered(pairs, "pair_replies", "counts").hint("merge"), "block").join(found.hint("merge"), "block", "left")
    scored = stored(_scores(ready, pair_ranges, unigrams, discount), "katz-scores")
    return scored.select(
        F.col("id").alias(key), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )

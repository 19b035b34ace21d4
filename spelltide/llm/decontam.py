"""Benchmark decontamination: a BM25 index of the test items, asked with every passage of every text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spelltide.llm.scratch import extended, placed, stored, unused
from spelltide.llm.words import mix, pieces, run_hashes, utf8

K1, B = 1.2, 0.75
#: Words of an index entry at most; a longer item has several entries. A passage has twice as many and
#: starts every so many words, so every copy of an entry lies whole in one passage.
ENTRY_WORDS = 64
BLOCK = 4
#: Least share of an entry's own BM25 score that a passage must reach.
THRESHOLD = 0.5
#: Least shares of the question's and of the answer's word trigrams that must stand around the passage.
QUESTION_SHARE = ANSWER_SHARE = 0.6
#: Text of the items that are indexed and broadcast together; more items are asked block after block.
INDEX_BYTES = 16 << 20
GRAM = 3
SIEVE_BITS = 18

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
LEAKS = "array<struct<item_id: long, score: double, question_overlap: double, answer_overlap: double>>"


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of the runs of letters and digits of lower-cased texts."""
    return run_hashes(data, offsets, _LETTER)


def grams(tokens: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hashes of the word n-grams; of fewer words, the whole sequence as one."""
    if not len(tokens):
        return tokens
    size = min(size, len(tokens))
    total = np.zeros(len(tokens) - size + 1, np.uint64)
    for i in range(size):
        total = mix(total + tokens[i : len(tokens) - size + 1 + i])
    return total


def question_and_answer(text: str) -> tuple[str, str]:
    """Split an item after its last question mark, else before its last sentence; one sentence is all question."""
    at = text.rfind("?") + 1
    if not at or not text[at:].strip():
        ends = [m.end() for m in re.finditer(r"[.!?][\s]+", text.rstrip())]
        at = ends[-1] if ends else len(text)
    return text[:at], text[at:]


@dataclass
class Index:
    """Entries' impacts by term, in blocks of entries. Terms are numbered by rising largest impact.

    An impact is the BM25 weight divided by the entry's own score, so an entry's copy scores 1.
    """

    threshold: float
    hashes: np.ndarray  # sorted
    sieve: np.ndarray  # whether any term's hash begins with these bits
    term: np.ndarray  # number of the term with that hash
    most: np.ndarray  # largest impact, by term
    rare: np.ndarray  # whether a term is none of the common ones
    spare: float  # what the common terms give any entry at most
    lists: np.ndarray  # first block list of a term
    listed: np.ndarray  # term and block of each block list, as one number
    block: np.ndarray  # block of each block list
    block_most: np.ndarray  # largest impact in the block list
    postings: np.ndarray  # first posting of each block list
    entry: np.ndarray
    impact: np.ndarray
    blocks: int
    item: np.ndarray  # place of the item, by entry
    sides: list  # item id, question and answer, by place; a side is (n-grams, their size)


def _entries(items: list[tuple[int, str]]) -> tuple[list[int], list[np.ndarray]]:
    owner, found = [], []
    tokens, row = token_hashes(*utf8(pa.array([t or "" for _, t in items], pa.string())))
    cut = np.searchsorted(row, np.arange(1, len(items)))
    for item, own in enumerate(np.split(tokens, cut) if items else []):
        for part in np.array_split(own, -(-len(own) // ENTRY_WORDS)) if len(own) else []:
            owner.append(item)
            found.append(part)
    return owner, found


def build_index(
    items: list[tuple[int, str]], total: int, mean_length: float, frequency: dict[int, int], threshold: float = THRESHOLD
) -> Index | None:
    """Index lower-cased items. `total`, `mean_length` and `frequency` (entries by term) are of all items."""
    owner, entries = _entries(items)
    if not entries:
        return None
    entry = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
    vocabulary, term = np.unique(np.concatenate(entries), return_inverse=True)
    key, tf = np.unique(term * len(entries) + entry, return_counts=True)
    term, entry = key // len(entries), key % len(entries)
    df = np.array([frequency[int(h)] for h in vocabulary], float)
    idf = np.log1p((total - df + 0.5) / (df + 0.5))
    length = np.array([len(e) for e in entries], float)
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[entry] / mean_length))
    impact /= np.bincount(entry, impact, len(entries))[entry]
    most = np.zeros(len(vocabulary))
    np.maximum.at(most, term, impact)
    number = np.empty(len(vocabulary), np.int64)
    number[np.argsort(most, kind="stable")] = np.arange(len(vocabulary))
    order = np.lexsort((entry, number[term]))
    term, entry, impact = number[term][order], entry[order], impact[order]
    blocks = -(-len(entries) // BLOCK)
    listed, first = np.unique(term * blocks + entry // BLOCK, return_index=True)
    lists = np.searchsorted(listed, np.arange(len(vocabulary) + 1) * blocks)
    # Common terms: as many of the most frequent ones as give no entry more than half of the threshold.
    by_df = np.empty(len(vocabulary), np.int64)
    by_df[number] = np.argsort(np.argsort(-df, kind="stable"), kind="stable")
    spread = np.lexsort((by_df[term], entry))
    running = np.cumsum(impact[spread])
    heads = np.flatnonzero(np.append(True, entry[spread][1:] != entry[spread][:-1]))
    running -= np.repeat(np.append(0, running)[heads], np.diff(np.append(heads, len(spread))))
    too_much = running > threshold / 2
    common = by_df < (by_df[term[spread]][too_much].min() if too_much.any() else len(vocabulary))
    spare = np.bincount(entry, np.where(common[term], impact, 0), len(entries)).max()
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    sieve[vocabulary >> np.uint64(64 - SIEVE_BITS)] = True
    sides = []
    for item, text in items:
        parts = [token_hashes(*utf8(pa.array([part])))[0] for part in question_and_answer(text or "")]
        sides.append((item, *((np.unique(grams(p)), max(1, min(GRAM, len(p)))) for p in parts)))
    return Index(
        threshold, vocabulary, sieve, number, np.sort(most), ~common, float(spare), lists, listed, listed % blocks,
        np.maximum.reduceat(impact, first), np.append(first, len(entry)), entry, impact, blocks, np.array(owner, np.int64), sides,
    )


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, member) of every member of the ranges first..last."""
    size = last - first
    which = np.repeat(np.arange(len(first)), size)
    return which, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[which]


def _terms(index: Index, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and terms of the tokens that occur in the index."""
    maybe = np.flatnonzero(index.sieve[tokens >> np.uint64(64 - SIEVE_BITS)])
    at = np.searchsorted(index.hashes, tokens[maybe])
    known = index.hashes[np.minimum(at, len(index.hashes) - 1)] == tokens[maybe]
    return maybe[known], index.term[at[known]]


def retrieve(index: Index, tokens: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first token of the passage, entry, score) of all passages and entries that reach the threshold.

    Block-max WAND for many passages at once; as the threshold is fixed, pivots need no heap. What the
    common terms can give any entry is known (`index.spare`), so the other terms must bring the rest.
    Among those of a passage, by rising largest impact, the ones before the sum reaches what is needed
    cannot carry an entry, so a block needs a later one, the pivot or beyond. Blocks are scored only
    where the largest impacts of the passage's terms in the block are enough too.
    """
    none = np.zeros(0, np.int64)
    empty = none, none, none, np.zeros(0)
    known, term = _terms(index, tokens)
    rare = index.rare[term]
    spot, rare_term = known[rare], term[rare]
    if not len(spot):
        return empty
    rows = int(row[-1]) + 1
    first = np.searchsorted(row, np.arange(rows + 1))
    passages = np.maximum(1, -(-np.diff(first) // ENTRY_WORDS) - 1)
    base = np.cumsum(passages) - passages
    own = row[spot]
    step = (spot - first[own]) // ENTRY_WORDS
    later, sooner = step < passages[own], step > 0
    passage = np.concatenate([(base[own] + step)[later], (base[own] + step - 1)[sooner]])
    each = np.concatenate([rare_term[later], rare_term[sooner]])
    need = index.threshold - index.spare - 1e-9
    keep = (np.bincount(passage, index.most[each], passages.sum()) >= need)[passage]
    pair = _distinct(passage[keep] * len(index.most) + each[keep])
    passage, each = pair // len(index.most), pair % len(index.most)
    if not len(pair):
        return empty
    begin = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(passage))))
    total = np.concatenate([[0.0], np.cumsum(index.most[each])])
    carrying = total[1:] - total[begin][group] >= need

    which, place = _expand(index.lists[each], index.lists[each + 1])
    visited, slot = np.unique(group[which] * index.blocks + index.block[place], return_inverse=True)
    bound = np.bincount(slot, index.block_most[place], len(visited))
    led = np.bincount(slot, carrying[which], len(visited)) > 0
    visited = visited[(bound >= need) & led]
    if not len(visited):
        return empty
    passage, block = passage[begin[visited // index.blocks]], visited % index.blocks

    of = np.searchsorted(base, passage, "right") - 1
    start = first[of] + (passage - base[of]) * ENTRY_WORDS
    low, high = np.searchsorted(known, [start, np.minimum(start + 2 * ENTRY_WORDS, first[of + 1])])
    which, place = _expand(low, high)
    pair = _distinct(which * len(index.most) + term[place])
    which, each = pair // len(index.most), pair % len(index.most)
    key = each * index.blocks + block[which]
    at = np.searchsorted(index.listed, key)
    there = index.listed[np.minimum(at, len(index.listed) - 1)] == key
    which, at = which[there], at[there]
    part, place = _expand(index.postings[at], index.postings[at + 1])
    scored, slot = np.unique(which[part] * len(index.item) + index.entry[place], return_inverse=True)
    score = np.bincount(slot, index.impact[place], len(scored))
    hit = score >= index.threshold - 1e-9
    which = scored[hit] // len(index.item)
    return of[which], start[which], scored[hit] % len(index.item), score[hit]


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _share(side: np.ndarray, size: int, around: np.ndarray) -> float:
    """The share of a side's n-grams that stand in the words around; 1 for a side without words."""
    return float(np.isin(side, grams(around, size)).mean()) if len(side) else 1.0


def leaks(index: Index, tokens: np.ndarray, row: np.ndarray, rows: int, shares: tuple[float, float]) -> list[list[dict]]:
    """Per row the items whose question and answer stand around a passage that was retrieved for them."""
    out: list[list[dict]] = [[] for _ in range(rows)]
    best: dict[tuple[int, int], list] = {}
    for i, start, entry, score in zip(*(x.tolist() for x in retrieve(index, tokens, row))):
        seen = best.setdefault((i, int(index.item[entry])), [start, start, 0.0])
        seen[0], seen[1], seen[2] = min(seen[0], start), max(seen[1], start), max(seen[2], score)
    for (i, owner), (low, high, score) in sorted(best.items()):
        begin, end = np.searchsorted(row, [i, i + 1])
        around = tokens[max(begin, low - 2 * ENTRY_WORDS) : min(end, high + 4 * ENTRY_WORDS)]
        item, question, answer = index.sides[owner]
        overlap = [_share(*side, around) for side in (question, answer)]
        if overlap[0] >= shares[0] and overlap[1] >= shares[1]:
            out[i].append({"item_id": item, "score": min(score, 1.0), "question_overlap": overlap[0], "answer_overlap": overlap[1]})
    return out


def _statistics(items: DataFrame) -> tuple[int, float, DataFrame]:
    """Entries of all items, their mean length, and in how many entries each term occurs."""

    def split(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            _, entries = _entries(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
            yield pa.RecordBatch.from_pydict({
                "length": pa.array([len(e) for e in entries], pa.int64()),
                "terms": pa.array([np.unique(e).view(np.int64) for e in entries], pa.list_(pa.int64())),
            })

    entries = items.mapInArrow(split, "length long, terms array<long>")
    total, words = entries.agg(F.count(F.lit(1)), F.sum("length")).first()
    counts = entries.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return total, (words or 0) / max(total, 1), counts


def with_leaks(
    df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    threshold: float = THRESHOLD, shares: tuple[float, float] = (QUESTION_SHARE, ANSWER_SHARE), out: str = "leaks",
) -> DataFrame:
    """All columns of `df` and an array of the benchmark items that each whole text contains.

    Every text is asked in passages of 128 words that start every 64 words; words are runs of letters
    and digits of the lower-cased text. All entries that score the threshold or more are retrieved and
    then verified: of the word trigrams of the item's question and of its answer, at least the given
    shares must stand around the passages. An item without an answer part only needs its question. Null
    and empty texts, and items without words, have no leaks; items with a null id are left out; equal
    items are all reported.

    Documents are not shuffled. The index of up to 16 MB of item text is broadcast; a larger benchmark
    is indexed in blocks by hash of its id, each asked with all documents, with word statistics of all
    items in every block. A column that is called `out` is replaced.
    """
    df = df.drop(out)
    clean = items.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("long").alias("item"), F.lower(F.coalesce(F.col(item_text).cast("string"), F.lit(""))).alias("text")
    )
    size = clean.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // INDEX_BYTES) or 1
    total, mean_length, counts = _statistics(clean)
    if blocks > 1:
        counts = stored(counts, "leak-terms")
    spark, found = df.sparkSession, df.withColumn(out, F.expr(f"cast(array() as {LEAKS})"))
    for block in range(blocks):
        chosen = clean.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) if blocks > 1 else clean
        rows = sorted(tuple(r) for r in chosen.collect())
        wanted = counts
        if blocks > 1:
            terms = {int(h) for h in np.unique(np.concatenate([e.view(np.int64) for e in _entries(rows)[1]] or [np.zeros(0, np.int64)]))}
            wanted = counts.join(spark.createDataFrame([(t,) for t in terms], "term long"), "term", "left_semi")
        frequency = {int(np.int64(t).view(np.uint64)): n for t, n in wanted.collect()}
        index = build_index(rows, total, mean_length, frequency, threshold)
        if index is not None:
            found = _ask(found, index, text, shares, out)
    return found


def _ask(df: DataFrame, index: Index, text: str, shares: tuple[float, float], out: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(index)
    names, new = df.columns, unused("_found", df)

    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found: list[list[dict]] = []
            for low, high, data, offsets in pieces(batch.column(len(names))):
                found += leaks(shared.value, *token_hashes(data, offsets), high - low, shares)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(found, kind)], [*names, new])

    kind = pa.list_(pa.struct([("item_id", pa.int64()), *((c, pa.float64()) for c in ("score", "question_overlap", "answer_overlap"))]))
    lowered = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    asked = placed(df, lowered).mapInArrow(build, extended(df, f"{new} {LEAKS}"))
    return asked.withColumn(out, F.concat(out, new)).drop(new)

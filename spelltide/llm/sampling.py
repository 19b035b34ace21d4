"""SentencePiece segmentations sampled without replacement, and their decoding.

A text is cut where no piece of the model can reach across: before a space mark that follows another
character, and around characters that only occur alone. The lattice of a text is the chain of the
lattices of these units, so its probabilities are products of those of the units.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spelltide.llm.scratch import extended, placed, quoted
from spelltide.llm.words import mix, pieces, span_hashes

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
#: Exponent of a segmentation's weight: 1 keeps to the likeliest ones, 0 draws evenly.
SMOOTHING = 0.2
#: Text in one lattice: more would outgrow the processor's caches and need more memory, less would repeat words in fewer places.
PIECE_BYTES = 512 << 10
#: No Gumbel variate made of a 32-bit uniform number is larger.
MOST_GUMBEL = 22.9
#: Weight of a character that the model only has as bytes.
BYTE_WEIGHT = -16.0
#: Units of more characters are summed in logarithms.
LONG_UNIT = 200
#: Units of up to so many characters are summed side by side, all of a length at once.
SHORT_UNIT = 16
SPACE, MARK, PLAIN_MARK = 0x20, 0x2581, 0x110000

ENCODED = "sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double"


@dataclass
class Vocabulary:
    """A model's pieces as a trie in a hash table, with a log weight per piece."""

    size: int
    weight: np.ndarray  # by piece, then of a byte-coded character, then of no piece
    symbol: np.ndarray  # class of each code point, 0 where no piece has it
    alone: np.ndarray  # by class: in no piece of several characters
    bits: int
    table: np.ndarray  # node and class as one number, or -1
    child: np.ndarray
    first: np.ndarray  # node of each class alone, or -1
    piece: np.ndarray  # piece that ends at a node, or -1
    longest: int
    bytes_first: int
    text: np.ndarray  # UTF-8 of all pieces
    starts: np.ndarray

    def slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (len(self.table).bit_length() - 1))).astype(np.int64)

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The child of each node by a character class, or -1."""
        key = (node << self.bits) | symbol
        at = self.slots(key)
        there = self.table.take(at)
        out = np.where(there == key, self.child.take(at), -1)
        open_ = np.flatnonzero((there != key) & (there != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.table) - 1)
            there, wanted = self.table[at[open_]], key[open_]
            hit = there == wanted
            out[open_[hit]] = self.child[at[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out


def load_vocabulary(model_file: str = MODEL_FILE, smoothing: float = SMOOTHING) -> Vocabulary:
    """Read a model that keeps texts as they are, marks spaces before words and falls back on bytes.

    A BPE model ranks its pieces and has no probabilities, so pieces weigh by Zipf's law of their rank:
    p = 1 / (rank + 10), normalised. A unigram model's own log probabilities are used. Log weights are
    multiplied by `smoothing`.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    usable = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(size)]
    byte_ids = [i for i in range(size) if model.is_byte(i)]
    if len(byte_ids) != 256 or byte_ids != list(range(byte_ids[0], byte_ids[0] + 256)):
        raise ValueError("the model has no byte fallback")
    if any("▁" in names[i].lstrip("▁") for i in range(size) if usable[i]):
        raise ValueError("the model has pieces with a space inside")
    scores = np.array([model.get_score(i) for i in range(size)])
    ranked = all(s == int(s) for s in scores)
    if ranked:
        weight = 1 / (10.0 - scores)
        weight = np.log(weight / weight[usable].sum())
    else:
        weight = scores
    classes: dict[str, int] = {}
    nodes: dict[tuple[int, int], int] = {}
    ends, shared = {}, set()
    for i in range(size):
        if usable[i]:
            node = 0
            for ch in names[i]:
                node = nodes.setdefault((node, classes.setdefault(ch, len(classes) + 1)), len(nodes) + 1)
            ends[node] = i
            if len(names[i]) > 1:
                shared.update(names[i])
    symbol = np.zeros(0x110001, np.int32)
    alone = np.ones(len(classes) + 1, bool)
    for ch, k in classes.items():
        symbol[ord(ch)] = k
        alone[k] = ch not in shared
    bits = len(classes).bit_length()
    kind = np.int32 if len(nodes) + 1 < 1 << (31 - bits) else np.int64
    table = np.full(1 << (4 * len(nodes)).bit_length(), -1, kind)
    child = np.zeros(len(table), np.int32)
    texts = [n.replace("▁", " ").encode() if ok else b"" for n, ok in zip(names, usable)]
    for i in byte_ids:
        texts[i] = bytes([i - byte_ids[0]])
    found = Vocabulary(
        size, np.append(smoothing * weight, [smoothing * BYTE_WEIGHT, -np.inf]), symbol, alone, bits, table, child,
        np.array([nodes.get((0, k), -1) for k in range(len(classes) + 1)], np.int64),
        np.array([ends.get(n, -1) for n in range(len(nodes) + 1)], np.int64), max(len(n) for n, ok in zip(names, usable) if ok),
        byte_ids[0], np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]),
    )
    keys = [(a << bits) | k for a, k in nodes]
    for key, at, node in zip(keys, found.slots(np.array(keys)).tolist(), nodes.values()):
        while table[at] != -1:
            at = (at + 1) & (len(table) - 1)
        table[at], child[at] = key, node
    return found


def _stirred(x: np.ndarray, part: np.ndarray) -> np.ndarray:
    return mix(x ^ (np.atleast_1d(part).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x9E3779B97F4A7C15)))


def _seeded(seeds: np.ndarray) -> np.ndarray:
    """What all draws of a row begin with."""
    return _stirred(np.full(1, 0x243F6A8885A308D3, np.uint64), seeds)


def _uniform(seeded: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on a row's seed and a number and nothing else."""
    return ((_stirred(seeded, part) >> np.uint64(32)).astype(float) + 0.5) * 2.0**-32


def _gumbel(seeded: np.ndarray, part: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(_uniform(seeded, part)))


@lru_cache(maxsize=1)
def _odd_numbers() -> np.ndarray:
    """One odd number per code point, so that units can be hashed like the spans of bytes."""
    return mix(np.arange(PLAIN_MARK + 1, dtype=np.uint64)) | np.uint64(1)


@dataclass
class Lattice:
    """The units of some texts. Equal units share one lattice; its positions lie together, the end last.

    `edge` and `chance` give by position and length the piece and its probability, given that the
    position was reached. A character without a piece is the vocabulary's size
    plus its code point.
    """

    row: np.ndarray  # by unit
    unit_row: np.ndarray  # first unit of each row, and the end
    first: np.ndarray  # first lattice position of a unit
    last: np.ndarray  # its end
    place: np.ndarray  # first character of a unit in its text
    edge: np.ndarray
    chance: np.ndarray


def _weigh(vocabulary: Vocabulary, edge: np.ndarray, chance: np.ndarray, left: np.ndarray) -> None:
    """Make chances of the weights of edges, for units of any length; `left` is how far each position is from its unit's end.

    Ways on are summed backwards, for all positions as far from their end at once; in plain numbers for
    short units, in logarithms for long ones, where plain numbers run out.
    """
    cells, wide = edge.shape
    windows = lambda x: np.lib.stride_tricks.sliding_window_view(x, wide)
    spot = np.flatnonzero(left)
    order = spot[np.argsort(left[spot], kind="stable")]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(left[spot]))]) if len(spot) else np.zeros(1, np.int64)
    weight = vocabulary.weight.astype(np.float32)
    z = np.ones(cells + wide + 1)
    after = windows(z[1:])
    for r in range(1, min(len(bounds) - 1, LONG_UNIT + 1)):
        at = order[bounds[r] : bounds[r + 1]]
        k = min(r, wide)
        z[at] = np.einsum("ij,ij->i", chance[at, :k], after[at, :k])
    long = spot[left[spot] > LONG_UNIT]
    if len(long):
        log_z = np.log(z)
        later = windows(log_z[1:])
        for r in range(LONG_UNIT + 1, len(bounds) - 1):
            at = order[bounds[r] : bounds[r + 1]]
            if len(at):
                values = weight[edge[at]] + later[at]
                most = values.max(1)
                log_z[at] = most + np.log(np.exp(values - most[:, None]).sum(1))
    for low in range(0, cells, 1 << 16):
        part = slice(low, low + (1 << 16))
        chance[part] *= after[low : low + len(chance[part])] / z[:cells][part, None]
    if len(long):
        chance[long] = np.exp(weight[edge[long]] + later[long] - log_z[long, None])


def _chances(vocabulary: Vocabulary, edge: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The probability of each edge given its position: the edge's weight times the weights of all ways
    on from its end, as a share. Units lie by length, so those of a short one are a block."""
    cells, wide = edge.shape
    plain = np.exp(vocabulary.weight.astype(np.float32))
    chance = np.empty(edge.shape, np.float32)
    for low in range(0, cells, 1 << 14):
        chance[low : low + (1 << 14)] = plain.take(edge[low : low + (1 << 14)])
    number = np.bincount(lengths, minlength=SHORT_UNIT + 1)
    low = 0
    for size in range(1, SHORT_UNIT + 1):
        high = low + number[size] * (size + 1)
        if high > low:
            block = chance[low:high].reshape(number[size], size + 1, wide)
            z = np.ones((size + 1, number[size]))
            for i in range(size - 1, -1, -1):
                k = min(size - i, wide)
                ways = block[:, i, :k].T * z[i + 1 : i + 1 + k]
                z[i] = ways.sum(0)
                block[:, i, :k] = (ways / z[i]).T
        low = high
    if low < cells:
        rest = lengths[lengths > SHORT_UNIT]
        left = np.repeat(np.cumsum(rest + 1), rest + 1) - 1 - np.arange(cells - low)
        _weigh(vocabulary, edge[low:], chance[low:], left)
    return chance


def build_lattice(vocabulary: Vocabulary, texts: list[str]) -> Lattice:
    marked = ["" if not t else " " + t for t in texts]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    size = np.array([len(t) for t in marked], np.int64)
    begin = np.cumsum(size) - size
    points[points == MARK] = PLAIN_MARK
    points[points == SPACE] = MARK
    symbol = vocabulary.symbol.take(points)
    cut = np.zeros(len(points), bool)
    if len(points):
        space, alone = points == MARK, vocabulary.alone.take(symbol)
        cut[1:] = (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
        cut[begin[size > 0]] = True
    start = np.flatnonzero(cut)
    length = np.diff(np.append(start, len(points)))
    row = np.searchsorted(begin + size, start, "right")

    key = span_hashes(_odd_numbers().take(points), start, start + length)
    distinct = pa.array(key).dictionary_encode()
    kind = distinct.indices.to_numpy()
    chosen = np.zeros(len(distinct.dictionary), np.int64)
    chosen[kind[::-1]] = np.arange(len(kind))[::-1]
    by_length = np.argsort(length[chosen], kind="stable")
    place = np.empty(len(by_length), np.int64)
    place[by_length] = np.arange(len(by_length))
    kind, chosen = place.take(kind), chosen[by_length]

    lengths = length[chosen]
    heads = np.cumsum(lengths + 1) - lengths - 1
    tails = heads + lengths
    cells = int((lengths + 1).sum())
    source = np.repeat(start[chosen] - heads, lengths + 1) + np.arange(cells)
    cell_points, cell_symbol = (x.take(source, mode="clip") if cells else x for x in (points, symbol))
    cell_symbol[tails] = 0  # no piece reaches beyond an end

    columns = []
    active = np.flatnonzero(cell_symbol)
    node = vocabulary.first.take(cell_symbol[active])
    for d in range(vocabulary.longest):
        if d:
            after = cell_symbol.take(active + d)
            fits = np.flatnonzero(after)
            active = active.take(fits)
            node = vocabulary.step(node.take(fits), after.take(fits))
        there = np.flatnonzero(node >= 0)
        if not len(there):
            break
        active, node = active.take(there), node.take(there).astype(np.int64)
        columns.append((active, vocabulary.piece.take(node)))
    edge = np.full((cells, max(1, len(columns))), -1, np.int32)
    for d, (active, piece) in enumerate(columns):
        edge[active, d] = piece
    forced = edge[:, 0] < 0
    forced[tails] = False
    forced = np.flatnonzero(forced)
    edge[forced, 0] = vocabulary.size

    chance = _chances(vocabulary, edge, lengths)
    edge[forced, 0] += cell_points[forced]
    unit_row = np.searchsorted(row, np.arange(len(texts) + 1))
    return Lattice(row, unit_row, heads.take(kind), tails.take(kind), start - begin[row], edge, chance)


def _log1mexp(x: np.ndarray) -> np.ndarray:
    """log(1 - exp(x)) for x <= 0."""
    with np.errstate(divide="ignore"):
        return np.where(x > -0.693, np.log(-np.expm1(x)), np.log1p(-np.exp(x)))


@dataclass
class Samples:
    """Per sample and text: head pieces, and where the independent rest begins."""

    pieces: np.ndarray
    length: np.ndarray
    unit: np.ndarray
    at: np.ndarray
    log_p: np.ndarray
    perturbed: np.ndarray
    alive: np.ndarray


def search(lattice: Lattice, seeds: np.ndarray, samples: int) -> tuple[list[Samples], np.ndarray]:
    """The heads of the best perturbed segmentations, and the perturbed score of the next best one.

    A* over prefixes, for all texts in step. A prefix is as good as the largest perturbed score of the
    segmentations that begin with it; that of the whole text is a Gumbel variate, and those of a prefix's
    continuations are Gumbel variates on condition that their largest is the prefix's. The best
    continuation is followed, the others wait; the next sample follows the best one that waits. So
    segmentations come out in the order of their scores, each once.

    Waiting prefixes matter only while one could be among the next best: a prefix of log probability p
    scores p + 22.9 at most. Beyond that the rest of a segmentation is an ordinary sample, which is drawn
    elsewhere for all units at once.
    """
    n, wide = len(seeds), lattice.edge.shape[1]
    keep = samples + 1
    waiting = np.full((n, keep), -np.inf)  # perturbed score
    state = np.zeros((n, keep, 5))  # log probability, unit, position, sample and depth it leaves
    token = np.zeros((n, keep), np.int64)
    seeded = _seeded(seeds)
    top = _gumbel(seeded, np.int64(-1))
    done: list[Samples] = []
    begin, end = lattice.unit_row[:-1], lattice.unit_row[1:]
    for s in range(samples):
        if s == 0:
            now = Samples(
                np.zeros((n, 64), np.int64), np.zeros(n, np.int64), begin.copy(),
                np.where(begin < end, lattice.first[np.minimum(begin, len(lattice.first) - 1)], 0) if len(lattice.first) else np.zeros(n, np.int64),
                np.zeros(n), top.copy(), np.ones(n, bool),
            )
        else:
            score = waiting[:, 0].copy()
            alive = score > -np.inf
            source, depth = state[:, 0, 3].astype(np.int64), state[:, 0, 4].astype(np.int64)
            width = max(x.pieces.shape[1] for x in done)
            now = Samples(
                np.zeros((n, width + 64), np.int64), np.where(alive, depth + 1, 0), state[:, 0, 1].astype(np.int64),
                state[:, 0, 2].astype(np.int64), state[:, 0, 0].copy(), score, alive,
            )
            for k, before in enumerate(done):
                mine = np.flatnonzero(alive & (source == k))
                now.pieces[mine[:, None], np.arange(before.pieces.shape[1])] = before.pieces[mine]
            mine = np.flatnonzero(alive)
            now.pieces[mine, depth[mine]] = token[mine, 0]
            waiting = np.concatenate([waiting[:, 1:], np.full((n, 1), -np.inf)], 1)
            state = np.concatenate([state[:, 1:], np.zeros((n, 1, 5))], 1)
            token = np.concatenate([token[:, 1:], np.zeros((n, 1), np.int64)], 1)
        need = keep - s - 1  # waiting prefixes that can still matter
        active = np.flatnonzero(now.alive & (now.unit < end))
        while len(active):
            # A position at a unit's end is the next unit's first one.
            over = now.at[active] == lattice.last[now.unit[active]]
            step = active[over]
            now.unit[step] += 1
            inside = step[now.unit[step] < end[step]]
            now.at[inside] = lattice.first[now.unit[inside]]
            active = active[now.unit[active] < end[active]]
            active = active[now.log_p[active] + MOST_GUMBEL >= waiting[active, need - 1]]
            if not len(active):
                break
            at, depth = now.at[active], now.length[active]
            chance = lattice.chance[at]
            # Only edges that are there, as flat lists by position.
            own, edge = np.nonzero(chance)
            log_p = now.log_p[active][own] + np.log(chance[own, edge].astype(float))
            raw = log_p + _gumbel(seeded[active][own], (depth[own] * 64 + s) * 64 + edge)
            starts = np.searchsorted(own, np.arange(len(active)))
            most = np.maximum.reduceat(raw, starts)[own]
            lead = np.flatnonzero(raw == most)
            lead = lead[np.searchsorted(own[lead], np.arange(len(active)))]
            best, best_p = edge[lead], log_p[lead]
            above = now.perturbed[active][own]
            with np.errstate(invalid="ignore"):
                v = above - raw + _log1mexp(np.minimum(raw - most, 0))
                score = above - np.maximum(v, 0) - np.log1p(np.exp(-np.abs(v)))
            score[lead] = -np.inf  # it is followed, not kept waiting
            better = np.maximum.reduceat(score, starts) > waiting[active, need - 1]
            rows = active[better]
            if len(rows):
                number = np.cumsum(better) - 1
                some = np.flatnonzero(better[own])
                of, d = number[own[some]], edge[some]
                scores, fresh = np.full((len(rows), wide), -np.inf), np.zeros((len(rows), wide, 5))
                scores[of, d] = score[some]
                whose = own[some]
                fresh[of, d] = np.stack([log_p[some], now.unit[active][whose], at[whose] + 1 + d, np.full(len(some), s), depth[whose]], 1)
                scores = np.concatenate([waiting[rows], scores], 1)
                order = np.argsort(-scores, 1, kind="stable")[:, :keep]
                line = np.arange(len(rows))[:, None]
                waiting[rows] = scores[line, order]
                state[rows] = np.concatenate([state[rows], fresh], 1)[line, order]
                token[rows] = np.concatenate([token[rows], lattice.edge[at[better]]], 1)[line, order]
            if depth.max() + 1 >= now.pieces.shape[1]:
                now.pieces = np.concatenate([now.pieces, np.zeros_like(now.pieces)], 1)
            now.pieces[active, depth] = lattice.edge[at, best]
            now.length[active] += 1
            now.log_p[active] = best_p
            now.at[active] = at + 1 + best
        done.append(now)
    return done, waiting[:, 0]


def _choose(chances: np.ndarray, wide: int, spot: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and chance of the edge of each position whose range of chances holds the draw; the last one that is there, if rounding leaves a gap."""
    choice, chosen = np.empty(len(spot), np.int64), np.empty(len(spot), np.float32)
    open_, at, left = np.arange(len(spot)), spot * wide, draw
    for _ in range(wide):
        chance = chances.take(at)
        more = left >= chance
        done = np.flatnonzero(~more)
        ended = open_.take(done)
        choice[ended], chosen[ended] = at.take(done), chance.take(done)
        more = np.flatnonzero(more)
        if not len(more):
            break
        open_, at, left = open_.take(more), at.take(more) + 1, left.take(more) - chance.take(more)
    else:
        for i in open_:
            last = spot[i] * wide + np.flatnonzero(chances[spot[i] * wide : (spot[i] + 1) * wide])[-1]
            choice[i], chosen[i] = last, chances[last]
    return choice, chosen


def complete(vocabulary: Vocabulary, lattice: Lattice, seeds: np.ndarray, sample: int, head: Samples) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, row offsets, log probability) of a sample, its rest drawn for all units at once."""
    n, wide = len(seeds), lattice.edge.shape[1]
    chances, edges = lattice.chance.ravel(), lattice.edge.ravel()
    mine = np.flatnonzero((np.arange(len(lattice.row)) >= head.unit[lattice.row]) & head.alive[lattice.row])
    row = lattice.row.take(mine)
    at, end = lattice.first.take(mine), lattice.last.take(mine)
    shift = lattice.place.take(mine) - at
    opened = np.flatnonzero(mine == head.unit[row])
    at[opened] = head.at[row[opened]]
    lives, places, chosen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    live = np.flatnonzero(at < end)
    spot, end, shift, seeded = at.take(live), end.take(live), shift.take(live), _seeded(seeds).take(row.take(live))
    while len(live):
        place, chance = _choose(chances, wide, spot, _uniform(seeded, (shift + spot) * 128 + sample + 64))
        lives.append(live)
        places.append(place)
        chosen.append(chance)
        spot = place - spot * (wide - 1) + 1
        more = np.flatnonzero(spot < end)
        live, spot, end, shift, seeded = (x.take(more) for x in (live, spot, end, shift, seeded))
    step = np.repeat(np.arange(len(lives)) - 1, [len(x) for x in lives])
    live = np.concatenate(lives)
    log_p = head.log_p + np.bincount(row.take(live), np.log(np.concatenate(chosen).astype(float)), n)
    number = np.bincount(live, minlength=len(mine))
    heads = head.length * head.alive
    tail = np.bincount(row, number, n).astype(np.int64)
    offset = np.cumsum(heads + tail) - heads - tail
    ids = np.zeros(int((heads + tail).sum()), np.int64)
    before = np.cumsum(number) - number
    base = offset[row] + heads[row] + before - before[np.searchsorted(row, np.arange(n)).clip(max=max(len(row) - 1, 0))][row] if len(row) else before
    ids[base.take(live) + step] = edges.take(np.concatenate(places))
    for r in np.flatnonzero(heads):
        ids[offset[r] : offset[r] + heads[r]] = head.pieces[r, : heads[r]]
    return *_spell(vocabulary, ids, offset), log_p


def _spell(vocabulary: Vocabulary, ids: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put the ids of UTF-8 bytes in place of characters without a piece."""
    odd = ids >= vocabulary.size
    point = ids - vocabulary.size
    point[point == PLAIN_MARK] = MARK
    width = np.where(odd, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000), 1)
    ends = np.cumsum(width)
    out = np.zeros(ends[-1] if len(ends) else 0, np.int32)
    starts = ends - width
    out[starts[~odd]] = ids[~odd]
    for length in (1, 2, 3, 4):
        chosen = odd & (width == length)
        for k in range(length):
            shift = 6 * (length - 1 - k)
            byte = (point[chosen] >> shift) & 0x3F | 0x80 if k else point[chosen] >> shift | (0, 0, 0xC0, 0xE0, 0xF0)[length]
            out[starts[chosen] + k] = byte + vocabulary.bytes_first
    total = np.concatenate([[0], ends])
    return out, np.append(total[offset], total[-1])


def encode_texts(vocabulary: Vocabulary, texts: list[str], seeds: np.ndarray, samples: int) -> list[tuple]:
    """Per sample: (ids, row offsets, alive, log probability, perturbed score, log inclusion) of all texts."""
    lattice = build_lattice(vocabulary, texts)
    heads, limit = search(lattice, seeds, samples)
    out = []
    for s, head in enumerate(heads):
        ids, offsets, log_p = complete(vocabulary, lattice, seeds, s, head)
        with np.errstate(over="ignore"):
            x = log_p - limit  # infinite where all segmentations are among the samples
            inclusion = np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.maximum(x, -30)))))
        out.append((ids, offsets, head.alive, log_p, head.perturbed, inclusion))
    return out


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """UTF-8 of each row's pieces, without the space that stands before every text."""
    size = vocabulary.starts[ids + 1] - vocabulary.starts[ids]
    ends = np.concatenate([[0], np.cumsum(size)])
    step = np.arange(ends[-1]) - np.repeat(ends[:-1], size)
    data = vocabulary.text[np.repeat(vocabulary.starts[ids], size) + step].tobytes()
    bounds = ends[offsets].tolist()
    return [data[a + 1 : b] if data[a : a + 1] == b" " else data[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def encode(
    df: DataFrame, key: str, text: str = "text", samples: int = SAMPLES, seed: int = 17, model_file: str = MODEL_FILE,
    smoothing: float = SMOOTHING, columns: list[str] | None = None,
) -> DataFrame:
    """The given columns of `df`, or all, repeated for up to `samples` distinct segmentations of the whole text.

    Adds sample (from 0, by falling perturbed score), ids, log_prob of the segmentation, its perturbed
    score, and log_inclusion, the log probability that a segmentation of its log_prob is among the
    samples, given the score of the first one left out. The samples are drawn without replacement with
    probability proportional to the weights of their pieces, and depend on the seed, the row's key and
    the text alone. A text with fewer segmentations has fewer rows, all with inclusion 1. Null and empty
    texts have one, without ids. Columns with one of the new names are replaced. Rows with equal keys and texts have equal samples. Nothing is shuffled;
    the vocabulary is of fixed size.
    """
    names = [c for c in (df.columns if columns is None else columns) if c not in {"sample", "ids", "log_prob", "perturbed", "log_inclusion"}]
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(model_file, smoothing))
    ready = placed(df, F.col(text).cast("string"), F.xxhash64(F.lit(seed), F.col(key)), names=names)

    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            column = batch.column(len(names))
            seeds = batch.column(len(names) + 1).to_numpy().view(np.uint64)
            for low, high, _, _ in pieces(column, PIECE_BYTES):
                texts = [t or "" for t in column.slice(low, high - low).to_pylist()]
                found = encode_texts(shared.value, texts, seeds[low:high], samples)
                for s, (ids, offsets, alive, log_p, perturbed, inclusion) in enumerate(found):
                    rows = np.flatnonzero(alive)
                    bounds = np.append(offsets[:-1][rows], offsets[-1]) if len(rows) else np.zeros(1, np.int64)
                    made = [
                        pa.array(np.full(len(rows), s, np.int32)),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                        *(pa.array(x[rows]) for x in (log_p, perturbed, inclusion)),
                    ]
                    kept = batch.slice(low, high - low).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([*kept.columns[: len(names)], *made], [*names, *(c.split()[0] for c in ENCODED.split(", "))])

    return ready.mapInArrow(build, extended(df.select(*map(quoted, names)), ENCODED))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", model_file: str = MODEL_FILE) -> DataFrame:
    """All columns of `df` and the text of the ids. Null ids give null; bytes that are no UTF-8 become U+FFFD.

    A column that is called `out` is replaced.
    """
    df = df.drop(out)
    names = df.columns
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(model_file))
    place = names.index(ids)

    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            column = batch.column(place)
            texts: list[str | None] = []
            for low in range(0, len(column), 256):
                part = column.slice(low, 256)
                flat = part.flatten().to_numpy(zero_copy_only=False)
                offsets = np.concatenate([[0], np.cumsum(part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
                made = decode_ids(shared.value, flat, offsets)
                texts += [None if missing else t.decode("utf-8", "replace") for t, missing in zip(made, part.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, out])

    return placed(df).mapInArrow(build, extended(df, f"`{out}` string"))

"""Secret scans: fixed patterns, and random strings found by two character Markov models."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spelltide.llm.scratch import extended, placed
from spelltide.llm.words import pieces, spans

# The patterns, the least length of a hit, and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is taken whole, so shorter ones need no match
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

# The alphabet of candidate strings; its models have a class for the start.
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1
START = SYMBOLS - 1
ORDER = 2
#: Characters that are looked at together.
CODES = 2 << 20
#: Shortest candidate for a random string.
LEAST_RANDOM = 20
#: Natural log of the odds at which a candidate counts as random: about one to 160 000.
LOG_ODDS = 12.0
SMOOTHING = 2.0
#: Rarer contexts leave the word to shorter ones, so that no text is judged by its own few characters: so many
#: characters, and in texts so large a share of all, which many texts do not reach more easily than few.
LEAST_SEEN, LEAST_SHARE = 32, 1e-6
#: Shorter runs are ordinary; longer ones may be random themselves.
LEAST_DOUBTED = 8
#: In the first model, so many characters for each of the shorter runs' are dealt evenly to the alphabet, for what these lack.
EVEN = 0.01
#: Generated samples of random strings: so many of each alphabet.
SAMPLES, SAMPLE_LENGTH = 400, 40
SAMPLE_ALPHABETS = (
    b"0123456789abcdef", b"0123456789ABCDEF", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    b"abcdefghijklmnopqrstuvwxyz0123456789", ALPHABET[:62], ALPHABET[:64], ALPHABET[:62] + b"-_",
)

_CLASS = np.full(256, -1, np.int64)
_CLASS[list(ALPHABET)] = np.arange(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind; hits that are too short are dropped."""
    found = []
    lowered = text.encode("utf-8", "surrogatepass").lower()
    if any(word in lowered for word in KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Span and code of every character of the spans, a few million at a time; a code is two symbols of context and the symbol."""
    after = np.cumsum(ends - starts)
    before = after - (ends - starts)
    for low in range(0, int(after[-1]) if len(after) else 0, CODES):
        high = min(low + CODES, int(after[-1]))
        first, last = np.searchsorted(after, low, "right"), np.searchsorted(after, high, "left") + 1
        size = np.minimum(after[first:last], high) - np.maximum(before[first:last], low)
        which = np.repeat(np.arange(first, last), size)
        step = np.arange(low, high) - before[which]
        at = starts[which] + step
        code = _CLASS[data[at]]
        one = np.where(step >= 1, _CLASS[data[np.maximum(at - 1, 0)]], START)
        two = np.where(step >= 2, _CLASS[data[np.maximum(at - 2, 0)]], START)
        yield which, (two * SYMBOLS + one) * SYMBOLS + code


def _kept(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list | None:
    """All codes at once where the spans are those of a usual piece; None where they are too many to keep."""
    return list(_codes(data, starts, ends)) if int((ends - starts).sum()) <= CODES else None


def _random_counts() -> np.ndarray:
    """Counts of the generated samples: characters drawn evenly from the usual alphabets of keys."""
    rng = np.random.Generator(np.random.PCG64(5))
    counts = np.zeros(SYMBOLS ** (ORDER + 1))
    for alphabet in SAMPLE_ALPHABETS:
        letters = np.frombuffer(alphabet, np.uint8)
        data = letters[rng.integers(0, len(letters), SAMPLES * SAMPLE_LENGTH)]
        starts = np.arange(SAMPLES) * SAMPLE_LENGTH
        for _, code in _codes(data, starts, starts + SAMPLE_LENGTH):
            counts += np.bincount(code, minlength=len(counts))
    return counts


def _smoothed(counts: np.ndarray, least: float = LEAST_SEEN, highest: int = ORDER) -> np.ndarray:
    """log P(symbol | two symbols), each order up to the highest blended into the next lower one and used where its
    context was seen `least` times."""
    lower = np.full((1, SYMBOLS), 1 / SYMBOLS)
    for order in range(ORDER + 1):
        seen = counts.reshape(-1, SYMBOLS**order, SYMBOLS).sum(0)
        base = np.tile(lower, (SYMBOLS if order else 1, 1))
        total = seen.sum(-1, keepdims=True)
        lower = np.where((total >= least) & (order <= highest), (seen + SMOOTHING * base) / (total + SMOOTHING), base)
    return np.log(lower).ravel()


@dataclass
class SecretModel:
    """log P(symbol | context, random) - log P(symbol | context, ordinary) by code."""

    ratio: np.ndarray
    log_odds: float = LOG_ODDS


def _bytes_of(text: str, found: list[tuple[int, int, str]]) -> dict[int, int]:
    """UTF-8 place of every place in code points at which a span starts or ends, in one way through the text."""
    out, at, size = {}, 0, 0
    for place in sorted({x for span in found for x in span[:2]}):
        size += len(text[at:place].encode())
        at = place
        out[place] = size
    return out


def _touched(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray, texts: list[str], found: list[list[tuple[int, int, str]]]) -> np.ndarray:
    """Whether a found span shares a byte with each of the runs."""
    hits = []
    for i, spans_ in enumerate(found):
        places = _bytes_of(texts[i], spans_)
        hits += [(offsets[i] + places[a], offsets[i] + places[b]) for a, b, _ in spans_]
    if not hits:
        return np.zeros(len(starts), bool)
    first, last = np.array(sorted(hits)).T
    before = np.searchsorted(first, ends) - 1
    return (before >= 0) & (np.maximum.accumulate(last)[np.maximum(before, 0)] > starts)


def _labelled(data: np.ndarray, offsets: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the alphabet of four characters and more, and whether a fixed pattern touches them."""
    starts, ends, _ = spans(_CLASS[data] >= 0, offsets)
    long = ends - starts >= 4
    starts, ends = starts[long], ends[long]
    return starts, ends, _touched(starts, ends, offsets, texts, [base_spans(text) for text in texts])


def _random(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: SecretModel, codes: list | None = None) -> np.ndarray:
    """Whether the model calls a span random."""
    total = np.zeros(len(starts))
    for which, code in codes or _codes(data, starts, ends):
        total += np.bincount(which, model.ratio[code], len(starts))
    return total >= model.log_odds


def _model(counts: np.ndarray, log_odds: float, highest: int = ORDER) -> SecretModel:
    """Both models from the counts of ordinary runs and of random ones that were found; contexts of the ordinary one up to the highest order."""
    ordinary, random = counts
    # Found secrets may outnumber the generated ones and be of one alphabet, so they weigh no more than those do.
    made = _random_counts()
    random = random * min(1.0, made.sum() / max(random.sum(), 1)) + made
    return SecretModel(_smoothed(random) - _smoothed(ordinary, max(LEAST_SEEN, LEAST_SHARE * ordinary.sum()), highest), log_odds)


def fit(df: DataFrame, text: str = "text", log_odds: float = LOG_ODDS) -> SecretModel:
    """Train both models on all texts, labelled by the fixed patterns.

    Random are the runs of 20 and more characters that lie in a hit, and a fixed number of strings
    generated from the usual alphabets of keys. Ordinary are the runs of the alphabet that no pattern
    touches and that are not random themselves: unlabelled random strings would teach the ordinary model
    their contexts, the better the more texts there are. So texts are read three times. The first model
    knows only how frequent each character is in runs of less than eight; the second and third learn from
    these runs and from those longer ones that the model before does not call random. Random strings of
    less than eight characters are counted as ordinary. Tasks count by code (68^3 at most), which is all that
    is shuffled and collected. Null texts are empty; without texts the ordinary model is even.
    """
    texts = df.select(F.col(text).cast("string").alias("_text"))

    def counted(model: SecretModel | None) -> np.ndarray:
        shared = df.sparkSession.sparkContext.broadcast(model)

        def count(batches: Iterator[pa.RecordBatch]):
            totals = np.zeros((2, SYMBOLS ** (ORDER + 1)), np.int64)
            for batch in batches:
                texts = batch.column(0).fill_null("")
                for low, high, data, offsets in pieces(texts):
                    starts, ends, hit = _labelled(data, offsets, texts.slice(low, high - low).to_pylist())
                    codes = _kept(data, starts, ends)
                    ordinary = ~hit & (ends - starts < LEAST_DOUBTED)
                    if shared.value:
                        ordinary |= ~hit & ~_random(data, starts, ends, shared.value, codes)
                    for label, chosen in ((0, ordinary), (1, hit & (ends - starts >= LEAST_RANDOM))):
                        for which, code in codes or _codes(data, starts, ends):
                            totals[label] += np.bincount(code[chosen[which]], minlength=totals.shape[1])
            label, code = np.nonzero(totals)
            yield pa.RecordBatch.from_pydict({"label": label.astype(np.int32), "code": code.astype(np.int32), "n": totals[label, code]})

        found = texts.mapInArrow(count, "label int, code int, n long").groupBy("label", "code").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros((2, SYMBOLS ** (ORDER + 1)))
        counts[found["label"].to_numpy(), found["code"].to_numpy()] = found["n"].to_numpy()
        return counts

    first = counted(None)
    first[0] += EVEN * first[0].mean()
    model = _model(first, log_odds, highest=0)
    for _ in range(2):
        model = _model(counted(model), log_odds)
    return model


def scan_texts(data: np.ndarray, offsets: np.ndarray, texts: list[str], model: SecretModel) -> list[list[tuple[int, int, str]]]:
    """All spans of each text, in code points, by start and kind: those of the fixed patterns, and the
    runs of 20 and more characters that touch none of them and that the models call random."""
    found = [base_spans(text) for text in texts]
    starts, ends, row = spans(_CLASS[data] >= 0, offsets)
    long = ends - starts >= LEAST_RANDOM
    starts, ends, row = starts[long], ends[long], row[long]
    random = _random(data, starts, ends, model) & ~_touched(starts, ends, offsets, texts, found)
    of, at, points = -1, 0, 0
    for a, b, i in zip(starts[random], ends[random], row[random]):
        if i != of:
            of, at, points = i, int(offsets[i]), 0
        points += int(np.count_nonzero((data[at:a] & 0xC0) != 0x80))
        at = int(a)
        found[i].append((points, points + int(b - a), "random"))
    return [sorted(each, key=lambda s: (s[0], KINDS.index(s[2]))) for each in found]


def redacted(text: str, found: list[tuple[int, int, str]], mask: str) -> str:
    """The text with each span, or group of overlapping ones, replaced by the mask."""
    out, at = [], 0
    for start, end, _ in found:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def span_list(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def scan(df: DataFrame, model: SecretModel, text: str = "text", mask: str = "[SECRET]", prefix: str = "") -> DataFrame:
    """All columns of `df`, then of every whole text: n_assign, n_access, n_hex, base_sha256, spans, clean_text.

    `spans` are all hits as kind:start:end, comma-joined by start and kind; base_sha256 is the hash of
    the same list without the random ones; clean_text has the mask in place of every hit. A null text
    has no hits and a null clean_text. Columns of these names are replaced; `prefix` keeps the new names
    apart from them. Nothing is shuffled; the model has a fixed size.
    """
    new = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string", "clean_text": "string"}
    df = df.drop(*(prefix + c for c in new))
    names = df.columns
    shared = df.sparkSession.sparkContext.broadcast(model)

    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            column = batch.column(len(names))
            rows = []
            for low, high, data, offsets in pieces(column):
                texts = column.slice(low, high - low).to_pylist()
                known = [t or "" for t in texts]
                for text, found in zip(texts, scan_texts(data, offsets, known, shared.value)):
                    base = [s for s in found if s[2] != "random"]
                    counts = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
                    hashed = hashlib.sha256(span_list(base).encode()).hexdigest()
                    rows.append([*counts, hashed, span_list(found), text if text is None or not found else redacted(text, found, mask)])
            made = [pa.array(c, pa.int64() if kind == "long" else pa.string()) for c, kind in zip(zip(*rows), new.values())] if rows else [
                pa.array([], pa.int64() if kind == "long" else pa.string()) for kind in new.values()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], [*names, *(prefix + c for c in new)])

    made = ", ".join(f"`{prefix}{c}` {kind}" for c, kind in new.items())
    return placed(df, F.col(text).cast("string")).mapInArrow(build, extended(df, made))

"""URL filters: host and path rules first, else a ratio of two character language models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spelltide.llm.scratch import extended, placed
from spelltide.llm.words import pieces

# Classes of characters: a-z in either case, the marks below, any digit, any other byte, and the end.
MARKS = b"./-_?=&:#%+~,;@"
SYMBOLS = 26 + len(MARKS) + 3
END, OTHER, DIGIT = SYMBOLS - 1, SYMBOLS - 2, SYMBOLS - 3
ORDER = 3
#: A context counts once it was seen so often; rarer ones fall back on a shorter context.
LEAST_SEEN = 4
#: Strength of the shorter context's distribution, in characters seen.
SMOOTHING = 8.0
#: Scores are calibrated on a histogram of this step and reach.
STEP, REACH = 0.01, 5.0

_CLASS = np.full(256, OTHER, np.int64)
_CLASS[97:123] = _CLASS[65:91] = np.arange(26)
_CLASS[list(MARKS)] = 26 + np.arange(len(MARKS))
_CLASS[48:58] = DIGIT

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """`site` is a host and a path, as in `example.com/de/`; it also fits all subdomains."""

    verdict: str
    site: str

    @property
    def host(self) -> str:
        return self.site.partition("/")[0].translate(str.maketrans(UPPER, LOWER))

    @property
    def path(self) -> str:
        return "".join(self.site.partition("/")[1:])


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The site of the longest rule that fits, or null; of equally long ones the last in text order."""
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.site), r.site)):
        ours = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
        fits = F.when(ours & F.startswith(path, F.lit(rule.path)), F.lit(rule.site)).otherwise(fits)
    return fits


def _codes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after, row, code) of every character and end; a code is ORDER symbols of context and the symbol.

    The context of the first characters is filled up with ends.
    """
    for low, high, data, offsets in pieces(column):
        rows = high - low
        at = np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets)) * (ORDER + 1) + ORDER
        line = np.full(len(data) + rows * (ORDER + 1) + ORDER, END, np.int64)
        line[at] = _CLASS[data]
        close = offsets[1:] + np.arange(rows) * (ORDER + 1) + ORDER
        place = np.sort(np.concatenate([at, close]))
        code = np.zeros(len(place), np.int64)
        for back in range(ORDER, -1, -1):
            code = code * SYMBOLS + line[place - back]
        yield low, high, np.searchsorted(close, place), code


def _smoothed(counts: np.ndarray) -> np.ndarray:
    """log P(symbol | context) for all contexts of ORDER symbols, each blended into the next shorter one's distribution."""
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(ORDER + 1):
        seen = counts.reshape(-1, SYMBOLS**order, SYMBOLS).sum(0)
        total = seen.sum(-1, keepdims=True)
        base = np.broadcast_to(lower, (SYMBOLS, *lower.shape)).reshape(-1, SYMBOLS) if order else lower[None]
        lower = np.where(total >= LEAST_SEEN, (seen + SMOOTHING * base) / (total + SMOOTHING), base)
        lower = lower.reshape(SYMBOLS**order, SYMBOLS)
    return np.log(lower).ravel()


@dataclass
class UrlModel:
    """log P(symbol | context, accepted) - log P(symbol | context, rejected), and the least mean that is accepted."""

    ratio: np.ndarray
    threshold: float


def _scored(df: DataFrame, column: str, ratio: np.ndarray, out: str) -> DataFrame:
    """All columns and the mean log-likelihood difference per character, the end included."""
    names = df.columns
    shared = df.sparkSession.sparkContext.broadcast(ratio.astype(np.float32))
    ready = placed(df, F.col(column).cast("string"))

    def build(batches):
        for batch in batches:
            scores = [np.zeros(0)]
            for low, high, row, code in _codes(batch.column(len(names))):
                each = shared.value[code].astype(float)
                scores.append(np.bincount(row, each, high - low) / np.bincount(row, minlength=high - low))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(np.concatenate(scores))], [*names, out])

    return ready.mapInArrow(build, extended(df, f"`{out}` double"))


def fit(labelled: DataFrame, url: str, accepted: str) -> UrlModel:
    """Train both models on the labelled urls of four fifths of the hosts and calibrate the threshold on the other hosts' urls.

    Hosts are held out whole, by hash, so that the threshold is not set by urls of hosts that the models know;
    a url without a host stands for itself. `accepted` is a boolean column; rows where it is null are left out and null urls count as empty.
    What reaches the driver are counts by context, at most 44^4 per model, and a histogram. The
    threshold is the one with the best mean of both classes' hit rates, the middle of the best ones if
    there are several, and 0 where a class has nothing held out. Without labels the difference is 0
    everywhere and all urls are accepted.
    """
    rows = labelled.where(F.col(accepted).isNotNull()).select(
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("_url"), F.col(accepted).alias("_ok")
    )
    host = url_host(F.col("_url"))
    held = F.pmod(F.xxhash64(F.when(host == "", F.col("_url")).otherwise(host)), F.lit(5)) == 0

    def count(batches):
        totals: dict[bool, np.ndarray] = {}
        for batch in batches:
            for ok in (True, False):
                chosen = batch.filter(pa.compute.equal(batch.column(1), ok))
                for _, _, _, code in _codes(chosen.column(0)):
                    seen, times = np.unique(code, return_counts=True)
                    if ok not in totals:
                        totals[ok] = np.zeros(SYMBOLS ** (ORDER + 1), np.int64)
                    totals[ok][seen] += times
        for ok, total in totals.items():
            code = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"ok": [ok] * len(code), "code": code.astype(np.int32), "n": total[code]})

    summed = rows.where(~held).mapInArrow(count, "ok boolean, code int, n long").groupBy("ok", "code").agg(F.sum("n").alias("n"))
    found = summed.toArrow()
    ok, code, n = (found[c].to_numpy() for c in ("ok", "code", "n"))
    tables = []
    for kind in (True, False):
        counts = np.zeros(SYMBOLS ** (ORDER + 1))
        counts[code[ok == kind]] = n[ok == kind]
        tables.append(_smoothed(counts))
    ratio = tables[0] - tables[1]
    if len(set(ok)) < 2:
        return UrlModel(ratio * 0, 0.0)
    bins = F.greatest(F.lit(-REACH), F.least(F.lit(REACH), F.col("_score"))) / STEP
    scored = _scored(rows.where(held), "_url", ratio, "_score")
    histogram = scored.groupBy("_ok", F.floor(bins).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    size = int(round(REACH / STEP))
    held_out = np.zeros((2, 2 * size + 2))
    for r in histogram:
        held_out[int(r["_ok"]), r["bin"] + size] += r["n"]
    if not held_out.sum(1).all():
        return UrlModel(ratio, 0.0)
    share = np.cumsum(held_out, 1) / held_out.sum(1, keepdims=True)
    # At a threshold after bin i, rejected urls up to i and accepted ones beyond it are right.
    right = share[0] + 1 - share[1]
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return UrlModel(ratio, float((best[len(best) // 2] + 1 - size) * STEP))


def judge(df: DataFrame, model: UrlModel, rules: Sequence[Rule], url: str = "url", score: str = "score") -> DataFrame:
    """All columns of `df`, with host, path, rule, the model's score and the verdict `allow` or `block`.

    The longest rule that fits decides; where none does, the score must reach the threshold. A null url
    or one without `://` has an empty host and path, fits no rule and is judged by the model. Columns with
    one of the new names are replaced.
    """
    df = df.drop("host", "path", "rule", "verdict", score)
    address = F.col(url).cast("string")
    placed = df.withColumns({"host": url_host(address), "path": url_path(address)})
    placed = _scored(placed.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules)), url, model.ratio, score)
    by_model = F.when(F.col(score) >= model.threshold, "allow").otherwise("block")
    ruled = F.lit(None).cast("string")
    for rule in rules:
        ruled = F.when(F.col("rule") == rule.site, rule.verdict).otherwise(ruled)
    return placed.withColumn("verdict", F.coalesce(ruled, by_model))


def rule_labels(df: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """The urls that rules decide, as training rows (url, accepted)."""
    address = F.col(url).cast("string")
    site = longest_rule(url_host(address), url_path(address), rules)
    allowed = [r.site for r in rules if r.verdict == "allow"]
    return df.select(address.alias("url"), site.isin(allowed).alias("accepted")).where("accepted is not null")

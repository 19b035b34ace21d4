"""Row filters given as text or lists."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT_LIST = 1_000

# A column, and a quoted literal or one bare word.
_EQUALITY = re.compile(r"^\s*([\w.`]+)\s*={1,2}\s*(?:'((?:[^']|'')*)'|([\w.+-]+))\s*$")
_ID = re.compile(r"\s*(?:'((?:[^']|'')*)'|([^',]*))\s*(?:,|$)")


def split_conditions(text: str, sep: str = ",") -> list[str]:
    """Split on the separator, but not inside quotes or brackets."""
    parts, depth, quoted, start, i = [], 0, False, 0, 0
    while i < len(text):
        ch = text[i]
        if ch == "'":
            quoted = not quoted
        elif not quoted and ch in "()":
            depth += 1 if ch == "(" else -1
        elif not quoted and depth == 0 and text.startswith(sep, i):
            parts.append(text[start:i])
            i = start = i + len(sep)
            continue
        i += 1
    parts.append(text[start:])
    return [p.strip() for p in parts if p.strip()]


def normalise_predicate(text: str | None) -> str:
    """Comma-separated conditions as one SQL predicate."""
    return " and ".join(split_conditions(text or ""))


def conjunctive_filter(df: DataFrame, conditions: str | list[str], sep: str = ",") -> DataFrame:
    """Keep rows that meet every condition.

    `column=value` with one quoted value or bare word compares with the value as text; anything else is
    a SQL predicate as it stands.
    """
    if isinstance(conditions, str):
        conditions = split_conditions(conditions, sep)
    for condition in conditions:
        equality = _EQUALITY.match(condition)
        if equality:
            column, quoted, bare = equality.groups()
            df = df.where(F.col(column) == F.lit(bare if quoted is None else quoted.replace("''", "'")))
        else:
            df = df.where(F.expr(condition))
    return df


def parse_id_list(ids: str | None) -> list[str] | None:
    """Ids of a comma-separated list, or None when it is blank or ALL.

    Blanks around an id do not count, those inside do. A quoted id may hold commas, and a doubled quote
    stands for one.
    """
    text = (ids or "").strip()
    if text in ("", "ALL"):
        return None
    found, at = [], 0
    while at < len(text):
        item = _ID.match(text, at)
        if item is None or item.end() == at:
            raise ValueError(f"not a list of ids from here on: {text[at:at + 40]!r}")
        quoted, bare = item.groups()
        found.append(bare.strip() if quoted is None else quoted.replace("''", "'"))
        at = item.end()
    return [i for i in found if i]


def id_list_filter(df: DataFrame, column: str, ids: str | list[str] | None) -> DataFrame:
    """Keep rows whose column is in the list; columns and their order stay.

    A short list is a predicate that scans can use, a long one a semi join.
    """
    wanted = parse_id_list(ids) if ids is None or isinstance(ids, str) else list(ids)
    if wanted is None:
        return df
    kind = df.schema[column].dataType
    if len(wanted) <= SHORT_LIST:
        return df.where(F.col(column).isin([F.lit(w).cast(kind) for w in wanted]))
    listed = df.sparkSession.createDataFrame([(str(w),) for w in wanted], "_id string")
    return df.join(listed.select(F.col("_id").cast(kind)), F.col(column) == F.col("_id"), "left_semi")

"""Rows in fewer bytes on their way through a shuffle, with every value and the order of the rows kept.

A row's text columns cost a length, a place and padding each, and its times eight bytes that differ everywhere. Here a run of text
columns travels as one column, and times as their distance from the first one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Compact:
    """How ``columns`` travel: runs of text columns that follow one another in ``order`` as one column each, and times after the
    first of a run of times as microseconds from it. ``order``: the packed columns that sort (NULLs least) as those given do."""

    def __init__(self, df: DataFrame, order: list[str]):
        types, groups = dict(df.dtypes), [[]]
        for c in order:
            if not groups[-1] or types[c] not in ("string", "timestamp") or types[c] != types[groups[-1][0]]:
                groups.append([])
            groups[-1].append(c)
        runs = [g for g in groups if len(g) > 1]
        self.columns = df.columns
        self.texts = {f"_texts_{i}": g for i, g in enumerate(g for g in runs if types[g[0]] == "string")}
        self.times = {c: g[0] for g in runs if types[g[0]] == "timestamp" for c in g[1:]}
        held = {c: name for name, g in self.texts.items() for c in g}
        self.order = list(dict.fromkeys(held.get(c, c) for c in order))

    def pack(self, df: DataFrame) -> DataFrame:
        held = {c for g in self.texts.values() for c in g}
        return df.select(*[(F.unix_micros(_at(c)) - _from(self.times[c])).alias(c) if c in self.times else _at(c) for c in df.columns if c not in held],
                         *[F.concat(*[_ended(c) for c in g]).alias(name) for name, g in self.texts.items()])

    def unpack(self, df: DataFrame, columns: list[str] | None = None) -> DataFrame:
        plain = {c: F.timestamp_micros(_at(c) + _from(first)) for c, first in self.times.items()}
        plain |= {c: _nth(name, i) for name, g in self.texts.items() for i, c in enumerate(g)}
        return df.select(*[plain[c].alias(c) if c in plain else _at(c) for c in columns or self.columns])


def _at(column: str) -> Column:
    return F.col(f"`{column}`")


def _from(first: str) -> Column:
    return F.coalesce(F.unix_micros(_at(first)), F.lit(0))


def _ended(column: str) -> Column:
    """A text that ends with a zero character; those inside are escaped, and a NULL is shorter than any text."""
    escaped = F.replace(F.replace(_at(column), F.lit("\x01"), F.lit("\x01\x02")), F.lit("\x00"), F.lit("\x01\x01"))
    return F.coalesce(F.concat(F.lit("\x02"), escaped, F.lit("\x00")), F.lit("\x00"))


def _nth(packed: str, nth: int) -> Column:
    part = F.split_part(_at(packed), F.lit("\x00"), F.lit(nth + 1))
    escaped = part.substr(F.lit(2), F.length(part))
    return F.when(part != "", F.replace(F.replace(escaped, F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01")))

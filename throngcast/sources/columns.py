"""Late-bound column names of raw files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class HeaderLookup:
    """Columns of one raw frame by the words of their names.

    Two names mean the same column when they have the same words in the same order; a word is a
    run of ASCII letters and digits, in any case. Of several such columns the last one counts.
    The lookup is built once per frame and asked for accepted spellings in order of preference.
    """

    def __init__(self, df: DataFrame):
        self.columns = list(df.columns)
        self._by_words = {_words(name): name for name in self.columns}

    def first_of(self, *accepted: str) -> str | None:
        for name in accepted:
            if found := self._by_words.get(_words(name)):
                return found
        return None

    def __contains__(self, accepted: str | Sequence[str]) -> bool:
        return self.first_of(*([accepted] if isinstance(accepted, str) else accepted)) is not None

    def need(self, *accepted: str) -> Column:
        """The first accepted column; none of them is an error that names both sides."""
        found = self.first_of(*accepted)
        if found is None:
            raise ValueError(f"no column is called {' or '.join(accepted)}; the file has {', '.join(self.columns)}")
        return F.col(f"`{found}`")

    def want(self, dtype: str, *accepted: str) -> Column:
        """The first accepted column, or a typed null."""
        found = self.first_of(*accepted)
        return F.col(f"`{found}`") if found else F.lit(None).cast(dtype)


def _words(name: str) -> tuple[str, ...]:
    return tuple(re.findall("[a-z0-9]+", name.lower()))


def require_columns(df: DataFrame, columns: Iterable[str], label: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{label} lacks columns {missing}; it has {df.columns}")


def complete_columns(df: DataFrame, **defaults: Column) -> DataFrame:
    """Add each named column only where the frame does not have it yet."""
    return df.withColumns({name: value for name, value in defaults.items() if name not in df.columns})

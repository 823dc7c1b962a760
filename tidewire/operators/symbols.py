"""Which assets of a universe a text names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Assets whose bare name is an everyday word; they only count when marked or by their pair.
WORDLIKE = ("BIO", "CHIP", "DASH", "DOGS", "HIVE", "MEGA", "NEAR", "NOT", "TON", "TRUMP")
BLOCK_ALIASES = 200_000  # aliases of one automaton; a larger universe is matched block by block


def alias_table(universe: DataFrame) -> DataFrame:
    """asset, alias: the name (if not word-like), the native pair as written and with a hyphen, and the name marked by $, () or []."""
    a, r = F.upper("asset"), F.upper("reference_symbol_native")
    names = F.array(F.when(~a.isin(*WORDLIKE), a), r, F.replace(r, F.lit("USDT"), F.lit("-USDT")), F.concat(F.lit("$"), a), F.concat(F.lit("("), a, F.lit(")")), F.concat(F.lit("["), a, F.lit("]")))
    return universe.select("asset", F.explode(names).alias("alias")).where(F.col("alias").isNotNull() & (F.octet_length("alias") >= 3)).distinct()


def haystack(*parts: Column) -> Column:
    return F.upper(F.concat_ws("\n", *parts))


def _finder(aliases: list[tuple[str, str]]) -> Callable[[str], list[str]]:
    by: dict[str, set[str]] = {}
    for asset, alias in aliases:
        by.setdefault(alias, set()).add(asset)
    alnum = frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
    free = lambda text, at, end: (at == 0 or text[at - 1] not in alnum) and (end == len(text) or text[end] not in alnum)
    try:
        import ahocorasick
    except ImportError:
        sizes = sorted({len(k) for k in by})

        def look_up(text: str) -> list[str]:
            """Every place that no letter or digit stands before, by each length that an alias has."""
            starts = [i for i in range(len(text)) if i == 0 or text[i - 1] not in alnum]
            return sorted({a for i in starts for n in sizes if i + n <= len(text) for a in by.get(text[i : i + n], ()) if free(text, i, i + n)})

        return look_up
    machine = ahocorasick.Automaton()
    for k, v in by.items():
        machine.add_word(k, (len(k), v))
    if not by:
        return lambda text: []
    machine.make_automaton()

    def find(text: str) -> list[str]:
        out: set[str] = set()
        for last, (size, assets) in machine.iter(text):
            if not assets <= out and free(text, last + 1 - size, last + 1):
                out |= assets
        return sorted(out)

    return find


def symbol_matcher(universe: DataFrame) -> Callable[[Column], Column]:
    """A column function: haystack -> sorted distinct assets named in it as wholes (no ASCII letter or digit on either side).

    The universe is a registry kept by hand, so its aliases are collected; they go to the workers in blocks of BLOCK_ALIASES, each
    with an automaton of its own, however many there are.
    """
    aliases = [(r.asset, r.alias) for r in alias_table(universe).toLocalIterator()]
    blocks = [aliases[i : i + BLOCK_ALIASES] for i in range(0, max(1, len(aliases)), BLOCK_ALIASES)]

    def matcher(block: list[tuple[str, str]]):
        @F.pandas_udf(ArrayType(StringType()))
        def match(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
            find = _finder(block)
            for s in series:
                yield s.map(lambda t: find(t) if t else [])

        return match

    one, *more = [matcher(b) for b in blocks]
    return (lambda text: F.array_sort(F.array_distinct(F.flatten(F.array(*[m(text) for m in (one, *more)]))))) if more else one

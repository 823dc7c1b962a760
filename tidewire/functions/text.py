"""Text as columns: normalisation, hashes, shingles, simhash, tag removal, path segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Entities decoded in page text, in this order.
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&#x27;", "'")]
SHINGLE = 4


def squeeze(text: Column) -> Column:
    """White space runs (Unicode) to one space, trimmed."""
    return F.trim(F.regexp_replace(text, r"\p{IsWhite_Space}+", " "))


def normalize_text(text: Column) -> Column:
    """Letters and digits lower-cased, all else a space, spaces collapsed. Null stays null."""
    return squeeze(F.lower(F.regexp_replace(text, r"[^\p{IsAlphabetic}\p{N}\p{IsWhite_Space}]", " ")))


def hash_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def short_hash(text: Column) -> Column:
    return F.left(hash_hex(text), F.lit(24))


def first_u64_hash(text: Column) -> Column:
    """The first eight bytes of the digest, the greatest first, as the bit pattern of a bigint."""
    return F.conv(F.left(hash_hex(text), F.lit(16)), 16, -10).cast("bigint")


def shingles(normalized: Column) -> Column:
    """Four-word windows with repeats; fewer words are shingles themselves; none for a blank text."""
    words = F.filter(F.split(normalized, " "), lambda w: w != "")
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)), lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))
    return F.when(F.size(words) < SHINGLE, words).otherwise(windows)


@F.pandas_udf(LongType())
def simhash64(normalized: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """64-bit simhash over first_u64_hash of the shingles() of a normalised text as a bit pattern; a tie is 0; 0 for blank and null. In
    one step over Arrow batches, since sixty-four sums over exploded shingles would shuffle every shingle."""
    from hashlib import sha256

    known: dict[str, bytes] = {}
    for series in normalized:
        out = np.zeros(len(series), dtype=np.uint64)
        for i, text in enumerate(series):
            words = text.split() if text else []
            if not words:
                continue
            parts = words if len(words) < SHINGLE else [" ".join(words[k : k + SHINGLE]) for k in range(len(words) - SHINGLE + 1)]
            heads = b"".join([known.get(p) or known.setdefault(p, sha256(p.encode()).digest()[:8]) for p in parts])
            bits = np.unpackbits(np.frombuffer(heads, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(bits * 2 > len(parts)).view(">u8")[0]
            if len(known) > 300_000:
                known.clear()
        yield pd.Series(out.view(np.int64))


def simhash_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def clean_text(text: Column) -> Column:
    """Tags removed (an unclosed one takes the rest), stray '>' dropped, white space collapsed."""
    return squeeze(F.regexp_replace(text, r"<[^>]*(?:>|\z)|>", ""))


def clean_html_text(text: Column) -> Column:
    """As clean_text, then the known entities decoded one after the other."""
    out = F.regexp_replace(text, r"<[^>]*(?:>|\z)|>", "")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return squeeze(out)


def visible_text(markup: Column) -> Column:
    """Page text without script, style, svg and noscript blocks; an unclosed block takes the rest."""
    for tag in ("script", "style", "svg", "noscript"):
        markup = F.regexp_replace(markup, rf"(?s)<{tag}.*?(?:</{tag}>|\z)", " ")
    return clean_html_text(markup)


def path_segment(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]", "_")


def hash_prefix(text: Column) -> Column:
    return F.left(text, F.lit(2))


def utc_date(ms: Column) -> Column:
    """yyyy-MM-dd in UTC whatever the session's zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / 86_400_000).cast("int")).cast("string")


def utc_hour(ms: Column) -> Column:
    return F.lpad(F.floor(F.pmod(ms, F.lit(86_400_000)) / 3_600_000).cast("string"), 2, "0")


def canonical_symbol(symbol: Column) -> Column:
    """Upper-case letters and digits; without a quote suffix USDT (from five letters) or USDC (from seven)."""
    s = F.regexp_replace(F.upper(symbol), r"[^A-Z0-9]", "")
    return F.when(s.endswith("USDT") & (F.length(s) > 4), F.regexp_replace(s, "USDT$", "")).when(s.endswith("USDC") & (F.length(s) > 6), F.regexp_replace(s, "USDC$", "")).otherwise(s)


def source_offset(text: Column) -> Column:
    """h = 31 h + byte over the UTF-8 bytes modulo 2^64, as decimal(20,0); exact without overflow."""
    hexes = F.hex(F.encode(text, "utf-8"))
    codes = F.transform(F.sequence(F.lit(0), F.shiftright(F.length(hexes), 1) - 1), lambda i: F.conv(F.substr(hexes, i * 2 + 1, F.lit(2)), 16, 10).cast("decimal(3,0)"))
    zero, modulus = F.lit(0).cast("decimal(38,0)"), F.lit("18446744073709551616").cast("decimal(38,0)")
    folded = F.aggregate(codes, zero, lambda h, c: ((h * F.lit(31).cast("decimal(2,0)") + c) % modulus).cast("decimal(38,0)"))
    return F.when(F.length(text) > 0, folded).otherwise(zero)

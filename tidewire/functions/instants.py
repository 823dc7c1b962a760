"""Writing of times: parse many notations to local wall time, then to one UTC instant."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Offsets in minutes of the zone abbreviations that are read.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "SGT": 480, "HKT": 480, "JST": 540, "KST": 540, "AEST": 600, "AEDT": 660,
    "NZST": 720, "NZDT": 780, "BRT": -180, "ART": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420,
}
#: Month names by language, January first.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "en3": "jan feb mar apr may jun jul aug sep oct nov dec",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "de3": "jän feb mär apr mai jun jul aug sept okt nov dez",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
}

_ZONE = r"[A-Za-z]{1,5}|(?:UTC|GMT|UT)?[+-]\d{1,2}(?::?\d{2})?"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9})\d*)?)?(?: ?(AM|PM|am|pm|[Aa]\.[Mm]\.|[Pp]\.[Mm]\.))?(?: Uhr)?"
_TAIL = rf"(?: ?({_ZONE}))?"
#: Notation -> rewriting to "order|a|b|c|hour|minute|second|fraction|half|zone"; the order says what a, b and c are.
NOTATIONS = [
    (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:(?:[Tt]|,? ){_TIME}{_TAIL})?$", "ymd|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})[Tt](\d{{2}}):?(\d{{2}})(?::?(\d{{2}})(?:[.,](\d{{1,9}})\d*)?)?{_TAIL}$", "ymd|$1|$2|$3|$4|$5|$6|$7||$8"),
    (rf"^(?:\p{{L}}{{2,12}}\.?,? )?(\d{{1,2}})(?:\.|st|nd|rd|th)? (?:de )?(\p{{L}}{{3,12}})\.?,? (?:de )?(\d{{4}}|\d{{2}})(?:,? (?:at |um )?{_TIME}{_TAIL})?$", "dny|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (rf"^(?:\p{{L}}{{2,12}}\.?,? )?(\p{{L}}{{3,12}})\.? (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})(?:,? (?:at )?{_TIME}{_TAIL})?$", "ndy|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}})(?:,? (?:at )?{_TIME}{_TAIL})?$", "num|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (r"^(\d{4})[년年] ?(\d{1,2})[월月] ?(\d{1,2})[일日](?: ?(오전|오후|午前|午後|上午|下午)? ?(\d{1,2}):(\d{2})(?::(\d{2}))?)?$", "ymd|$1|$2|$3|$5|$6|$7||$4|"),
]

_NUMBER_FROM, _NUMBER_TO = 946_684_800, 4_102_444_800  # 2000-01-01 and 2100-01-01 in epoch seconds


def _literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def tidy(text: Column) -> Column:
    """Trimmed of any white space (no-break spaces too), with inner runs made one space."""
    return F.trim(F.regexp_replace(text, r"[\p{IsWhite_Space}\x{FEFF}\x{200B}]+", " "))


def epoch_number_ms(number: Column) -> Column:
    """Epoch milliseconds of a bare number by the one unit that puts it into 2000 to 2099, truncated; else null."""
    n = number.cast("decimal(38,9)")
    out = F.lit(None).cast("bigint")
    for per_second in (1, 1_000, 1_000_000, 1_000_000_000):
        ms = F.floor(n * 1000 / F.lit(per_second).cast("decimal(10,0)")) if per_second != 1_000 else F.floor(n)
        out = F.when((n >= _NUMBER_FROM * per_second) & (n < _NUMBER_TO * per_second), ms.cast("bigint")).otherwise(out)
    return out


def epoch_bigint_ms(number: Column) -> Column:
    """As epoch_number_ms, for a bigint column, in integer arithmetic."""
    out = F.lit(None).cast("bigint")
    for unit in (1, 1_000, 1_000_000, 1_000_000_000):
        ms = number * (1000 // unit) if unit <= 1000 else F.call_function("div", number, F.lit(unit // 1000).cast("bigint"))
        out = F.when((number >= _NUMBER_FROM * unit) & (number < _NUMBER_TO * unit), ms).otherwise(out)
    return out


def parse_notation(df: DataFrame, text: str, day_first: Column) -> DataFrame:
    """Adds __number_ms (bare numbers), __local_s (wall seconds since 1970), __ms (milliseconds below), __span (86400 for a date
    alone, else 1) and __offset_s (of a written zone; null if none), all null where the text is no such notation; __bad_zone is
    true where an unknown zone is written. df must not have these columns."""
    df = df.withColumn("__t", tidy(F.col(text)))
    t = F.col("__t")
    canon = F.lit(None).cast("string")
    for pattern, form in reversed(NOTATIONS):
        canon = F.when(t.rlike(pattern), F.regexp_replace(t, pattern, form)).otherwise(canon)
    df = df.withColumn("__p", F.split(canon, r"\|"))
    part = lambda i: F.nullif(F.get(F.col("__p"), F.lit(i)), F.lit(""))
    num = lambda i: part(i).try_cast("int")
    order = part(0)
    names = _literal_map({n: k for m in MONTHS.values() for k, n in enumerate(m.split(), 1)})
    year = F.when(order == "ymd", num(1)).otherwise(num(3))
    year = F.when(F.length(part(3)) == 2, F.when((order == "dny"), year + F.when(year < 70, 2000).otherwise(1900)).otherwise(year)).otherwise(year)
    first = F.coalesce(day_first, F.lit(False))
    month = (
        F.when(order == "ymd", num(2))
        .when(order == "dny", F.try_element_at(names, F.lower(part(2))))
        .when(order == "ndy", F.try_element_at(names, F.lower(part(1))))
        .otherwise(F.when(first, num(2)).otherwise(num(1)))
    )
    day = F.when(order == "ymd", num(3)).when(order == "dny", num(1)).when(order == "ndy", num(2)).otherwise(F.when(first, num(1)).otherwise(num(2)))
    half = F.lower(F.regexp_replace(part(8), r"\.", ""))
    pm, am = half.isin("pm", "오후", "午後", "下午"), half.isin("am", "오전", "午前", "上午")
    hour = F.coalesce(num(4), F.lit(0))
    hour = F.when(pm & (hour < 12), hour + 12).when(am & (hour == 12), F.lit(0)).otherwise(hour)
    zone = F.upper(part(9))
    digits = F.regexp_extract(zone, r"([+-])(\d{1,2}):?(\d{2})?$", 0)
    signed = F.when(digits.startswith("-"), -1).otherwise(1)
    minutes = F.regexp_extract(zone, r"[+-](\d{1,2})", 1).try_cast("int") * 60 + F.coalesce(F.regexp_extract(zone, r"[+-]\d{1,2}:?(\d{2})$", 1).try_cast("int"), F.lit(0))
    offset = F.when(digits != "", signed * minutes * 60).otherwise(F.try_element_at(_literal_map(ZONE_MINUTES), zone) * 60)
    return (
        df.withColumns({"__y": year, "__mo": month, "__d": day, "__h": hour, "__mi": F.coalesce(num(5), F.lit(0)), "__s": F.coalesce(num(6), F.lit(0)).cast("decimal(16,6)")})
        .withColumns({
            "__number_ms": F.when(t.rlike(r"^[+-]?\d{1,25}(?:\.\d+)?$"), epoch_number_ms(t.try_cast("decimal(38,9)"))),
            "__local_s": F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', try_make_timestamp_ntz(__y, __mo, __d, __h, __mi, __s))"),
            "__ms": F.coalesce(F.left(F.rpad(part(7), 3, "0"), F.lit(3)).try_cast("int"), F.lit(0)),
            "__span": F.when(part(4).isNull(), 86_400).otherwise(1),
            "__offset_s": offset,
            "__bad_zone": F.coalesce(zone.isNotNull() & offset.isNull(), F.lit(False)),
        })
        .drop("__t", "__p", "__y", "__mo", "__d", "__h", "__mi", "__s")
    )


_WS = r"[\p{IsWhite_Space}]"
_COMMENT = r"\((?:[^()\\]|\\.)*\)"
for _ in range(3):  # comments within comments, to this depth
    _COMMENT = rf"\((?:[^()\\]|\\.|{_COMMENT})*\)"
#: What the two standards write, as "weekday|day|month|year|hour|minute|second|fraction|zone".
RFC_2822 = (
    rf"(?is)^{_WS}*(?:(sun|mon|tue|wed|thu|fri|sat),)?{_WS}*(\d{{1,2}}){_WS}+({MONTHS['en3'].replace(' ', '|')}){_WS}+(\d{{2,6}}){_WS}+(\d{{2}}){_WS}*:{_WS}*(\d{{2}})(?:{_WS}*:{_WS}*(\d{{2}}))?"
    rf"{_WS}+(gmt|ut|[ecmp][sd]t|[a-ik-z]|[+-]\d{{4}})(?:{_WS}*{_COMMENT})*\z"
)
RFC_3339 = r"^(\d{4})-(\d{2})-(\d{2})[Tt ](\d{2}):(\d{2}):(\d{2})(?:\.(\d{1,9})\d*)?([Zz]|[+\-\x{2212}]\d{2}:\d{2})\z"
_LAST_YEAR = 262_142


def parse_published_at_ms(text: Column) -> Column:
    """Epoch milliseconds (rounded down) of a text that is a 64-bit integer (milliseconds as they stand), else an RFC 2822 time,
    else an RFC 3339 time; else null. Nothing is trimmed but white space before an RFC 2822 time, a weekday must be that of the
    date, and a second 60 counts on into the next minute."""
    canon = F.when(text.rlike(RFC_2822), F.lower(F.regexp_replace(text, RFC_2822, "$1|$2|$3|$4|$5|$6|$7||$8"))).when(text.rlike(RFC_3339), F.lower(F.regexp_replace(text, RFC_3339, "|$3|$2|$1|$4|$5|$6|$7|$8")))

    def instant(parts: Column) -> Column:
        part = lambda i: F.nullif(F.get(parts, F.lit(i)), F.lit(""))
        num = lambda i: part(i).try_cast("int")
        months = {n: k for k, n in enumerate(MONTHS["en3"].split(), 1)} | {f"{k:02d}": k for k in range(1, 13)}
        digits = F.length(part(3))
        year = num(3) + F.when((digits == 2) & (num(3) < 50), 2000).when(digits < 4, 1900).otherwise(0)
        second = F.coalesce(num(6), F.lit(0))
        wall = F.try_make_timestamp_ntz(F.when(year <= _LAST_YEAR, year), F.try_element_at(_literal_map(months), part(2)), num(1), num(4), num(5), F.least(second, F.lit(59)).cast("decimal(16,6)"))
        weekday = F.try_element_at(_literal_map({d: k for k, d in enumerate("sun mon tue wed thu fri sat".split(), 1)}), part(0))
        zone = part(8)
        hours, minutes = F.substring(zone, 2, 2).try_cast("int"), F.right(zone, F.lit(2)).try_cast("int")
        written = F.when((hours < 24) & (minutes < 60), F.when(zone.startswith("+"), 1).otherwise(-1) * (hours * 60 + minutes))
        named = _literal_map({z.lower(): m for z, m in ZONE_MINUTES.items() if z in ("EST", "EDT", "CST", "CDT", "MST", "MDT", "PST", "PDT")})
        offset = F.when(F.length(zone) >= 5, written).otherwise(F.coalesce(F.try_element_at(named, zone), F.lit(0)))
        whole = F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), wall) + second - F.least(second, F.lit(59)) - offset * 60
        right = (second <= 60) & (weekday.isNull() | (weekday == F.dayofweek(wall)))
        return F.when(right, whole * 1000 + F.coalesce(F.left(F.rpad(part(7), 3, "0"), F.lit(3)).try_cast("int"), F.lit(0)))

    # as a variable of transform the parts are made once, and not again for each use
    ms = F.get(F.transform(F.array(F.split(canon, r"\|")), instant), F.lit(0))
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("bigint")).otherwise(ms)


#: Zones have no changes of offset before FIRST_YEAR; from CYCLE_YEAR on they follow rules that repeat every 400 years, as the calendar does.
FIRST_YEAR, CYCLE_YEAR, CYCLE_YEARS, CYCLE_S = 1800, 2100, 400, 146_097 * 86_400
_FIRST_DAY_S = -5_364_576_000  # 1800-01-02


def _changes_of(zone: str) -> list[int]:
    """UTC seconds of the changes that the zone's file lists; a rule holds after the last."""
    import importlib.resources
    import os
    import struct
    import zoneinfo

    found = [p for p in (os.path.join(d, zone) for d in zoneinfo.TZPATH) if os.path.isfile(p)]
    raw = open(found[0], "rb").read() if found else importlib.resources.files("tzdata").joinpath("zoneinfo", *zone.split("/")).read_bytes()
    size, at = 4, 0
    utc, std, leap, times, types, chars = struct.unpack(">6l", raw[20:44])
    if raw[4:5] >= b"2":  # the second block has times of eight bytes
        at = 44 + times * 5 + types * 6 + chars + leap * 8 + std + utc
        size, times = 8, struct.unpack(">6l", raw[at + 20 : at + 44])[3]
    return [int.from_bytes(raw[at + 44 + size * k : at + 44 + size * (k + 1)], "big", signed=True) for k in range(times)]


def _intervals_of(zone: str) -> list[tuple[int, int, int]]:
    """(from, to, offset) in UTC seconds up to the end of the first cycle: between listed changes, and after them by bisection
    between every twentieth day of differing offset (rules change months apart)."""
    from datetime import datetime, timedelta, timezone
    from zoneinfo import ZoneInfo

    z, utc, epoch = ZoneInfo(zone), timezone.utc, datetime(1970, 1, 1, tzinfo=timezone.utc)
    off = lambda s: int((epoch + timedelta(seconds=s)).astimezone(z).utcoffset() / timedelta(seconds=1))
    begin, end = (int(datetime(y, 1, 1, tzinfo=utc).timestamp()) for y in (FIRST_YEAR, CYCLE_YEAR + CYCLE_YEARS))
    listed = [t for t in _changes_of(zone) if begin < t < end]
    out, at, now = [], begin, off(begin)

    def change(s: int) -> None:
        nonlocal at, now
        if off(s) != now:
            out.append((at, s, now))
            at, now = s, off(s)

    for t in listed:
        change(t)
    for s in range(max([begin, *listed]), end, 20 * 86_400):
        lo, hi = s, min(s + 20 * 86_400, end)
        if off(hi) != now:
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if off(mid) == now else (lo, mid)
            change(hi)
    return [*out, (at, end + 86_400, now)]


def zone_intervals(zones: DataFrame) -> DataFrame:
    """One row per zone and local year from FIRST_YEAR to the end of the first cycle: __zone, __year, __spans, an array of
    (local_from, local_to, offset_s).

    zones: one column of IANA names; null and unknown names give no rows. The result is bounded by the tz database (about 600
    names) times 700 years, at most some 60 MB whatever the data; so it may be broadcast.
    """
    name = zones.columns[0]

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for pdf in batches:
            rows = []
            for zone in pdf[name]:
                try:
                    spans = _intervals_of(zone)
                except Exception:  # no such zone
                    continue
                year = lambda s: int(np.datetime64(s, "s").astype("datetime64[Y]").astype(int)) + 1970
                by: dict[int, list] = {}
                for a, b, o in spans:
                    for y in range(year(a + o), year(b + o + 86_400) + 1):
                        by.setdefault(y, []).append({"local_from": a + o, "local_to": b + o, "offset_s": o})
                rows += [(zone, y, v) for y, v in by.items()]
            yield pd.DataFrame(rows, columns=["__zone", "__year", "__spans"])

    keys = zones.where(F.col(name).isNotNull()).distinct()
    return keys.mapInPandas(make, "__zone string, __year int, __spans array<struct<local_from:bigint,local_to:bigint,offset_s:int>>")


def to_instants(df: DataFrame, text: str, zone: str, day_first: str | None, out: str = "published_ms") -> DataFrame:
    """Adds `out` (epoch ms, truncated; null if not determinable) and `out`_status to df.

    As-of join of local times to zone-offset intervals: each row meets the intervals of its zone and local year; two that hold
    the local time make it ambiguous (the first passage is taken), none makes it nonexistent (not determinable), one gives the
    offset. A date alone is the first instant of that day. Null or blank texts, unknown notations and unknown written zones give
    null, as do local times whose zone is null or unknown. Any year that can be written counts: times before FIRST_YEAR are read in
    the zone's first offset, later ones than the first cycle in the year of that cycle that has the same calendar. Columns of those
    names are replaced, all others kept. Status: number, offset, local, ambiguous, nonexistent, unknown.
    """
    # the row travels as one struct, so that no helper can clash with its columns
    kept = [c for c in df.columns if c not in (out, f"{out}_status")]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row"), F.col(text).alias("__text"), F.col(zone).alias("__in"), (F.col(day_first) if day_first else F.lit(False)).alias("__first"))
    parsed = parse_notation(rows, "__text", F.col("__first"))
    spans = zone_intervals(df.select(F.col(zone).alias("__zone")))
    local = F.col("__local_s")
    parsed = parsed.withColumns({
        "__z": F.when(F.col("__offset_s").isNull() & ~F.col("__bad_zone") & local.isNotNull(), F.col("__in")),
        "__year_of": F.year(F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(__local_s as decimal(18,6)))")),
    })
    # years outside the intervals are moved into them by whole cycles, or to their first day, and the instant is moved back
    cycles = F.floor((F.col("__year_of") - CYCLE_YEAR) / F.lit(CYCLE_YEARS))
    away = F.when(F.col("__year_of") >= CYCLE_YEAR + CYCLE_YEARS, cycles * CYCLE_S).when(F.col("__year_of") < FIRST_YEAR, local - _FIRST_DAY_S).otherwise(0)
    year = F.when(F.col("__year_of") >= CYCLE_YEAR + CYCLE_YEARS, F.col("__year_of") - cycles * CYCLE_YEARS).otherwise(F.greatest("__year_of", F.lit(FIRST_YEAR)))
    parsed = parsed.withColumns({"__away": away.cast("bigint"), "__year_of": year.cast("int")})
    joined = parsed.join(F.broadcast(spans), (F.col("__z") == F.col("__zone")) & (F.col("__year_of") == F.col("__year")), "left")
    moved = local - F.col("__away")
    holds = F.filter("__spans", lambda x: (x.local_from < moved + F.col("__span")) & (x.local_to > moved))
    when = F.array_min(F.transform(F.col("__held"), lambda x: F.greatest(x.local_from, moved) - x.offset_s)) + F.col("__away")
    n = F.size("__held")
    ms = F.when(F.col("__number_ms").isNotNull(), F.col("__number_ms")).when(F.col("__offset_s").isNotNull(), (local - F.col("__offset_s")) * 1000 + F.col("__ms")).otherwise(when * 1000 + F.col("__ms"))
    status = (
        F.when(F.col("__number_ms").isNotNull(), "number")
        .when(F.col("__offset_s").isNotNull() & local.isNotNull(), "offset")
        .when(F.col("__held").isNull(), "unknown")
        .when(n == 0, "nonexistent")
        .when((n > 1) & (F.col("__span") == 1), "ambiguous")
        .otherwise("local")
    )
    done = joined.withColumn("__held", holds).select("__row", ms.alias("__out"), status.alias("__status"))
    return done.select(*[F.col(f"__row.`{c}`").alias(c) for c in kept], F.col("__out").alias(out), F.col("__status").alias(f"{out}_status"))


def instants_of(spark: SparkSession, rows: list[tuple], zone: str | None = "UTC", day_first: bool = False) -> list:
    """Small helper for tests and notebooks: instants of (text,) rows in one zone."""
    df = spark.createDataFrame([(i, r[0], zone, day_first) for i, r in enumerate(rows)], "i int, t string, z string, d boolean")
    return [r.published_ms for r in to_instants(df, "t", "z", "d").orderBy("i").select("published_ms").collect()]

"""URLs as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query keys that only track.
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid", "igshid", "ref", "ref_src")
TRACKING_PREFIX = "utm_"


def _base(base: Column) -> Column:
    b = F.regexp_replace(F.trim(base), "/+$", "")
    scheme, host, rest = (F.regexp_extract(b, r"^(.*?)://([^/]*)((?s).*)$", i) for i in (1, 2, 3))
    return F.when(b.contains("://"), F.concat(F.lower(scheme), F.lit("://"), F.lower(host), rest)).otherwise(b)


def canonical_url(url: Column) -> Column:
    """Without fragment, trailing slashes of the path and tracking keys; scheme and host lower-case; the other query parts sorted."""
    u = F.trim(F.split_part(url, F.lit("#"), F.lit(1)))
    at = F.instr(u, "?")
    query = F.when(at > 0, F.substr(u, at + 1)).otherwise("")
    key = lambda p: F.lower(F.split_part(p, F.lit("="), F.lit(1)))
    parts = F.filter(F.transform(F.split(query, "&"), lambda p: F.trim(p)), lambda p: (p != "") & ~key(p).isin(*TRACKING) & ~key(p).startswith(TRACKING_PREFIX))
    base = _base(F.when(at > 0, F.left(u, at - 1)).otherwise(u))
    return F.when(F.size(parts) > 0, F.concat(base, F.lit("?"), F.array_join(F.array_sort(parts), "&"))).otherwise(base)


def absolute_url(base: Column, href: Column) -> Column:
    """href against a page's URL: absolute ones as they are, rooted ones after scheme and host, others below the page."""
    origin = F.regexp_extract(base, r"^[^:/]+://[^/]+", 0)
    rooted = F.concat(F.when(origin == "", F.regexp_replace(base, "/+$", "")).otherwise(origin), href)
    return F.when(href.startswith("http://") | href.startswith("https://"), href).when(href.startswith("/"), rooted).otherwise(F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), href))


def with_query(url: Column, pairs: list[tuple[str, Column]]) -> Column:
    """url with key=value pairs put after it, nothing escaped."""
    text = F.concat_ws("&", *[F.concat(F.lit(k + "="), v.cast("string")) for k, v in pairs])
    return F.concat(url, F.when(url.contains("?"), "&").otherwise("?"), text)

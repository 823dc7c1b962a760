"""Feed payloads (RSS, Atom) to items."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("id", "title", "body", "url", "author", "published_at")


def looks_like_feed(body: Column, content_type: Column) -> Column:
    b = F.ltrim(body)
    return b.startswith("<?xml") | b.startswith("<rss") | b.startswith("<feed") | F.coalesce(content_type.rlike("xml|rss|atom"), F.lit(False))


def _local(el: ET.Element) -> str:
    return el.tag.rpartition("}")[2] if isinstance(el.tag, str) else ""


def _text(el: ET.Element | None) -> str | None:
    """First text of an element, white space collapsed; null if it has none."""
    if el is None:
        return None
    text = " ".join((el.text or "").split())
    return text or None


def _child(el: ET.Element, *names: str) -> ET.Element | None:
    """The first child in document order that has one of the names."""
    return next((c for c in el if _local(c) in names), None)


def parse_feed(payload: str, most: int) -> list[tuple]:
    """Up to `most` items of a feed: its item elements, or if there are none its entries. [] for what is no XML."""
    try:
        root = ET.fromstring(payload.lstrip().encode())
    except (ET.ParseError, ValueError):
        return []
    items = [e for e in root.iter() if _local(e) == "item"][:most]
    if items:
        of = lambda e, *n: _text(_child(e, *n))
        return [(of(e, "guid"), of(e, "title") or "", of(e, "description", "encoded", "content") or "", of(e, "link") or "", of(e, "creator", "author"), of(e, "pubDate", "published", "updated")) for e in items]
    out = []
    for e in [e for e in root.iter() if _local(e) == "entry"][:most]:
        links = [c for c in e if _local(c) == "link"]
        url = next((c.get("href") for c in links if c.get("href")), None) or _text(links[0] if links else None)
        author = _child(e, "author")
        name = _text(_child(author, "name")) if author is not None else None
        out.append((_text(_child(e, "id")), _text(_child(e, "title")) or "", _text(_child(e, "summary", "content")) or "", url or "", name or _text(author), _text(_child(e, "published", "updated"))))
    return out


def feed_items(payloads: DataFrame, key: str, payload: str, most: int = 50) -> DataFrame:
    """`key`, item_ord and the item fields of each payload, up to `most` of each (the limit reaches the parser). Payloads that are
    null or no feed give no rows."""
    kind = payloads.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, i, *item) for k, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if p for i, item in enumerate(parse_feed(p, most))]
            cols = list(zip(*rows)) or [()] * (2 + len(FIELDS))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [batch.schema.field(0).type, pa.int32(), *[pa.string()] * len(FIELDS)])], names=[key, "item_ord", *FIELDS])

    return payloads.select(key, payload).mapInArrow(run, f"`{key}` {kind}, item_ord int, " + ", ".join(f"{f} string" for f in FIELDS))

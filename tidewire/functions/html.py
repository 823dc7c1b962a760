"""Items, titles and summaries out of page mark-up, by scans over the text (not a DOM)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import clean_html_text, visible_text

#: Anchor titles that are navigation, and file endings of assets.
NAVIGATION = (
    "ABOUT", "ABOUT US", "APP", "BLOG", "CAREERS", "CONTACT", "CONTACT US", "COOKIE POLICY", "DISCORD", "DOCS", "DOCUMENTATION", "GITHUB", "GET STARTED", "HOME", "LAUNCH APP", "LEARN MORE",
    "LOGIN", "MEDIUM", "MENU", "NEWS", "PRIVACY", "PRIVACY POLICY", "READ MORE", "SIGN IN", "TELEGRAM", "TERMS", "TERMS OF SERVICE", "TWITTER", "X",
)
ASSETS = ("avif", "css", "gif", "ico", "jpeg", "jpg", "js", "png", "svg", "webp")
ACTION_MARKERS = ("how to buy", "where to buy", "buy now", "start trading")
WINDOW, LEAST, MOST, TITLE = 2000, 40, 1200, 8

_ANCHOR = re.compile(rb"<a(?=[>\s])[^>]*>")
_TAGS = re.compile(r"<[^>]*(?:>|\Z)|>")
_HREF_SCHEMES = re.compile(r"(?i)(?:javascript|mailto|tel|data|vbscript):")
_ASSET = re.compile(rf"(?i)\.(?:{'|'.join(ASSETS)})\Z")
_OPENERS, _CLOSERS = (b"<article", b"<li", b"<section", b"<div", b"<p"), (b"</article>", b"</li>", b"</section>", b"</div>", b"</p>")


def clean(text: str) -> str:
    """As functions.text.clean_html_text, for one string."""
    from tidewire.functions.text import ENTITIES

    text = _TAGS.sub("", text)
    for entity, char in ENTITIES:
        text = text.replace(entity, char)
    return " ".join(text.split())


def attribute(tag: str, name: str) -> str | None:
    """The quoted value after the first name= in a tag (a longer name that ends so counts too)."""
    at = tag.find(f"{name}=")
    if at < 0 or tag[at + len(name) + 1 : at + len(name) + 2] not in ("'", '"'):
        return None
    quote, rest = tag[at + len(name) + 1], tag[at + len(name) + 2 :]
    return rest.split(quote, 1)[0]


def usable_href(tag: str) -> str | None:
    href = (attribute(tag, "href") or "").strip()
    return None if not href or href.startswith("#") or _HREF_SCHEMES.match(href) else href


def absolute(base: str, href: str) -> str:
    if href.startswith(("http://", "https://")):
        return href
    if href.startswith("/"):
        scheme, _, rest = base.partition("://")
        return f"{scheme}://{rest.split('/', 1)[0]}{href}"
    return f"{base.rstrip('/')}/{href}"


def cut_actions(text: str) -> str:
    """Up to the earliest marker (its first place) that has LEAST characters before it."""
    low = "".join(c.lower() if c.isascii() else c for c in text)
    at = [p for p in map(low.find, ACTION_MARKERS) if p >= LEAST]
    return text[: min(at)] if at else text


def context_body(context: str, title: str) -> str:
    """What a page says about an item: the text around it without its title, cut at action sections and at MOST characters."""
    rest = context[len(title) :] if title and context.startswith(title) else context
    rest = rest.strip().strip("-|:· \t\n").strip()
    chosen = rest if len(rest) >= LEAST else context if context != title and len(context) >= LEAST else ""
    chosen = cut_actions(chosen).strip()
    return chosen if len(chosen) <= MOST else chosen[:MOST] + "..."


def anchors(base: str, page: str, most: int) -> Iterator[tuple[int, str, str, str]]:
    """(number, title, url, body) of up to `most` linked items in order; the scan ends where an anchor is not closed."""
    raw, cursor, kept = page.encode(), 0, 0
    while kept < most and (m := _ANCHOR.search(raw, cursor)):
        end = raw.find(b"</a>", m.end())
        if end < 0:
            return
        cursor = end + 4
        title, href = clean(raw[m.end() : end].decode(errors="ignore")), usable_href(m[0].decode(errors="ignore"))
        if href is None or len(title) < TITLE or title.upper() in NAVIGATION or _ASSET.search(href.split("?", 1)[0]):
            continue
        low, high = max(0, m.start() - WINDOW), min(len(raw), cursor + WINDOW)
        before, after = raw[low : m.start()], raw[cursor:high]
        starts = [p for p in (before.rfind(t) for t in _OPENERS) if p >= 0]
        ends = [p + len(t) for t in _CLOSERS if (p := after.find(t)) >= 0]
        around = raw[low + max(starts, default=0) : cursor + min(ends, default=len(after))]
        yield kept, title, absolute(base, href), context_body(clean(around.decode(errors="ignore")), title)
        kept += 1


def anchor_items(pages: DataFrame, key: str, url: str, html: str, most: int = 50) -> DataFrame:
    """`key`, item_ord, title, url and body of each page's linked items. Null pages and URLs have none; the limit is per page, as a
    feed's is."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, *a) for k, u, h in zip(*(c.to_pylist() for c in batch.columns)) if u and h for a in anchors(u, h, most)]
            cols = list(zip(*rows)) or [()] * 5
            types = [batch.schema.field(0).type, pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[key, "item_ord", "title", "url", "body"])

    return pages.select(key, url, html).mapInArrow(run, f"`{key}` {kind}, item_ord int, title string, url string, body string")


def looks_blocked(body: Column) -> Column:
    low = F.lower(body)
    return low.contains("just a moment") & low.contains("cloudflare")


def tag_html(page: Column, tag: str) -> Column:
    """Inside of the first such element; null if it is not closed."""
    return F.when(page.rlike(rf"(?s)<{tag}[^>]*>.*?</{tag}>"), F.regexp_extract(page, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1))


def attr_of(tag: Column, name: str) -> Column:
    """As attribute(), for a column; "" where there is no such quoted value."""
    at = F.instr(tag, f"{name}=")
    rest = F.when(at > 0, F.substr(tag, at + len(name) + 1)).otherwise("")
    inside = F.substr(rest, F.lit(2))
    return F.when(rest.startswith('"'), F.substring_index(inside, '"', 1)).when(rest.startswith("'"), F.substring_index(inside, "'", 1)).otherwise("")


def meta_content(page: Column, attr: str, value: str) -> Column:
    """Cleaned content of the first meta tag whose attribute has the value and whose content is not blank."""
    tags = F.regexp_extract_all(page, F.lit("<meta[^>]*>"), F.lit(0))
    found = F.filter(F.transform(F.filter(tags, lambda t: F.lower(attr_of(t, attr)) == value.lower()), lambda t: clean_html_text(attr_of(t, "content"))), lambda c: c != "")
    return F.get(found, F.lit(0))


def page_title(page: Column, fallback: Column) -> Column:
    named = [meta_content(page, "property", "og:title"), meta_content(page, "name", "twitter:title"), meta_content(page, "name", "title")]
    return F.coalesce(*named, F.nullif(clean_html_text(tag_html(page, "title")), F.lit("")), fallback)


def context_texts(contexts: Column, title: Column) -> Column:
    """context_body of each of an array of texts; step by step, so that no step repeats the one before."""
    rest = F.transform(contexts, lambda c: F.struct(c.alias("c"), F.btrim(F.when((title != "") & c.startswith(title), F.substr(c, F.length(title) + 1)).otherwise(c), F.lit("-|:· \t\n")).alias("r")))
    chosen = F.transform(rest, lambda x: F.when(F.length(x.r) >= LEAST, x.r).when((x.c != title) & (F.length(x.c) >= LEAST), x.c).otherwise(""))
    markers = F.array(*map(F.lit, ACTION_MARKERS))
    found = F.transform(chosen, lambda t: F.struct(t.alias("t"), F.array_min(F.filter(F.transform(markers, lambda m: F.call_function("instr", F.lower(t), m)), lambda p: p - 1 >= LEAST)).alias("p")))
    cut = F.transform(found, lambda x: F.trim(F.when(x.p.isNotNull(), F.left(x.t, x.p - 1)).otherwise(x.t)))
    return F.transform(cut, lambda t: F.when(F.length(t) <= MOST, t).otherwise(F.concat(F.left(t, F.lit(MOST)), F.lit("..."))))


def page_summary(page: Column, title: Column) -> Column:
    """The first that gives a text: description, og:description, twitter:description, visible main, visible body; null if none does."""
    texts = F.array(meta_content(page, "name", "description"), meta_content(page, "property", "og:description"), meta_content(page, "name", "twitter:description"), visible_text(tag_html(page, "main")), visible_text(tag_html(page, "body")))
    return F.get(F.filter(context_texts(F.array_compact(texts), title), lambda t: t != ""), F.lit(0))

import pytest
from pyspark.sql import functions as F

from tidewire.functions import html
from tidewire.functions.text import canonical_symbol, clean_html_text, clean_text, normalize_text, path_segment, short_hash, simhash64, simhash_hex, source_offset, utc_date, utc_hour, visible_text
from tidewire.functions.urls import absolute_url, canonical_url, with_query


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("text, want", [("Acme lists NEW-token!", "acme lists new token"), (" A b　c\n", "a b c"), ("नमस्ते x", "नमस ते x"), ("", ""), (None, None), ("½ ² Ⅷ", "½ ² ⅷ")])
def test_normalize(spark, text, want):
    assert one(spark, normalize_text(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text, want", [("a <b>c</b> > d", "a c d"), ("x <unclosed y", "x"), ("a&amp;lt;b&lt;c&rsquo;", "a<b<c’"), ("", "")])
def test_clean(spark, text, want):
    assert one(spark, clean_html_text(F.lit(text))) == want == html.clean(text)
    assert one(spark, clean_text(F.lit("<p>a</p>\n b"))) == "a b"
    assert one(spark, visible_text(F.lit("a<script>x<b></script>b<svg>never ends"))) == "a b"


def test_hashes(spark):
    assert one(spark, short_hash(F.lit("a"))) == "ca978112ca1bbdcafac231b3"
    same = [one(spark, simhash_hex(simhash64(normalize_text(F.lit(t))))) for t in ("one two three four five.", "one two three four five", "", None)]
    assert same[0] == same[1] != same[2] and same[2] == same[3] == "0" * 16
    assert str(one(spark, source_offset(F.lit("é")))) == str((0xC3 * 31 + 0xA9) % 2**64) and one(spark, source_offset(F.lit(""))) == 0
    assert one(spark, utc_date(F.lit(-1))) == "1969-12-31" and one(spark, utc_hour(F.lit(-1))) == "23"
    assert one(spark, path_segment(F.lit("a b/ü.c-d_"))) == "a_b__.c-d_"
    assert [one(spark, canonical_symbol(F.lit(s))) for s in ("btc-usdt", "USDT", "ethusdc", "aUSDC")] == ["BTC", "USDT", "ETH", "AUSDC"]


@pytest.mark.parametrize("url, want", [
    ("FTP://Mirror.Host.ORG/Pub/Files//?z=9&igshid=q& m=#top?x", "ftp://mirror.host.org/Pub/Files?m=&z=9"), ("http://h.x/P//?", "http://h.x/P"), ("no scheme/", "no scheme"),
    ("https://h.x/a?ref=1&refx=2&UTM_A=3&=4", "https://h.x/a?=4&refx=2"), ("", ""), ("#x", "")])
def test_urls(spark, url, want):
    assert one(spark, canonical_url(F.lit(url))) == want


def test_url_parts(spark):
    join = lambda h: one(spark, absolute_url(F.lit("https://h.x/news/"), F.lit(h)))
    hrefs = ["http://a.b", "/r", "//cdn/x", "rel"]
    assert [join(h) for h in hrefs] == ["http://a.b", "https://h.x/r", "https://h.x//cdn/x", "https://h.x/news/rel"] == [html.absolute("https://h.x/news/", h) for h in hrefs]
    assert one(spark, with_query(F.lit("u?x=1"), [("a", F.lit("b c")), ("n", F.lit(2))])) == "u?x=1&a=b c&n=2"


def test_anchors():
    page = "<a href='#top'>To the top of it</a><li><a\nhref=\"/n/1?x=1\"> <b>공지사항 새로운 소식</b></a> " + "This is what the item says about itself, at some length. How to buy it: click." + "</li><abbr href='/no'>Not an anchor at all</abbr><a data-href='/d' >Data href counts too</a><a href='/x.PNG?y'>A picture link</a><a href='/y'>Privacy Policy</a><a href='/z'>never closed"
    got = list(html.anchors("https://h.x/b", page, 9))
    assert [(n, t, u) for n, t, u, _ in got] == [(0, "공지사항 새로운 소식", "https://h.x/n/1?x=1"), (1, "Data href counts too", "https://h.x/d")]
    assert got[0][3] == "This is what the item says about itself, at some length."
    assert list(html.anchors("https://h.x", page, 1)) == got[:1] or len(list(html.anchors("https://h.x", page, 1))) == 1
    assert list(html.anchors("b", "", 5)) == []


def test_page_parts(spark):
    page = "<html><head><title> T </title><META x><meta name='description' content=''><meta property=\"OG:Title\" content=\"The &amp; title\"><meta property='og:description' content='short'></head><main>" + "word " * 12 + "</main></html>"
    assert one(spark, html.page_title(F.lit(page), F.lit("f"))) == "The & title"
    assert one(spark, html.page_title(F.lit("x"), F.lit("f"))) == "f"
    assert one(spark, html.page_summary(F.lit(page), F.lit("The & title"))) == ("word " * 12).strip()
    told = "what the page says about itself, in more than forty characters"
    for tag in (f"<meta name='description' content='{told}'>", f'<meta name="description" content="{told}">', f"<meta name='Description' content=\"{told}\">"):
        assert one(spark, html.page_summary(F.lit(tag + page), F.lit("t"))) == told
    # the first content= decides, quoted by either mark, up to the same mark or the tag's end
    for tag, want in (("<meta name='k' data-content='a' content='b'>", "a"), ("<meta name='k' content=bare data-content='b'>", None), ("<meta name=\"k\" content='it is \"so\"'>", 'it is "so"'), ("<meta name='k' content='open>", "open")):
        assert one(spark, html.meta_content(F.lit(tag), "name", "K")) == want, tag
    assert one(spark, html.page_summary(F.lit("<body>" + "w " * 900 + "</body>"), F.lit("t"))) == ("w " * 600) + "..."
    assert one(spark, html.page_summary(F.lit("<body>" + "w " * 90), F.lit("t"))) is None
    assert one(spark, html.looks_blocked(F.lit("Just a Moment ... Cloudflare")))

"""The main body of pages, by removal of each site's template.

A page comes as text, not as mark-up, and its tree is read from that: blocks (what stands between two sentences), lists below the
line that heads them, lines, labelled lines (label and value) and rows of like cells. Subtrees are hashed from below in a form free of
what varies on a site without meaning (decoration, case, numbers; the value below a label; the contents of like cells): a block's hash is
that of its lines' hashes. They are counted per host over distinct stories in Spark. Subtrees that recur over many of a host's pages, or
over pages of several hosts, are deleted, blocks as a whole; a line that heads a list of teasers takes its list with it. Headings that stand before paragraphs on few pages each are the articles' own and stay. No words are listed: what is a
heading and what a template is told by how often a line recurs and what follows it, and the limits are put into the widest gaps of
those figures over the collection.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.session import cut, scratch

_SPACE = re.compile(r"\s+")
_LEAD = re.compile(r"^(?:[>•*|·»▸►\-–—#]+\s+|\d{1,3}[.)]\s+|[>•*|·»▸►]+)+")
_TRAIL = re.compile(r"(?:\s*(?:>>|»|›|→|↑|↓|\.\.\.|…|!|[|–—]))+$")
_FRAMED = re.compile(r"^[\[(](.*)[\])]$")
_NUMBER = re.compile(r"\d+(?:[.,:]\d+)*")
_END = re.compile(r"[.!?。！？][\"”’»」』)\]]*(?:\s*\$\w+)*\s*$")
_INNER = re.compile(r"[.!?。！？][\"”’»」』)\]]*\s+\S")
_LABEL = re.compile(r"^([^:/|›—]{2,40}?)\s*(: |/ |\| |› |— )\s*(\S.*)$")
_CELL = re.compile(r"^[+\-−±]?[$€£]?\d[\d.,]*%?$")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")

SENTENCE, DIGITS, MARKED, HEADLINE = 1, 2, 4, 8


def bare(line: str) -> str:
    """A line without decoration: marks and numbering before it, frames around it, marks after it."""
    t = _SPACE.sub(" ", line).strip()
    for _ in range(2):
        t = _TRAIL.sub("", _LEAD.sub("", t)).strip()
        if m := _FRAMED.match(t):
            t = m[1].strip()
    return t


def read_line(line: str) -> tuple[str, str | None, str | None, int]:
    """(template, label, cells, flags) of a line that is not blank."""
    t = bare(line)
    words = t.split(" ")
    wide = len(_CJK.findall(t))
    ended = bool(_END.search(line.rstrip())) and not line.rstrip().endswith(("...", "…"))
    flags = 0
    if ((len(words) >= 5 or wide >= 8) and ended) or (_INNER.search(t) and (len(words) >= 12 or wide >= 24)):
        flags |= SENTENCE
    if any(c.isdigit() for c in t):
        flags |= DIGITS
    if _LEAD.match(_SPACE.sub(" ", line).strip()):
        flags |= MARKED
    if not flags & SENTENCE and (len(words) >= 4 or wide >= 6):
        flags |= HEADLINE
    template = _NUMBER.sub("#", t).casefold().rstrip(" .")
    label = None
    if not flags & SENTENCE and (m := _LABEL.match(t)) and any(c.isalpha() for c in m[1]) and len(m[1].split(" ")) <= 3:
        label = f"{m[1].casefold()}{m[2].strip()}"
    cells = None
    numeric = sum(bool(_CELL.match(w)) for w in words)
    if numeric >= 3 and numeric * 2 >= len(words):
        kinds = ["%" if w.endswith("%") else "#" if _CELL.match(w) else "w" for w in words]
        size = next(k for k in range(1, len(kinds) + 1) if kinds == (kinds[:k] * len(kinds))[: len(kinds)])
        cells = " ".join(kinds[:size])
    return template, label, cells, flags


def _hash(text: str) -> int:
    import xxhash

    n = xxhash.xxh3_64_intdigest(text)
    return n - (1 << 64) if n >> 63 else n


SHORT_LINE, REMEMBERED = 160, 100_000


def _trees_of(line: str, known: dict[str, tuple]) -> tuple[str, list[int], int]:
    """(template, hashes of its subtrees, flags) of a line that is not blank; short lines, most of which recur, are remembered."""
    found = known.get(line)
    if found is None:
        template, label, cells, flags = read_line(line)
        found = template, [_hash(f"{what} {x}") for what, x in (("line", template), ("label", label), ("cells", cells)) if x is not None], flags
        if len(line) <= SHORT_LINE:
            if len(known) >= REMEMBERED:
                known.clear()
            known[line] = found
    return found


def _blocks(rows: list[tuple]) -> list[int | None]:
    """Of each line the hash of its block, of two lines at least between sentences or the page's ends; null for others."""
    out: list[int | None] = [None] * len(rows)
    start = 0
    for i in range(len(rows) + 1):
        if i == len(rows) or rows[i][3] & SENTENCE:
            if i - start >= 2:
                out[start:i] = [_hash("block " + " ".join(str(r[2][0]) for r in rows[start:i]))] * (i - start)
            start = i + 1
    return out


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rec, host, body -> rec, host, story, line_no, subtrees (hashes), block (hash), flags, follow: 1 if a sentence comes next, 2 if a
    headline."""
    known: dict[str, tuple] = {}
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
        for rec, host, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows = [(no, *_trees_of(line, known)) for no, line in enumerate((body or "").split("\n"), 1) if not line.isspace() and line]
            longest = max((x[1] for x in rows if x[3] & SENTENCE), key=len, default=None) or max((x[1] for x in rows), key=len, default="")
            story = _hash("".join(filter(str.isalpha, longest)))
            blocks = _blocks(rows)
            for i, (no, _, trees, flags) in enumerate(rows):
                after = rows[i + 1][3] if i + 1 < len(rows) else 0
                follow = 1 if after & SENTENCE else 2 if after & HEADLINE else 0
                for column, v in zip(out, (rec, host, story, no, trees, blocks[i], flags, follow)):
                    column.append(v)
        kinds = [batch.schema.field(0).type, batch.schema.field(1).type, pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["rec", "host", "story", "line_no", "trees", "block", "flags", "follow"])


OWN, TEMPLATE, TEASERS = 1, 2, 3


def gap_middle(bins: list[int], least: int) -> float | None:
    """The middle of the widest stretch between occupied bins; null if none is `least` bins wide."""
    ends = [(b - a, (a + b + 1) / 2) for a, b in zip(bins, bins[1:])]
    width, middle = max(ends, default=(0, 0.0))
    return middle if width >= least else None


#: Limits where the figures have no gap: share of a heading's places that text follows, most pages with one heading, least with one template sentence.
BEFORE_TEXT, HEADING_RATE, SENTENCE_RATE = 0.7, 0.12, 0.05


def natural_limits(x: DataFrame, short: Column, sentence: Column) -> tuple[float, float, float]:
    """The three limits, each in the widest gap of its figure over all recurring subtrees: shares in 32 bins, rates in quarter octaves,
    so at most some 200 numbers reach the driver."""
    share, rate = F.col("text_all") / F.col("times_all"), F.floor(4 * F.log2(F.col("n_all") / F.col("pages_all"))).cast("int")
    seen = x.select("tree", F.floor(share * 32).cast("int").alias("s"), rate.alias("r"), short.alias("short"), sentence.alias("sentence")).dropDuplicates(["tree"])
    got = seen.groupBy("short", "sentence", "s", "r").agg(F.count(F.lit(1)).alias("n")).collect()
    cut = gap_middle(sorted({g.s for g in got if g.short and g.s >= 16}), 4)
    before_text = BEFORE_TEXT if cut is None else cut / 32
    cut = gap_middle(sorted({g.r for g in got if g.short and g.s >= before_text * 32}), 6)
    heading = HEADING_RATE if cut is None else 2 ** (cut / 4)
    cut = gap_middle(sorted({g.r for g in got if g.sentence}), 6)
    return before_text, heading, SENTENCE_RATE if cut is None else 2 ** (cut / 4)


def _trees() -> Column:
    return F.array_compact(F.concat("trees", F.array("block")))


def site_templates(lines: DataFrame, least: int = 3, limits: tuple[float, float, float] | None = None) -> DataFrame:
    """host, tree and kind of every subtree that recurs on `least` stories of a host or, over hosts, on two more: 1 a heading of
    articles, which stays, 2 template, 3 template that heads teasers. limits: see natural_limits, which finds them if none are given."""
    stories = lines.select("host", "story").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    one = lines.select("host", "story", F.explode(_trees()).alias("tree"), F.col("trees")[0].alias("own"), "block", "flags", "follow")
    one = one.groupBy("host", "tree", "story").agg(
        F.count(F.lit(1)).alias("times"), F.sum((F.col("follow") == 1).cast("int")).alias("before_text"), F.sum((F.col("follow") == 2).cast("int")).alias("before_line"),
        F.min("flags").alias("flags"), F.max((F.col("tree") == F.col("own")).cast("int")).alias("whole"), F.max(F.coalesce(F.col("tree") == F.col("block"), F.lit(False))).alias("is_block"),
    )
    by = one.groupBy("host", "tree").agg(
        F.count(F.lit(1)).alias("n"), F.sum("times").alias("times"), F.sum("before_text").alias("before_text"), F.sum("before_line").alias("before_line"), F.min("flags").alias("flags"), F.max("whole").alias("whole"), F.max("is_block").alias("is_block"),
    ).join(stories, "host")
    over = by.groupBy("tree").agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("n_all"), F.sum("pages").alias("pages_all"), F.sum("times").alias("times_all"), F.sum("before_text").alias("text_all"), F.sum("before_line").alias("line_all"),
    ).where(F.col("n_all") >= least)
    x = cut(by.join(over, "tree"))
    flag = lambda bit: F.col("flags").bitwiseAND(bit) != 0
    plain = ~flag(SENTENCE) & ~flag(DIGITS) & (F.col("whole") == 1)
    before_text, heading_rate, sentence_rate = limits or natural_limits(x, plain, flag(SENTENCE))
    often = (F.col("n") >= least) | ((F.col("hosts") >= 3) & (F.col("n_all") >= least + 2))
    rate = F.greatest(F.col("n") / F.col("pages"), F.when(F.col("hosts") >= 2, F.col("n_all") / F.col("pages_all")).otherwise(0.0))
    heading = ~flag(DIGITS) & (F.col("whole") == 1) & (F.col("n_all") / F.col("pages_all") <= heading_rate) & (F.col("text_all") >= before_text * F.col("times_all"))
    drop = F.when(flag(SENTENCE) | F.col("is_block"), often & (rate >= sentence_rate)).otherwise(often & ~heading)
    teasers = (F.col("line_all") * 2 >= F.col("times_all")) & plain  # what follows it is mostly no text
    kind = F.when(drop & teasers, TEASERS).when(drop, TEMPLATE).when(heading & ~flag(SENTENCE), OWN)
    return x.select("host", "tree", kind.alias("kind")).where("kind is not null")


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rec, lines (line_no, flags, kind) -> rec, line_no of what is not the article's."""
    for batch in batches:
        recs, nos = [], []
        for rec, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines: dict[int, list[int]] = {}
            for c in cells:
                at = lines.setdefault(c["line_no"], [0, 0])
                at[0] |= c["flags"]
                at[1] = max(at[1], c["kind"])
            teasers = False
            for no in sorted(lines):
                flags, kind = lines[no]
                if kind >= TEMPLATE:
                    teasers |= kind == TEASERS  # a list may be broken by other template lines
                elif kind == 0 and teasers and not flags & SENTENCE and flags & (HEADLINE | MARKED):
                    kind = TEASERS  # an item of the list
                else:
                    teasers = False
                if kind >= TEMPLATE:
                    recs.append(rec)
                    nos.append(no)
        yield pa.RecordBatch.from_arrays([pa.array(recs, batch.schema.field(0).type), pa.array(nos, pa.int32())], names=["rec", "line_no"])


def template_lines(pages: DataFrame, key: str, host: str, body: str, salts: int = 8) -> DataFrame:
    """`key` and line_no (from 1, blank lines counted) of the lines that are not part of a page's article.

    One row per key is expected (see one_row). Null keys, hosts and bodies have no lines; an empty table gives an empty one; whole
    bodies are read; other columns are left out.
    """
    spark, at = pages.sparkSession, scratch(pages.sparkSession, "pages")
    kind = pages.schema[key].dataType.simpleString()
    src = pages.where(F.col(key).isNotNull() & F.col(host).isNotNull() & F.col(body).isNotNull()).select(F.col(key).alias("rec"), F.col(host).cast("string").alias("host"), F.col(body).alias("body"))
    src.mapInArrow(_read_pages, f"rec {kind}, host string, story bigint, line_no int, trees array<bigint>, block bigint, flags int, follow int").write.parquet(at)
    lines = spark.read.parquet(at)
    salt = F.pmod(F.xxhash64("rec"), F.lit(salts)).cast("int")
    cut = site_templates(lines).withColumn("salt", F.explode(F.array(*map(F.lit, range(salts)))))
    hit = lines.select("rec", "host", "line_no", F.explode(_trees()).alias("tree"), salt.alias("salt")).join(cut, ["host", "tree", "salt"]).select("rec", "line_no", F.lit(0).alias("flags"), "kind")
    every = lines.select("rec", "line_no", "flags", F.lit(0).alias("kind")).unionByName(hit)
    grouped = every.groupBy("rec").agg(F.collect_list(F.struct("line_no", "flags", "kind")).alias("lines"))  # the lines of one page
    return grouped.mapInArrow(_drop, f"rec {kind}, line_no int").select(F.col("rec").alias(key), "line_no")


def one_row(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Of the rows of each key the one smallest in `order`."""
    return df.groupBy(key).agg(F.min_by(F.struct(*columns), F.col(order)).alias("__x")).select(key, "__x.*")

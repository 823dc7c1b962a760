import random

from tidewire.llm.page_content import SENTENCE, _blocks, _trees_of, bare, gap_middle, read_line, template_lines

NAMES = "Ada Bel Cor Dan Eve Fay Gus Hal Ida Jon Kai Lea".split()


def sentence(r):
    return f"{r.choice(NAMES)} {r.choice(['met', 'saw', 'sold', 'built'])} {r.choice(NAMES)} near the {r.choice(['river', 'market', 'old mill'])} on day {r.randrange(9999)}, and {r.choice(NAMES)} told the paper about {r.choice(['trade', 'rain', 'work'])} {r.randrange(999)}."


def site(host, n, seed):
    """Pages of one host: text and the numbers of the lines that are not the article's."""
    r, out = random.Random(seed), []
    for i in range(n):
        lines = [("Home / World / " + f"{r.choice(NAMES)} wins the race of {r.randrange(999)}", True), (f"[Menu | News | {host}]" if i % 3 else f"menu | news | {host}", True)]
        lines += [(sentence(r), False), ("", None), (sentence(r), False)]
        if i % 25 == 0:
            lines += [("What comes next", False)]
        lines += [("- " + sentence(r), False), ("Advertisement", True), (sentence(r), False), ("Most read", True)]
        lines += [(f"{r.choice(['1. ', '> ', ''])}{r.choice(NAMES)} to open {r.choice(NAMES)} mill number {r.randrange(99999)}", True) for _ in range(3)]
        lines += [(f"{r.randrange(99)} comments", True), (f"Join {r.randrange(99)},000 readers of the {host} letter", True), ("We use cookies to keep this page running and to count visits.", True), ("  ", None)]
        out.append((f"{host}{i}", host, "\n".join(x for x, _ in lines), [k for k, (_, t) in enumerate(lines, 1) if t]))
    return out


def test_sites(spark):
    pages = site("alpha", 150, 1) + site("beta", 100, 2) + site("gamma", 100, 3)
    df = spark.createDataFrame([p[:3] for p in pages], "rec string, host string, body string")
    got = {}
    for r in template_lines(df, "rec", "host", "body").collect():
        got.setdefault(r.rec, []).append(r.line_no)
    want = {(p[0], n) for p in pages for n in p[3]}
    have = {(k, n) for k, v in got.items() for n in v}
    assert len(want & have) >= 0.99 * len(want)
    assert len(have - want) <= 0.005 * len(have)


def test_edges(spark):
    df = spark.createDataFrame([("a", "h", None, 1), ("b", "h", "", 1), (None, "h", "x", 1), ("c", None, "x\ny", 1), ("d", "h", "One lone page with a sentence in it.\n\n", 1), ("e", "h", "word " * 50_000, 1)], "rec string, host string, body string, story int")
    assert template_lines(df, "rec", "host", "body").count() == 0
    assert template_lines(df.limit(0), "rec", "host", "body").count() == 0


def test_lines():
    assert bare("  [ — Get  the app — ] ") == "Get the app" and bare("1. A b") == "A b" and bare("* * Docs >>") == "Docs"
    assert read_line("Tags: a, b, c")[1] == "tags:" and read_line("GEL 53.07 +3.7%  SUS 72.90 +0.0%  BRUR 30.29 -5.5%")[2] == "w # %"
    assert read_line("The market of the town opened again.")[3] & SENTENCE and not read_line("Read more about it")[3] & SENTENCE
    assert read_line("12 comments")[0] == read_line("3 Comments!")[0] == "# comments"


def test_blocks_and_gaps():
    rows = lambda *lines: [(i, *_trees_of(x, {})) for i, x in enumerate(lines)]
    text = "The market of the town opened again."
    a = _blocks(rows("Menu", "12 news", text, "Alone", text, "x", "y", "z"))
    b = _blocks(rows("[menu]", "7 News", text))
    assert a[0] == a[1] == b[0] == b[1] and a[2] is a[3] is a[4] is None and a[5] == a[6] == a[7] != a[0] and _blocks([]) == []
    assert gap_middle([1, 2, 9, 10], 4) == 6.0 and gap_middle([1, 2, 3], 4) is None and gap_middle([], 1) is None


def test_a_block_goes_as_a_whole(spark):
    """A heading that always stands before text would pass for the article's own, but for its block."""
    r, pages = random.Random(5), []
    for i in range(300):
        lines = [sentence(r), "Read in our app", "From the desk", sentence(r)] if i % 17 == 0 else [sentence(r), *(["From the desk"] if i % 25 == 1 else []), sentence(r)]
        pages.append((f"p{i}", "h", "\n".join(lines)))
    got = {}
    for x in template_lines(spark.createDataFrame(pages, "rec string, host string, body string"), "rec", "host", "body").collect():
        got.setdefault(x.rec, set()).add(x.line_no)
    assert {k for k, v in got.items() if 3 in v} == {f"p{i}" for i in range(0, 300, 17)}
    assert not {f"p{i}" for i in range(1, 300, 25) if i % 17} & set(got)

"""Main text, divergence of sources and the conversation trie against slow versions of them."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest

from spindrift.llm import divergence, main_text, prefix_tree

TABLES = "/root/testdata/sf0.001"


class Article(HTMLParser):
    """The blocks of ``article``, as the tables' pages are built."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.held = False, [], ""
        self.feed(html)
        self.close()
        self.end()

    def end(self):
        self.blocks += [" ".join(self.held.split())] if self.held.split() else []
        self.held = ""

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1", "footer"):
            self.end()
        self.held += " " if tag == "br" else ""

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.end()
        self.inside &= tag != "article"

    def handle_data(self, data):
        self.held += data if self.inside else ""


def test_main_text_of_the_tables(spark):
    pages = spark.read.parquet(f"{TABLES}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = main_text.extract(pages).collect()
    assert len(rows) == len(html)
    for r in rows:
        assert r["text"] == "\n".join(Article(html[r["page_id"]] or "").blocks)
        assert r["n_chars"] == len(r["text"])


LONG = "word " * 40
PAGES = {
    # an article with its own header, an advert within, lists and tables, and everything beside it
    f"""<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice"><p>{LONG}</div>
    <main><article class="post has-sidebar"><header><h1>Title &amp; more</h1><p class=byline>By me</header>
    <p>First&nbsp;para, <b>bold</b>\n here.<div class=ad>Buy</div><p>Be.<ul><li>one<li>two</ul>
    <table><tr><td>a<td>b</table></article><section id=comments><article class=comment><p>{LONG}</article></section>
    </main><aside>{LONG}</aside><form>Mail <input></form><footer>c</footer>""":
        "Title & more\nFirst para, bold here.\nBe.\none\ntwo\na b",
    # names only
    f"""<div id=menu><a href=a>Home</a> | <a href=b>About</a></div><div class=sidebarLeft><p>{LONG}</div>
    <div id=content><h1>Hi</h1><p>{LONG}</p><p>End.</p></div><div class=comments><p>{LONG}</p></div>""":
        f"Hi\n{LONG.strip()}\nEnd.",
    # neither: the surge of text after a list of links, up to the next
    f"""<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a><li><a href=4>four</a></ul>
    <h1>Hi</h1><p>{LONG}</p><p>End.</p><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>
    <p>more</p>""": f"Hi\n{LONG.strip()}\nEnd.",
    "<p>only short</p>": "only short", "": "", " \n ": "", "no markup": "no markup",
    "x < y &amp &am &notit; &#x41;&#65": "x < y & &am ¬it; AA",
    "<script>var a='</p>'</script><style>p{}</style><!-- <p>no -->": "", "<!-- open <p>a": "", "<p>cut <b cla": "cut",
    f"<form><p>{LONG}</p></form>": LONG.strip(), "<form>Name <input></form><nav>a</nav>": "",
    "</p></div></b>stray</td>": "stray", '<p title="a > b">quoted</p>': "quoted",
    f"<div class=comments><p>{LONG}</div><article><p>a</article>": "a",
}


@pytest.mark.parametrize("html", PAGES)
def test_main_text_of_made_pages(html):
    assert main_text.main_text(html) == PAGES[html]


def test_main_text_of_odd_pages(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "", "x"), (3, None, "<b>" * 50_000 + "x", "x"),
            (4, "v", "<article>" + "<p>a b" * 30_000, "x"), (5, "w", "<p>é 漢字 &#128512;</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = main_text.extract(df).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in found) == [
        (0, 0), (1, 0), (1, 0), (3, 1), (4, 4 * 30_000 - 1), (5, 6)]
    assert main_text.extract(df.limit(0)).count() == 0


def test_surges_and_dives():
    kept = main_text.between_surges(np.array([0, 5, 0, 0, 0, 90, 0, 0, 7, 0, 0, 0, 0]), window=3, surge=86)
    assert np.flatnonzero(kept).tolist() == [5, 6, 7, 8]
    kept = main_text.between_surges(np.array([0, 5, 0, 0, 0, 6]), window=3, surge=86)
    assert np.flatnonzero(kept).tolist() == [1, 5]
    assert not main_text.between_surges(np.array([], dtype=int)).any()


def slow_audit(rows, least):
    docs = [(lang or "", source or "", text or "") for text, lang, source in rows]
    counts, df = defaultdict(Counter), Counter()
    for lang, source, text in docs:
        parted = "".join(c if c.isascii() and c.isalpha() or ord(c) > 127 else " " for c in text)
        words = "".join(c.lower() if c.isascii() else c for c in parted).split(" ")
        words = [w for w in words if w]
        counts[lang, source].update(words)
        df.update({(lang, w) for w in words})
    out = set()
    for lang in {lang for lang, _ in counts}:
        terms = [t for (g, t), n in df.items() if g == lang and n >= least]
        sources = [s for g, s in counts if g == lang]
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in terms}

        def p(count):
            below = sum(count[t] for t in terms) + 2 * len(terms)
            return {t: 1 + 10**9 * (count[t] + 2) // below for t in terms}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        ps, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(-sum(f(ps[s][t], ps[o][t]) for t in terms), o.encode()) for o in sources if o != s]
            best = [(-f(ps[s][t], q[t]), t.encode()) for t in terms if counts[lang, s][t] and ps[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(best)[:10])):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)}
    return out


def docs_frame(spark, rows):
    return spark.createDataFrame([(t, g, s, 1, "x") for t, g, s in rows],
                                 "text string, lang string, source string, n long, term string")


@pytest.mark.parametrize("sizes", [{}, {"block": 3, "tile": 2}])
@pytest.mark.parametrize("sources", [5, 23])
def test_divergence(spark, sources, sizes):
    draw = random.Random(sources)
    words = ["a", "b", "Été", "C", "c", "漢字", "été", "z'z", "x1y", *[f"w{chr(97 + i % 26)}" for i in range(30)]]
    rows = [(" ".join(draw.choices(words, k=draw.randint(0, 30))), draw.choice("gh"), f"s{draw.randrange(sources)}")
            for _ in range(200)]
    rows += [(None, "g", "s0"), ("", None, None), ("a A", None, "é"), ("only", "lone", "one"), rows[0], rows[0],
             ("a\x7fb\x00c-d" + " é" * 30_000, "g", "s1")]
    found = divergence.audit(docs_frame(spark, rows), least_documents=4, **sizes)
    got = [tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == slow_audit(rows, 4)


def test_divergence_of_nothing(spark):
    assert divergence.audit(docs_frame(spark, []).limit(0)).count() == 0


def test_shares_are_exact():
    counts = np.array([0, 1, 7, 10**12], dtype=np.int64)
    for total, terms in ((10**13, 10**6), (10**15, 3), (10**16, 5), (8 + 10**12, 4)):
        expected = [1 + 10**9 * (int(c) + 2) // (total + 2 * terms) for c in counts]
        assert divergence.shares(counts, total, terms).tolist() == expected


def slow_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said = role or "", text or ""
            digest = hashlib.sha256(f"{len(said[0])}:{said[0]}{said[1]}".encode()).hexdigest()
            turns[c].append((turn is not None, turn, digest, said))
    turns = {c: [t[-1] for t in sorted(t, key=lambda t: (t[0], t[1] or 0, t[2]))] for c, t in turns.items()}
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    built = {c: turns.get(c - c % 100, [])[:h(c)] + t[h(c):] for c, t in turns.items()}
    members = defaultdict(list)
    for c, t in sorted(built.items()):
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    ends = {p: ",".join(str(c) for c in m if len(built[c]) == len(p)) for p, m in members.items()}
    return {(m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
             hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in members.items()}


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(kind):
    draw = random.Random(7)
    if kind == "mixed":
        rows = [(draw.randrange(260), draw.choice([None, 0, 1, 2, 3]), draw.choice(["u", "a", None]),
                 draw.choice(["x", "y", "", None, "é" * 5])) for _ in range(1500)]
        return rows + rows[:5] + [(None, 0, "u", "x")]
    if kind == "copies":
        return [(c, t, "u", f"t{t}") for c in range(120) for t in range(6)] + [(500, t, "u", "z") for t in range(3)]
    # one conversation holds most turns, and others leave it at every depth
    return [(0, t, "u", f"t{t}") for t in range(300)] + [
        (c, t, "u", f"t{t}" if t < c else "x") for c in range(1, 60) for t in range(c + 2)]


@pytest.mark.parametrize("kind", ["mixed", "copies", "deep"])
@pytest.mark.parametrize("options", [{}, {"limit": 40, "rows_per_slice": 50}])
def test_trie(spark, kind, options):
    rows = conversations(kind)
    df = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, key string")
    found = [tuple(r) for r in prefix_tree.rollup(df, **options).select(COLUMNS).collect()]
    assert len(found) == len(set(found)) and set(found) == slow_trie(rows)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([(None, 1, "u", "x")], "conv_id long, turn long, role string, text string")
    assert prefix_tree.rollup(df).count() == 0


def test_centroid_totals_take_few_steps():
    """A path, a star and random trees against sums from the leaves up."""
    draw = random.Random(3)
    for parents in ([-1, *range(400)], [-1] + [0] * 400, [-1, *[draw.randrange(i) for i in range(1, 400)]]):
        depth = [0] * len(parents)
        for i, p in enumerate(parents[1:], 1):
            depth[i] = depth[p] + 1
        order = sorted(range(len(parents)), key=depth.__getitem__)
        place = {v: i for i, v in enumerate(order)}
        up = [place.get(parents[v], -1) for v in order]
        own = [draw.randint(1, 5) for _ in order]
        values = [(draw.randrange(9), draw.randrange(9)) for _ in order]
        weight, sums = own[:], [list(v) for v in values]
        for i in range(len(order) - 1, 0, -1):
            weight[up[i]] += weight[i]
            sums[up[i]] = [a + b for a, b in zip(sums[up[i]], sums[i])]
        assert prefix_tree.centroid_totals(up, weight, values) == sums

import html
import re
import time
from html.parser import HTMLParser

import duckdb
import pytest
from compare import DATA

from fernweave.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class="page"><header>Site</header>
<nav><ul><li><a href=x>Menu</a></ul></nav><div id="cookie-notice">Cookies</div><div class="wrap"><div class="post-12"><h1>T &amp; &eacute;</h1>
<p>Hello <b>wor</b>ld &lt;a&gt;,\n\n this is a paragraph.<br>Next<p>Two&nbsp;three<!-- no --><ul><li>a<li>b</ul>
<script>if (a < b) { "</p>" }</script><div class="share-buttons">Share</div><form>Form <input></form></div></div>
<aside>Side</aside><section class=comments><article class=comment><p>A reader says a lot of things that are much longer than the article itself, again and again and again and again.</p></article></section>
<footer>&copy; end</footer>"""
TEXT = "T & é\n\nHello world <a>, this is a paragraph. Next\n\nTwo three\n\na\n\nb"


def test_page_with_everything():
    assert H.extract(PAGE, None) == TEXT
    page = H.parse(PAGE)
    assert H.named(page, H.best(page)) == "/html/body.page/div.wrap/div.post-#" and H.vote(PAGE) == page.path[H.best(page)]


def test_fragments():
    assert H.extract(None, None) == H.extract("", None) == H.extract("<script>x", None) == H.extract("<!-- x", None) == ""
    assert H.extract("plain <b>text</b> a < b", None) == "plain text a < b"
    assert H.extract("<p>one<p>two", None) == "one\n\ntwo"
    assert H.extract('<p title="a>b">x</p><p title=\'a>b\'>y</p><p title="open>z</p>', None).startswith("x\n\ny")
    assert H.extract("<article><p>" + "long " * 200_000 + "</article>", None) == ("long " * 200_000).strip()


def test_every_generated_page():
    for url, page in duckdb.sql(f"SELECT url, html FROM read_parquet('{DATA}/pages.parquet')").fetchall():
        inside = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        assert H.extract(page, hashed("/html/body/article")) == "\n\n".join(b for b in blocks if b)


def hashed(path):
    out = 0
    for step in path.split("/")[1:]:
        out = H.further(out, step)
    return out


class Tree(HTMLParser):
    """A plain version for pages without layout marks: a tree by the library's parser, scores by walking up from each block."""

    def __init__(self, page):
        super().__init__()
        self.nodes, self.open, self.words, self.link, self.blocks = [(None, "", "", False)], [0], [], 0, []
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.words).split())
        if text:
            self.blocks.append((self.open[-1], text, self.link))
        self.words, self.link = [], 0

    def handle_data(self, data):
        if not any(self.nodes[i][1] in ("script", "style", "title") for i in self.open):
            self.words.append(data)
            self.link += len(data) * any(self.nodes[i][1] == "a" for i in self.open)

    def handle_starttag(self, tag, attrs):
        if tag in H.BLOCK:
            self.flush()
        if tag == "br":
            self.words.append(" ")
        if tag in H.VOID:
            return
        if tag in H.ENDS_P and any(self.nodes[i][1] == "p" for i in self.open):
            self.handle_endtag("p")
        up, attrs = self.open[-1], dict(attrs)
        classes = sorted({re.sub(r"\d+", "#", c) for c in (attrs.get("class") or "").lower().split()})
        marks = re.findall("[a-z]+", " ".join(attrs.get(a) or "" for a in ("class", "id", "role")).lower())
        aside = self.nodes[up][3] or tag in H.ASIDE or bool(set(marks) & H.MARKS)
        step = f"/{tag}{'.' if classes else ''}{'.'.join(classes)}" if tag in H.BLOCK else ""
        self.nodes.append((up, tag, self.nodes[up][2] + step, aside))
        self.open.append(len(self.nodes) - 1)

    def handle_endtag(self, tag):
        if tag in H.BLOCK:
            self.flush()
        for n in range(len(self.open) - 1, 0, -1):
            own = self.nodes[self.open[n]][1]
            if own == tag:
                del self.open[n:]
            if own == tag or (tag not in H.BLOCK and own in H.BLOCK):
                return

    def up(self, at):
        while at is not None:
            yield at
            at = self.nodes[at][0]

    def best(self):
        scores = {}
        for at, text, link in self.blocks:
            weight = max(0, len(text) - 2 * link)
            for x in self.up(at):
                if not self.nodes[at][3] and self.nodes[x][1] not in H.LEAF and self.nodes[x][1] in H.BLOCK | {""}:
                    first = self.nodes[x][1] in ("article", "main") and not any(self.nodes[y][1] in ("article", "main") for y in list(self.up(x))[1:])
                    scores[x] = scores.get(x, 0) + weight * (1.25 if first else 1)
                    weight /= 2
        return min(scores, key=lambda x: (-scores[x], x)) if scores else None

    def text(self, tops):
        return "\n\n".join(t for at, t, _ in self.blocks if not self.nodes[at][3] and set(self.up(at)) & tops)


def brute(rows):
    """The winning path of each host by a plain count over plain trees, then the extraction."""
    votes, trees = {}, [Tree(page or "") for _, _, page in rows]
    hosts = [(re.match(r"(?s).*?://([^/?#]*)", u or "") or ["", ""])[1].lower() for _, u, _ in rows]
    for host, tree in zip(hosts, trees, strict=True):
        top = tree.best()
        if top:
            votes.setdefault(host, []).append(tree.nodes[top][2])
    won = {h: min(set(p), key=lambda x: (-p.count(x), hashed(x))) for h, p in votes.items()}
    out = []
    for (k, u, _), host, tree in zip(rows, hosts, trees, strict=True):
        tops = {i for i, n in enumerate(tree.nodes) if n[1] in H.BLOCK and n[2] == won.get(host) and not n[3]}
        text = tree.text(tops)
        if not text and (top := tree.best()) is not None:
            text = tree.text({top})
        out.append((k or 0, u or "", text))
    return sorted(out)


def test_query_equals_plain_version(spark):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM read_parquet('{DATA}/pages.parquet')").fetchall()
    out = H.op4_html_extract(spark, DATA).collect()
    assert sorted((r["page_id"], r["url"] or "", r["text"]) for r in out) == brute(rows)


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 350_000,
        '<a "' * 250_000,
        '<a "' * 250_001 + ">",
        "<div>word text " * 70_000,
        "<div>" * 200_000,
        "<p><b>" * 150_000,
        "<script " * 120_000,
        "<" * 1_000_000,
        "<" + "a" * 1_000_000,
        "<p><button>" + "<i>" * 50_000 + "<div>" * 50_000,
        "<span>" * 150_000 + "</div>" * 1000,
    ],
)
def test_malformed_pages_take_linear_time(page):
    began = time.process_time()
    H.extract(page, H.vote(page))
    assert time.process_time() - began < 5


def test_text_behind_a_tag_that_does_not_end():
    assert H.extract('<p>one</p><p title="open>two</p><p>three</p>', None) == "one\n\ntwo\n\nthree"
    assert H.extract("<p>one</p><script>no</script><p>a <b <i>two</i> <script>x < y</script></p><!-- no --><a ", None) == "one\n\na two"


def test_repeated_rows_vote_and_come_out_each(spark, folder):
    rows = [(1, "http://h/", other("main"))] * 3 + [(2, "http://h/", other("main"))]
    out = H.op4_html_extract(spark, folder(pages=rows)).collect()
    assert sorted((r["page_id"], r["url"], r["text"]) for r in out) == brute(rows) and len(out) == 4


def other(name):
    return f"<html><body><div class={name}><p>{name} text that is long enough to count</p></div><div class=list><p>{'other text ' * 3}</p></div></body></html>"


def test_hosts_vote(spark, folder):
    rows = [(i, "http://h/a", other("main")) for i in range(3)]
    # Alone this page would take the longer list; its host's pages say otherwise.
    rows += [(4, "http://H/b?x", "<html><body><div class=main><p>short one</p></div><div class=list><p>" + "noise " * 50 + "</p></div></body></html>")]
    rows += [(5, None, "<div><p>x &amp; y</p></div>"), (6, "no scheme", None), (7, "http://g", ""), (None, "http://g/", "<p>x</p>")]
    out = H.op4_html_extract(spark, folder(pages=rows)).collect()
    assert sorted((r["page_id"] or 0, r["url"] or "", r["text"]) for r in out) == brute(rows)
    assert {r["page_id"]: r["text"] for r in out}[4] == "short one"
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_shuffled_hosts_and_empty_table(spark, folder, monkeypatch):
    monkeypatch.setattr(H, "BROADCAST_HOSTS", -1)
    assert H.op4_html_extract(spark, folder(pages=[])).count() == 0
    df = spark.createDataFrame([(1, "http://h/", PAGE, "clash")], "page_id long, url string, html string, text string")
    assert H.extract_text(df).first()["text"] == TEXT


def test_marks_on_the_layout_do_not_discard_the_article():
    aside = "<div class=sidebar><p>Side text</p></div><div class='related-posts'><article><p>One</p></article><article><p>Two</p></article></div>"
    for opening in (
        "<div class='content has-sidebar'>",
        "<div id='main' class='no-ads'>",
        "<article class='post comments-open tag-search'>",
        "<div class='sidebar-layout'><article>",
        "<div class='header-banner-wrap'><main>",
        "<div class=widget><main>",
        "<div class='page-search'>",
    ):
        page = f"<html><body><nav>Menu</nav>{opening}<h1>Title</h1><p>The whole article, which is longer than all the rest.</p><div class=comments><p>A reader</p></div>"
        for tag in ("article", "main", "div"):
            page += f"</{tag}>" * opening.count(f"<{tag}")
        assert H.extract(page + aside, None) == "Title\n\nThe whole article, which is longer than all the rest.", opening
        assert H.vote(page + aside) is not None


def test_marks_do_not_leave_a_page_without_text():
    assert H.extract("<body><nav>Menu</nav><div class=search><p>All there is</p></div></body>", None) == "All there is"
    longer = "<p>" + "A reader says much. " * 20 + "</p>"
    assert H.extract(f"<article><p>Short article</p></article><div class=comment-list>{longer}</div>", None) == "Short article"


LONG = "A paragraph of the article that goes on for a while, with commas, and ends. "
#: Hand-written layouts: html of the body, blocks that must come out (the rest must not).
LAYOUTS = {
    "siblings that share a class": (f"<div class='part one'><p>{LONG * 3}</p></div><div class='part two'><p>{LONG}two</p></div><div class=related><p>{LONG}no</p></div>", [LONG * 3, LONG + "two"]),
    "siblings without a class": (f"<div><p>{LONG * 2}</p></div><div><p>{LONG}b</p></div><div class=sidebar>{LONG}</div>", [LONG * 2, LONG + "b"]),
    "headline beside the content": (f"<nav>Menu</nav><h1>The headline</h1><div class=content><p>{LONG}</p><p>{LONG}2</p></div><footer>f</footer>", ["The headline", LONG, LONG + "2"]),
    "headline above what holds it": (f"<h1>The headline</h1><div class=row><div class=col><p>{LONG}</p><p>{LONG}2</p></div><div class=rail>{LONG}</div></div>", ["The headline", LONG, LONG + "2"]),
    "lead beside the content": (f"<h1>Head</h1><p>A lead tells it all.</p><div class=content><p>{LONG}</p><p>{LONG}2</p></div>", ["Head", "A lead tells it all.", LONG, LONG + "2"]),
    "links before the content": (f"<p><a href=x>Home</a> <a href=y>News</a></p><div class=content><p>{LONG * 2}</p></div>", [LONG * 2]),
    "a page in a form": (f"<form id=aspnetForm><div id=top><a href=x>Home</a></div><div class=content><h1>Head</h1><p>{LONG}</p></div><input><select><option>x</select></form>", ["Head", LONG]),
    "a search form and a sign-up": (f"<form><p>Search the site</p></form><div class=content><p>{LONG}</p><form><p>Sign up for our letters</p></form></div>", [LONG]),
    "marks in names of prose": (f"<article><p>{LONG}</p><p class=share-price>The price rose to 10.</p><p class='ad-label'>Advert</p><p class=share>Share this</p></article>", [LONG, "The price rose to 10."]),
    "inline asides": ("<article><p>One <span class=advert>BUY NOW</span>two <span hidden>unseen</span><button>Press</button>three <a class='share-link' href=x>Share</a>four.</p></article>", ["One two three four."]),
    "inline asides in code": ("<article><p>Some words on this program here.</p><pre>x = 1 <span class=comment># one</span></pre></article>", ["Some words on this program here.", "x = 1 # one"]),
    "styles that hide": (f"<article><p>{LONG}</p><p style='color:red; display: none'>Unseen</p><p>a <b style=visibility:hidden>no</b>b</p></article>", [LONG, "a b"]),
    "comments of readers": (f"<article><p>{LONG}</p></article><div id=comments><h2>Comments</h2><div class=comment><p>{LONG * 5}</p></div></div>", [LONG]),
    "boxes and bylines": (f"<div class=wrapper><div class='newsletter-box'>Letters</div><div class=post-body><p>{LONG}</p><div class=promo>{LONG}</div><p>{LONG}2</p></div></div>", [LONG, LONG + "2"]),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_hand_written_layouts(name):
    body, expected = LAYOUTS[name]
    page = f"<html><head><title>No</title></head><body>{body}</body></html>"
    assert H.extract(page, None).split("\n\n") == [" ".join(t.split()) for t in expected]
    assert H.extract(page, H.vote(page)).split("\n\n") == [" ".join(t.split()) for t in expected]


def test_a_teaser_does_not_replace_a_page_s_own_article(spark, folder):
    teaser = "<html><body><div class=teaser><p>Teaser only.</p></div>{}</body></html>"
    article = f"<div class=story-text><p>{LONG * 10}</p></div>"
    rows = [(i, "http://h/", teaser.format("")) for i in range(6)] + [(9, "http://h/long", teaser.format(article))]
    out = {r["page_id"]: r["text"] for r in H.op4_html_extract(spark, folder(pages=rows)).collect()}
    assert out[1] == "Teaser only." and out[9] == (LONG * 10).strip()


def test_rejected_paths(spark, folder):
    rows = [(i, "http://h/a", other("main")) for i in range(3)] + [(4, "http://h/b", "<div><p>alone</p></div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = H.winning_paths(H.path_counts(df, "url", "html")).collect()
    assert [(r["path"], r["rejected"]) for r in found] == [(hashed("/html/body/div.main"), sorted([hashed("/html/body"), hashed("/html"), hashed("/html/body/div.list")]))]


def test_clashing_columns(spark):
    df = spark.createDataFrame([("http://h/", PAGE, 1, "x", "y", "z")], "url string, html string, `__host` int, `__h` string, TEXT string, `__paths` string")
    out = H.extract_text(df)
    assert out.columns == ["url", "html", "__host", "__h", "__paths", "text"] and out.first()["text"] == TEXT

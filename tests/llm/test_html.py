import math
import random
from collections import Counter

import pytest
from conftest import rows
from leasewise.llm import html


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("<p>a &amp; b&nbsp;c &#233;&lt;p&gt;</p>", "a & b c é<p>"),
    ("<article><h1> T </h1><p>one\n two</p></article><footer>f</footer>", "T\none two"),
    ("<nav><ul><li>m</ul></nav><div class='ad'>x</div><article><p><b>bold <i>it</i> text<br><p>next</p></article>", "bold it text\nnext"),
    ("<script>var t='<p>no</p>';</script><style>p{}</style><p>yes</p><!-- <p>no</p> --><form><p>no<input value='>'></form>", "yes"),
    ("<body><header>h</header><main><header><h1>kept</h1></header><p>t</p><aside>s</aside><section id='comments'><p>c</p></section></main>", "kept\nt"),
    ("<div class='cookie-notice'>n</div><div class='post'><p>a</p><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></div>", "a\nx\ny\n1\n2"),
    ("<p>unclosed <b>b<div>d</div>", "unclosed b\nd"), ("<p title='a > b'>q</p>", "q"), ("a < b and c > d", "a < b and c > d"),
    ("<div hidden>h</div><div style='display: none'>n</div><div role='navigation'>r</div><p>v</p>", "v"),
    ("<article>x<script>never closed <p>no", "x"), ("<ARTICLE><P>Up</P></ARTICLE>", "Up"), ("<p>one <button>no</button> block <label>no</label>stays</p>", "one block stays"),
])
def test_main_text(page, want):
    assert html.main_text(page) == want


def site(host, pages, seed):
    """Pages whose template only the tree can tell: no element says what it is."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    out = []
    for k in range(pages):
        body = [" ".join(word() for _ in range(20)) for _ in range(3)]
        out.append((f"https://{host}/p{k}", "<html><body><div class='top'><p>Our shop since 1900</p><p>Call us</p></div><div class='txt'>" + "".join(f"<p>{b}</p>" for b in body)
                    + f"</div><div class='low'><p>Terms apply</p></div></body></html>", "\n".join(body)))
    return out


def test_tree_finds_the_template(spark):
    pages = site("a.example", 12, 1) + site("b.example", 3, 2)
    frame = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(pages)], "page_id long, url string, html string")
    tree = {(r.host, r.path): r for r in html.style_tree(frame).collect()}
    assert tree["a.example", "/html/body/div.top"].importance < 0.1 < 0.8 < tree["a.example", "/html/body/div.txt"].importance
    assert tree["a.example", "/html/body/div.top"].pages == 12
    got = {r.page_id: r.text for r in html.main_texts(frame).collect()}
    for i, (_, _, body) in enumerate(pages):
        if i < 12:
            assert got[i] == body
        else:  # three pages are not enough to tell
            assert got[i] == f"Our shop since 1900\nCall us\n{body}\nTerms apply"


def test_tree_judges_every_element(spark):
    """Also what no list names inside an article, and menus whatever they are called; a shared story stays."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    body = [" ".join(word() for _ in range(30)) for _ in range(12)]
    page = lambda b: f"<html><body><div class='m1'><ul><li>Home<li>Shop</ul></div><article><h1>{b[:20]}</h1><p>{b}</p><div class='x9'><p>Liked it? Tell us</p></div></article><footer>(c) shop</footer></body></html>"
    story = "<html><body><article><p>the same story</p><p>of all pages</p></article><footer>{}</footer></body></html>"
    rows_ = [(k, f"http://a.example/{k}", page(b)) for k, b in enumerate(body)] + [(100 + k, f"http://b.example/{k}", story.format(k)) for k in range(12)]
    got = {r.page_id: r for r in html.main_texts(spark.createDataFrame(rows_, "page_id long, url string, html string")).collect()}
    for k, b in enumerate(body):
        assert got[k].text == f"{b[:20]}\n{b}" and got[k].n_low == len("Home" + "Shop" + "Liked it? Tell us" + "(c) shop")
    assert all(got[100 + k].text == "the same story\nof all pages" for k in range(12))


def plain_tree(pages):
    """(path -> pages, importance) of one host, from the definition, page by page."""
    shown, ways, says, kids = {}, {}, {}, {}
    for page in set(pages):
        found, every = html.blocks(page)
        styles = {(e.path, tuple(e.children)) for e in every if e.children}
        texts = {(e.path, t) for e, t in found}
        for path in {x for x, _ in styles | texts}:
            shown[path] = shown.get(path, 0) + 1
        for x in styles:
            ways.setdefault(x[0], []).append(x[1])
        for x in texts:
            says.setdefault(x[0], []).append(x[1])
    for path in shown:
        if path:
            kids.setdefault(path.rpartition("/")[0], []).append(path)

    def importance(path):
        m = shown[path]
        parts = [sum(importance(k) for k in kids[path]) / len(kids[path])] if path in kids else []
        if path in says:
            parts.append(1 - sum(math.log(n) / math.log(m) if m > 1 else 0 for n in Counter(says[path]).values()) / len(set(says[path])))
        inner = sum(parts) / len(parts) if parts else 1.0
        if path not in ways:
            return inner
        counts = Counter(ways[path]).values()
        style = -sum(n / sum(counts) * math.log(n / sum(counts)) for n in counts) / math.log(m) if m > 1 else 1.0
        damp = html.GAMMA ** len(counts)
        return (1 - damp) * style + damp * inner

    return {path: (shown[path], importance(path)) for path in shown}


def test_importance_against_plain_recomputation(spark):
    draw = random.Random(9)
    tags = ["div", "p", "nav", "article", "section class=a", "div class='b c'", "footer", "ul"]

    def some(depth):
        if depth == 0 or draw.random() < 0.3:
            return draw.choice(["same text", "other text", str(draw.randint(0, 9)), ""])
        return "".join(f"<{t}>{some(depth - 1)}</{t.split()[0]}>" for t in draw.choices(tags, k=draw.randint(1, 3)))

    pages = [f"<html><body>{some(4)}</body></html>" for _ in range(25)]
    pages += pages[:5]
    frame = spark.createDataFrame([(i, f"http://h.example/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r.path: (r.pages, round(r.importance, 9)) for r in html.style_tree(frame).collect()}
    assert got == {k: (n, round(v, 9)) for k, (n, v) in plain_tree(pages).items()} and len(got) > 40


def test_copies_do_not_make_a_template(spark):
    """Copies of a page count once, under one address or many."""
    copies = [(i, "http://c.example/x", "<html><body><div class='t'><p>only text</p></div></body></html>") for i in range(20)]
    articles = [(100 + i, f"http://d.example/{i}", "<html><body><article><p>the same story</p></article></body></html>") for i in range(20)]
    frame = spark.createDataFrame(copies + articles, "page_id long, url string, html string")
    assert {r.text for r in html.main_texts(frame).collect()} == {"only text", "the same story"}


def test_rows_of_any_kind(spark):
    rows_ = [(None, None, None, 1, "h", "p"), (1, "no host", "", 1, "h", "p"), (2, "http://[bad", "<p>x</p>", 1, "h", "p"), (2, "http://[bad", "<p>x</p>", 1, "h", "p"),
             (3, "HTTPS://User@Host.Example:80/a", "<p>" + "long text " * 50_000 + "</p>", 1, "h", "p"), (4, "http://e", "<div>" * 300 + "deep" + "</div>" * 300, 1, "h", "p")]
    frame = spark.createDataFrame(rows_, "page_id long, url string, html string, text int, host string, paths string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html.main_texts(frame).collect()}
    assert got[None, None] == ("", 0) and got[1, "no host"] == ("", 0) and got[2, "http://[bad"] == ("x", 1)
    assert got[3, "HTTPS://User@Host.Example:80/a"] == (("long text " * 50_000).strip(), 499_999) and got[4, "http://e"] == ("deep", 4)
    assert html.main_texts(frame).count() == len(rows_) and html.main_texts(frame.filter("false")).count() == 0

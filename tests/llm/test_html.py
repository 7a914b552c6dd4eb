import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfsight.llm.html_extract import extract_main_text, host_of, main_text, style_tree

BODY = "<p>{a}<p>More &amp; <b>bold</b>&nbsp;text<br>here {a}</p>"


def site(n, host="one.example.com"):
    rows = []
    for i in range(n):
        html = (
            f"<html><head><title>t</title><style>x</style></head><body><div id=top>Our site</div><div class=col><span>Follow us</span> now</div>"
            f"<div class=box><h1>Title {i}</h1>{BODY.format(a=f'word{i}')}</div><div class=legal-note>All rights held</div></body></html>"
        )
        rows.append((i, f"http://{host}/p/{i}", html))
    return rows


@pytest.mark.parametrize(("html", "want"), [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\nb"), ("<div>x<p>y</p>z</div>", "x\ny\nz"),
    ("<p>1 &lt; 2 &eacute;&#233;&#x27;</p>", "1 < 2 éé'"), ("<script>var t='</p>';</script><p>a</p>", "a"), ("<p>a<!-- no --> b</p>", "a b"),
    ("<nav><a>x</a></nav><header>h</header><article><header><h1>T</h1></header><p>a</p></article><footer>f", "T\na"),
    ("<article><p>a</p><aside>no</aside><div class='comments'><article><p>mine</p></article></div><form>f</form><p>b", "a\nb"),
    ("<main><p>a</main><p>outside", "a"), ("<div class='ad'>buy</div><p>a</p>", "a"), ("<p>a <span class='ad-slot'>buy</span> b</p>", "a\nb"),
    ("<div class=cookieNotice>c</div><div class=Sidebar>s</div><p>a", "a"), ("<ul><li>1<li>2</ul>", "1\n2"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<article><p><b>Head.<br><p>Next <i>one</b></p></article></html", "Head.\nNext one"),
    ("</div></p><p>a</section>b", "ab"), ("<div hidden>x</div><p>a", "a"), ("<article>" * 400 + "deep", "deep"), ("<p>a" * 3000, "\n".join(["a"] * 3000)),
    ("<template>x</template><textarea>y</textarea><p>é  x", "é x"), ("<p>shared adverbs</p><p class=shadow>ok", "shared adverbs\nok"),
])
def test_one_page(html, want):
    assert main_text(html, set()) == want


@pytest.mark.parametrize(("html", "want"), [
    ("<h1 class=article-title>T</h1><div class=post-body><p>one two</p></div>", "T\none two"),
    ("<h1 class=main-title>T</h1><div class=article-meta>m</div><img class=entry-main-image><p>text", "T\nm\ntext"),
    ("<div role=main><p>a</div><p>outside", "a"),
    *[(f"<html><body class='{c}'><p>all the text</p></body></html>", "all the text")
      for c in ("single has-sidebar", "no-sidebar", "menu-open", "layout-with-sidebar", "article social-news")],
    *[(f"<div class='{c}'><p>all the text</p></div><p>end", "all the text\nend") for c in ("has-sidebar", "menu-open", "article social-news")],
    ("<div class=menu-open><article class=social-news><p>a</p></article><p>b b b b</div>", "a"),
    ("<article><p>a b c</article><div class=comments><article>d</article></div>", "a b c"),
    ("<div class=promo-a><article>a</article></div><div class=promo-b><article>b</article></div><div class=promo-c><article>c</article></div>", "a\nb\nc"),
    ("<article><div class=social-body><p>a b c</div><div class=promo>d</div></article>", "a b c"),
    ("<form id=aspnetForm><input name=q><article><h1>T</h1><p>the text</p></article></form>", "T\nthe text"),
    ("<form id=aspnetForm><h1>T</h1><p>the text</p><button>Send</button><label>Name</label><select><option>x</select></form>", "T\nthe text"),
    ("<form><nav>menu</nav><fieldset><p>the whole text of it</p></fieldset></form>", "the whole text of it"),
    ("<article><p>the text of it</p><form><p>Write to us</p><label>Name</label></form></article>", "the text of it"),
    ("<article><p>one two three</p><p class=notice-period>of three months</p><p class=share-price>is 7</p></article>", "one two three\nof three months\nis 7"),
    ("<article><p>one two three</p><p class=notice>n</p><div class='ad-box2'>a</div><div id=left_sidebar>s</div><ul class=commentList><li>c</ul></article>", "one two three"),
])
def test_names_drop_no_main_text(html, want):
    assert main_text(html, set()) == want


def texts(frame):
    return {r.page_id: r.text for r in extract_main_text(frame).collect()}


def test_repeated_branches_go(spark):
    made = spark.createDataFrame(site(12) + [(100, "https://small.example.com/x", site(1)[0][2]), (101, None, "<p>alone"), (102, "odd", None)],
                                 "page_id long, url string, html string").repartition(3)
    got = texts(made)
    for i in range(12):
        assert got[i] == f"Title {i}\nword{i}\nMore & bold text here word{i}"
    assert got[100].startswith("Our site\nFollow us now\nTitle 0") and got[101] == "alone" and got[102] == ""


def test_copies_of_an_article_stay(spark):
    """A site may show one article many times; marked content is no template for that."""
    rows = [(i, "http://a.example.com/", "<nav>m</nav><article><p>The same text</p><p class=share-bar>s</p></article>") for i in range(20)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert set(texts(made).values()) == {"The same text"}


def test_repeated_branches_in_marked_content_go(spark):
    """Unnamed or not: a notice on every page is a template, and the article around it is none, though many show it."""
    notice = "<section><p>All rights held</p><ul><li>Write to us<li>Report this</ul></section>"
    rows = [(i, "http://a.example.com/", f"<div>frame {i}</div><article><h1>Title {i % 8}</h1><p>word{i % 8} here</p>{notice}</article>") for i in range(40)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert texts(made) == {i: f"Title {i % 8}\nword{i % 8} here" for i in range(40)}
    same = [(i, u, html) if i % 8 else (i, u, rows[0][2].replace("frame 0", f"frame {i}")) for i, u, html in rows]
    many = spark.createDataFrame(same + [(i + 100, u, rows[0][2].replace("frame 0", f"frame {i}")) for i, u, _ in rows], "page_id long, url string, html string")
    assert texts(many)[100] == "Title 0\nword0 here"


def test_importance_by_hand(spark):
    rows = [(i, "http://h.example.com/", f"<div class=x><p>same</p><h2>own {i // 2}</h2></div>") for i in range(8)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string").select(host_of(F.col("url")).alias("host"), "html")
    got = sorted(round(r.importance, 9) for r in style_tree(made).collect())
    # texts: 'same' is on all pages (entropy 1), each own text on 2 of 8 pages (1/3); children never differ
    own = 0.9 * (1 - 1 / 3)
    whole = 0.9 * (1 - (1 + 4 / 3) / 5)
    assert got == [round(x, 9) for x in sorted([0.0, own, whole, whole])]
    assert math.isclose(math.log(2) / math.log(8), 1 / 3)


def test_columns_and_rows(spark):
    rows = site(6)
    made = spark.createDataFrame(rows + rows, "page_id long, url string, html string")
    more = made.select("*", *[F.lit("x").alias(c) for c in ("text", "host", "_host", "_paths", "path", "n")])
    got = extract_main_text(more)
    assert sorted(got.columns) == sorted(more.columns)
    assert Counter(r.text for r in got.collect()) == Counter(r.text for r in extract_main_text(made).collect())
    assert extract_main_text(made.limit(0)).count() == 0


def test_hosts(spark):
    urls = ["http://A.b/c", "https://u:p@x.y:80/z", "ftp://q?x", "//n/x", "no", None, "http://é.fr#t"]
    made = spark.createDataFrame([(u,) for u in urls], "url string").select(host_of(F.col("url")).alias("h"))
    assert [r.h for r in made.collect()] == ["a.b", "x.y", "q", "", "", "", "é.fr"]


def plain_tree(pages):
    """The style tree of one host by plain sums: importance by the tags and names from the root down."""
    shown, texts = {}, {}

    def walk(page, node, above):
        path = (*above, (node.tag, *node.names))
        shown.setdefault(path, Counter())[tuple("#" if isinstance(c, str) else (c.tag, *c.names) for c in node.children)] += 1
        for child in node.children:
            if isinstance(child, str):
                for n in range(len(path)):
                    texts.setdefault(path[: n + 1], {}).setdefault(child, Counter())[page] += 1
            else:
                walk(page, child, path)

    for number, root in enumerate(pages):
        walk(number, root, ())
    entropy = lambda counts: -sum(n / sum(counts) * math.log(n / sum(counts)) for n in counts)
    top = math.log(len(pages))
    found = []
    for path, kinds in shown.items():
        spreads = [entropy(list(c.values())) / top for c in texts.get(path, {}).values()]
        content = 1 - (sum(spreads) / len(spreads) if spreads else 0)
        found.append(0.1 * min(1, entropy(list(kinds.values())) / top) + 0.9 * content)
    return sorted(round(x, 9) for x in found)


class Plain:
    def __init__(self, tag, names, children):
        self.tag, self.names, self.children = tag, names, children

    def html(self):
        inside = "".join(c if isinstance(c, str) else c.html() for c in self.children)
        return inside if not self.tag else f"<{self.tag}{' class=' + self.names[0] if self.names else ''}>{inside}</{self.tag}>"


def random_tree(rng, depth=0):
    children = []
    for _ in range(rng.randrange(1, 4)):
        if depth < 3 and rng.random() < 0.6:
            children.append(random_tree(rng, depth + 1))
        elif not children or not isinstance(children[-1], str):
            children.append(rng.choice(["same words", "other words", f"own {rng.randrange(30)}"]))
    return Plain(rng.choice(["div", "section"]), rng.choice([(), ("x",), ("y",)]), children)


def test_random_sites_by_plain_sums(spark):
    import random

    rng = random.Random(4)
    made, want = [], {}
    for host in ("a", "b", "c"):
        pages = [Plain("", (), [random_tree(rng) for _ in range(rng.randrange(1, 3))]) for _ in range(9)]
        made += [(f"http://{host}/", p.html()) for p in pages]
        want[host] = plain_tree(pages)
    frame = spark.createDataFrame(made, "url string, html string").repartition(5).select(host_of(F.col("url")).alias("host"), "html")
    got = {}
    for r in style_tree(frame).collect():
        got.setdefault(r.host, []).append(round(r.importance, 9))
    assert {h: sorted(v) for h, v in got.items()} == want and sum(map(len, want.values())) > 60

"""Wrapper inference on hand-made templates, and extraction against what was put in."""

import html
import random

from tradewake.llm import wrappers
from tradewake.llm.common import Stage


def host_wrapper(pages):
    total = None
    for p in pages:
        w = wrappers._leaf(wrappers.parse(p), False, {})
        total = w if total is None else wrappers._merge(total, w)
    return wrappers.judge(total)


def words(rnd, n):
    return " ".join(rnd.choices(["alpha", "be & ta", "gam<ma", "d\"elta", "été", "x > y"], k=n))


def shop(rnd, template):
    """A page and its article text."""
    blocks = [words(rnd, rnd.randint(1, 30)) for _ in range(rnd.randint(1, 6))]
    e = html.escape
    nav = "<nav><ul>" + "".join(f"<li><a href='/{i}'>{e(words(rnd, 1))}</a></li>"
                                for i in range(rnd.randint(1, 7))) + "</ul></nav>"
    title = words(rnd, 3)
    if template == "article":
        body = (f"<article><h1>{e(title)}</h1>" + "".join(
            f"<p>{e(b[:len(b) // 2])}<b>{e(b[len(b) // 2:])}</b></p>" for b in blocks)
            + "<div class='share-buttons'>Share me</div>"
            + ("<aside>See also</aside>" if rnd.random() < .5 else "")
            + "<section id=comments><p>First! said someone</p></section></article>")
        want = [title, *blocks]
    elif template == "named":
        body = ("<div class=wrap><div class='side bar sidebar'><p>Some long text at the side " * 1
                + "of the page that is no article.</p></div><div class='post-content'>"
                + "".join(f"<p>{e(b)}" for b in blocks) + "</div></div>")
        want = blocks
    else:
        body = ("<table><tr><td><a href=x>" + e(words(rnd, 20)) + "</a></td><td><div>"
                + "<br>".join(e(b) for b in blocks) + f" {e(words(rnd, 40))}"
                + "</div></td></tr></table>")
        want = None
    if rnd.random() < .3:
        nav = "<div class='cookie-notice'><p>We use cookies</p></div>" + nav
    page = (f"<!DOCTYPE html><html><head><title>{e(title)}</title><style>p{{}}</style>"
            f"<script>var t='</p>';</script></head><body><header><p>Site name</p></header>{nav}"
            f"<!-- <p>no</p> -->{body}<form><p>Search <input></p></form>"
            f"<footer>&copy; someone</footer></body></html>")
    return page, None if want is None else " ".join(" ".join(b.split()) for b in want)


def test_templates():
    rnd = random.Random(6)
    for template in ("article", "named"):
        made = [shop(rnd, template) for _ in range(40)]
        w = host_wrapper([p for p, _ in made])
        for page, want in made:
            assert wrappers.main_text(page, w) == want
    pages = [shop(rnd, "plain")[0] for _ in range(20)]
    w = host_wrapper(pages)
    for page in pages:
        text = wrappers.main_text(page, w)
        assert text and "cookies" not in text and "someone" not in text and "Site name" not in text


def test_expression_has_slots_options_and_repeats():
    w = host_wrapper(["<ul><li>a</li><li>b</li></ul><p>same</p>", "<ul><li>c</li></ul><hr><p>same</p>"])
    assert wrappers.expression(w) == ("<page> <ul> ( <li> #slot </li> )+ </ul> ( <hr>  </hr> )? "
                                      "<p> 'same' </p> </page>")
    w = host_wrapper(["<h2>1</h2><p>x</p><h2>2</h2><p>y</p><h2>3</h2><p>z</p>"])
    assert [(c["s"], c["r"]) for c in w["c"]] == [("h2", 1), ("p", 1)]


def test_broken_markup():
    def text(page):
        return wrappers.main_text(page, host_wrapper([page]))
    assert text("<article><p><b>one<br><p>two</p></article><footer>no") == "one two"
    assert text("<article><p>a &amp; b &lt c &#233;&eacute; &am") == "a & b < c éé &am"
    assert text("<article><p>cut <a href='x") == "cut"
    assert text("<article>f<b>o</b>o \n\t bar</article>") == "foo bar"
    assert text("<article><ul><li>one<li>two</ul></article>") == "one two"
    assert text("just 1 < 2 text") == "just 1 < 2 text"
    assert text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    assert text("<script>x") == "" and text("<p") == ""
    assert text("<article>" + "<p>w</p>" * 5000 + "</article>") == " ".join(["w"] * 5000)


def test_pages(spark):
    rnd = random.Random(8)
    rows, want = [], {}
    for i in range(120):
        kind = "article" if i % 3 else "named"
        page, text = shop(rnd, kind)
        rows.append((i, f"https://{kind}.example.org/{i}?a=//b", page, "x"))
        want[i] = text
    rows += [(200, None, None, "x"), (201, "http://one.example/", "", "x"), (202, None, "plain", "x"),
             (202, None, "plain", "x"), (203, "http://one.example/", "<article>a<p>b</article>", "x")]
    want |= {200: "", 201: "", 202: "plain", 203: "a b"}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = wrappers.extract(pages.repartition(6)).collect()
    assert len(out) == len(rows)
    assert {r.page_id: r.text for r in out} == want
    assert all(r.n_chars == len(r.text) for r in out)
    assert {r.host for r in out} == {"article.example.org", "named.example.org", "one.example", ""}
    hosts = pages.withColumn("html", pages.html)
    assert wrappers.infer(hosts, Stage(spark, "w")).count() == 1
    assert wrappers.extract(pages.limit(0)).count() == 0


def test_text_after_a_deep_part():
    def alone(page):
        return wrappers.main_text(page, wrappers.judge(wrappers._leaf(wrappers.parse(page), False, {})))
    deep = "<div>" * 70 + "deep<form>login</form><nav>menu<div>sub</div></nav>tail" + "</div>" * 70
    page = f"<body><div><article><p>start</p>{deep}<p>after</p></article></div></body>"
    assert alone(page) == "start deep tail after"
    inner = "<article>one<div>two</div>three</article><aside>x<div>y</div></aside>"
    assert alone("<body>" + "<div>" * 70 + inner + "z" + "</div>" * 70 + "</body>") == "one two three"


def test_names_of_layout_do_not_empty_a_page():
    frame = "<html><body class='{}'><nav>Menu</nav>{}<footer>Foot</footer></body></html>"
    inner = "<article><h1>Title</h1><p>Some words of it.</p></article>"
    for names in ("no-sidebar", "single comments-open", "right-sidebar", "has-social", "nav-fixed"):
        page = frame.format(names, inner)
        assert wrappers.main_text(page, host_wrapper([page])) == "Title Some words of it.", names
    for part in ("<article class='post search-result'>{}</article>",
                 "<div class='content cookie-accepted'>{}</div>"):
        page = frame.format("page", part.format(
            "<p>Some words of it.</p><div class='comments'><p>First!</p></div>"))
        assert wrappers.main_text(page, host_wrapper([page])) == "Some words of it.", part


def test_alignment_is_a_longest_common_subsequence():
    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else \
                    max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]
    rnd = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rnd.choices("abcd", k=rnd.randint(0, 12))) for _ in range(2))
        pairs = wrappers._aligned([{"s": x} for x in a], [{"s": x} for x in b])
        assert "".join(x["s"] for x, _ in pairs if x) == a
        assert "".join(y["s"] for _, y in pairs if y) == b
        assert all(x["s"] == y["s"] for x, y in pairs if x and y)
        assert sum(1 for x, y in pairs if x and y) == longest(a, b)


def test_constant_blocks_of_a_template_go_and_copies_stay():
    rnd = random.Random(4)
    page = ("<body><main><div class=welcome><p>Welcome to <b>Foo</b> Corp</p></div><h1>{}</h1>"
            "<div class=text><p>{}</p><p>{}</p></div></main></body>")
    own = [[" ".join(rnd.choices(["alpha", "beta", "gamma", "delta"], k=k)) + f" {i}"
            for k in (3, 30, 20)] for i in range(30)]
    pages = [page.format(*x) for x in own]
    w = host_wrapper(pages)
    for html_text, x in zip(pages, own):
        assert wrappers.main_text(html_text, w) == " ".join(x)
        alone = host_wrapper([html_text])  # without the host's wrapper nothing tells the template
        assert wrappers.main_text(html_text, alone) == "Welcome to Foo Corp " + " ".join(x)
    other = page.format(*own[0]).replace("Welcome to", "Farewell from")
    assert wrappers.main_text(other, w).startswith("Farewell from Foo Corp")
    copies = [pages[0]] * 30
    assert wrappers.main_text(pages[0], host_wrapper(copies)) == \
        "Welcome to Foo Corp " + " ".join(own[0])

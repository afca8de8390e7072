import pytest

from docengine.llm import hostpaths as H

MENU = "<nav><ul><li><a href=/a>Home</a></li></ul></nav>"


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        (" \n ", ""),
        ("plain  words\nonly", "plain words only"),
        ("<p>a<p>b", "a\n\nb"),
        (f"<body>{MENU}<article><h1>T &amp; U</h1><p><b>one<br>two<p>three</article><footer>&copy; x</footer>", "T & U\n\none two\n\nthree"),
        ("<script>var t='</p>';</script><div class=main><p>text of it</p></div><div class='cookie-notice'>cookies</div>", "text of it"),
        ("<main><p>long text here</p><table><tr><td>1<td>2<tr><td>3</table></main><aside>side</aside><div id=sidebar>more</div>", "long text here\n\n1 2\n\n3"),
        ("<article><header><h1>Head</h1></header><p>body text</p><section class=comments><p>a comment</p></section></article>", "Head\n\nbody text"),
        ("<div><p>kept &lt;b&gt; &#233;&nbsp;x</p><form><p>mail</p><input></form><!-- no --><style>p{}</style></div>", "kept <b> é x"),
        ("<div><p>a <b>b</b>c<i> d</i></p><ul><li>i<li>ii</ul></div><script>never closed", "a bc d\n\ni\n\nii"),
        ("<article><p>one</p><div class='ad'>buy</div><div class='leads read'>two</div></article>", "one\n\ntwo"),
    ],
)
def test_pages(page, text):
    assert H.extract(page, None)[0] == text


def test_deep_and_long_pages():
    assert H.extract("<div>" * 3000 + "deep" + "</div>" * 3000, None)[0] == "deep"
    long = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    assert H.extract(long, None)[0].count("word") == 30_000


def test_consensus_overrules_a_page(spark):
    page = "<body><div class='story s{0}'><p>{1}</p></div><div class='box'><p>{2}</p></div></body>"
    rows = [(i, f"http://h.org/{i}", page.format(i, "article words " * 20, "small box")) for i in range(20, 40)]
    rows += [(6, "http://h.org/6", page.format(6, "short article text", "a box text of more")), (7, "http://h.org/7", "<p>no container</p>"), (8, None, "<article>x</article>"), (9, "http://h.org/9", None), (9, "http://h.org/9", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, article int")
    won = {r.host: r.path for r in H.host_paths(spark, df).collect()}
    assert won["h.org"] == "body>div.s#.story"
    got = {r.page_id: r for r in H.page_report(spark, df).collect()}
    assert got[20].text == ("article words " * 20).strip() and got[20].n_chars == len(got[20].text)
    assert got[6].text == "short article text"  # its own best container would be the whole body
    assert (got[7].text, got[8].text, got[9].text, got[9].n_chars) == ("no container", "x", "", 0)
    assert H.page_report(spark, df).count() == len(rows)
    assert "article" in H.extract_pages(spark, df).columns
    assert H.page_report(spark, df.limit(0)).collect() == []


def test_hosts(spark):
    rows = [("http://User@H.org:80/x",), ("https://a.b?x",), ("nothing",), (None,)]
    assert [r[0] for r in spark.createDataFrame(rows, "u string").select(H.host_of(__import__("pyspark").sql.functions.col("u"))).collect()] == ["h.org", "a.b", "", ""]


def test_titles_and_leads_outside_the_body_stay(spark):
    page = "<body><article><h1>{0}</h1><p>{1}</p><div class=body><p>{2}</p></div></article></body>"
    rows = [(i, f"http://n.org/{i}", page.format("T" * 60, "lead " * 60, "word " * 1600)) for i in range(6)]
    rows += [(9, "http://n.org/9", page.format("T" * 60, "lead " * 60, "word " * 30)), (10, "http://n.org/10", "<div><p>one</p></div>")]
    got = {r.page_id: r.text for r in H.page_report(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in (*range(6), 9):
        assert got[i].startswith("T" * 60 + "\n\nlead") and got[i].endswith("word"), i
    inner = "body>article>div.body"
    assert H.extract(rows[0][2], inner)[0] == got[0] and H.extract(rows[0][2], inner)[1] == "body>article"


def test_text_after_and_adverts_in_deep_nests():
    nest = "<div>" * 600 + "deep<form>mail</form><div class=ad>buy</div>" + "</div>" * 600
    page = f"<body><article><p>one</p>{nest}<p>two</p></article></body>"
    assert H.extract(page, None) == ("one\n\ndeep\n\ntwo", "body>article")


def test_names_that_are_no_parts_keep_their_text():
    from docengine.llm.hostpaths import extract

    keep = lambda html: extract(html, None)[0]
    assert keep('<main class="content no-sidebar"><p>One</p></main>') == "One"
    assert keep('<article class="post has-comments"><p>One</p></article>') == "One"
    assert keep('<div id="content" class="entry share-enabled"><p>One</p></div>') == "One"
    assert keep('<article><h2 id="search-algorithms">A</h2><p>One</p><h2 id="privacy">B</h2><section id="social-history"><p>Two</p></section></article>') == "A\n\nOne\n\nB\n\nTwo"
    assert keep('<article><p title="the hidden gem of it">Found</p><p hidden>lost</p><p>x <math>y</math> z</p></article>') == "Found\n\nx y z"
    assert keep('<article><p>One</p></article><div class="comment-list"><p>Reader</p></div><div id="site-footer">F</div><div class="ad-300x250">Buy</div>') == "One"


def test_broken_markup_takes_linear_time():
    import time

    from docengine.llm.hostpaths import extract

    for broken in ("<a ", '<a "> ', "<b>", "</i>", "<!", "<!--", '<a href="'):
        took = []
        for n in (20_000, 80_000):
            began = time.perf_counter()
            extract("<p>text " + broken * n, None)
            took.append(time.perf_counter() - began)
        assert took[1] < 10 * took[0] + 0.5, broken
    assert extract('<p>one</p><a "> two <p>three</p>', None)[0] == "one\n\ntwo\n\nthree"


def test_plain_extractor_on_generated_pages(spark):
    """Pages made from known blocks: the article's blocks come back, whatever parts stand around them."""
    import random

    from docengine.llm.hostpaths import page_report

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    around = ['<nav><a href="/">{}</a></nav>', '<div class="sidebar">{}</div>', '<div class="cookie-banner">{}</div>', "<aside>{}</aside>", "<footer>{}</footer>", '<form><input>{}</form>', '<div id="comments"><p>{}</p></div>', "<script>{}</script>"]
    rows, want = [], {}
    for i in range(60):
        blocks = [text(rng.randrange(8, 40)) for _ in range(rng.randrange(2, 7))]
        body = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" if rng.random() < 0.7 else f"<div class=x{i}><p>{b}</p></div>" for b in blocks[1:])
        outside = [a.format(text(6)) for a in rng.sample(around, 4)]
        rows.append((i, f"http://h{i % 5}.example/{i}", f"<html><body>{outside[0]}{outside[1]}<article>{body}</article>{outside[2]}{outside[3]}</body></html>", "c"))
        want[i] = "\n\n".join(blocks)
    df = spark.createDataFrame(rows, "page_id long, url string, html string, _path string")
    assert {r.page_id: r.text for r in page_report(spark, df).collect()} == want


ARTICLE = "<h1>Title of it</h1>" + "".join(f"<p>Paragraph {i} has a number of words of its own.</p>" for i in range(6))
WANT = "\n\n".join(["Title of it", *(f"Paragraph {i} has a number of words of its own." for i in range(6))])


@pytest.mark.parametrize(
    "page",
    [
        '<body><form id="aspnetForm"><div class="menu">Home</div>{}<div class="footer">foot words</div></form></body>',
        '<body><form id="form1"><table><tr><td><nav>a b</nav></td><td>{}</td></tr></table></form></body>',
        '<body><div class="social"><article>{}</article><div class="share">Share this now</div></div></body>',
        '<body><div id="menu"><main>{}</main></div><form>Your name</form></body>',
    ],
)
def test_wrappers_of_the_article_are_kept(page):
    elements, blocks = H.parse(page.format(ARTICLE))
    assert "\n\n".join(t for e, t, _ in blocks if not e.dropped) == WANT


def test_long_comments_and_forms_beside_the_article_go():
    long = "<p>" + "A reader says a great many words here. " * 60 + "</p>"
    for part in (f'<div id="comments"><h1>Comments</h1>{long}</div>', f'<section class="replies">{long}</section>', f"<aside>{long}</aside>", "<form>Write to us, please.</form>", f'<div hidden><h1>x</h1>{long}</div>'):
        elements, blocks = H.parse(f"<body><article>{ARTICLE}</article>{part}</body>")
        assert "\n\n".join(t for e, t, _ in blocks if not e.dropped) == WANT, part


@pytest.mark.parametrize("tag", ["li", "tr", "td", "dd"])
def test_items_outside_of_lists_take_linear_time(tag):
    import time

    began = time.time()
    _, blocks = H.parse("<i>" * 20_000 + f"<{tag}></{tag}>x" * 20_000)
    assert time.time() - began < 10 and blocks

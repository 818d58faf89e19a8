from pyspark.sql import functions as F

from patchlens.llm import template as X

SCHEMA = "page_id long, url string, html string"


def test_article_without_everything_around_it():
    html = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head>
    <body class="with-sidebar"><header><a href="/">Logo</a></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <article>old</article> -->
    <div class="ad">Buy</div><aside>Side</aside><div id="cookie-notice">We use cookies</div>
    <article class="post with-ads"><header><h1>Head&shy;line &lt;1&gt;</h1></header><p>One <b>b</b>old
    w<i>or</i>d&nbsp;x<br>two<p>unclosed &copy 5 &#233;&#xe9;
    <div class="newsletter">Subscribe</div><form><input value="x">Send</form><noscript>no</noscript>
    <ul><li>a<li>b</ul><table><tr><td>c<td>d</table><pre>  q
      r</pre><figure><img src=x><figcaption>cap</figcaption></figure><blockquote>A < B & C</blockquote>
    <section id="comments"><h2>Comments</h2><article class="comment">Nice!</article></section></article>
    <div class="comments"><article>reader says</article></div>
    <footer>&copy; site</footer></body></html>"""
    assert X.main_text(html) == ("Head­line <1> One bold word x two unclosed © 5 éé a b c d q r cap A < B & C")


def test_without_an_article_element():
    page = "<body><div class=menu>m</div><main><h1>H</h1><p>t</p></main><div>other</div>"
    assert X.main_text(page) == "H t"
    assert X.main_text("<div id='content'><p>t</p><div class='share'>s</div></div><p>o</p>") == "t"
    assert X.main_text("<p>just <em>te</em>xt<p>more") == "just text more"
    assert X.main_text("plain text, no markup") == "plain text, no markup"


def test_article_text_is_kept_whatever_its_names_are_about():
    html = """<article class="post comments-open"><h1>T</h1><section class="related-work">Others did this.</section>
    <div id="search-algorithms">Binary search halves.</div><div class="share-price">The share fell.</div><section id="search">Find it.</section>
    <blockquote class="comment">A quoted remark.</blockquote><p class="notice">Take notice.</p><h2 id="comments">On comments</h2>
    <div class="ad">Buy</div><div class="box advertisement">Buy more</div><ul class="comments"><li>reader</li></ul><div id="respond">Reply</div>
    <div class="comment">reader too</div><p>End</p></article>"""
    kept = "T Others did this. Binary search halves. The share fell. Find it. A quoted remark. Take notice. On comments End"
    assert X.main_text(html) == kept
    assert X.main_text(f"<div class='page has-comments share-bar-open'>{html}</div>") == kept
    assert X.main_text(html.replace("<article class=\"post comments-open\">", "<div id=content>").replace("</article>", "</div>")) == kept


def test_odd_input():
    for html in (None, "", " \n", "<", "<>", "</p>", "<!-- open", "<script>x", "<p", "<a href=\"x>y"):
        assert isinstance(X.main_text(html), str)
    assert X.main_text(None) == X.main_text("<script>x") == X.main_text("<!-- open <article>x") == ""
    assert X.main_text("<article>a < b <3 c</article>") == "a < b <3 c"
    assert X.main_text("<article>x" + "<p>word " * 50_000).count("word") == 50_000
    assert X.main_text("<article>" + "<div>" * 3000 + "deep") == "deep"


def site(spark):
    rows = []
    for i in range(12):
        extra = "<div class='x9'>Read our rules</div>" if i % 2 else ""
        rows.append((i, f"https://Host.example:80/p{i}", f"<html><body><div class='q1'>Welcome back</div>{extra}<div class='q2'><p>Text {i} of page</p><p>the end</p></div></body></html>"))
    for i in range(12, 20):
        rows.append((i, f"http://u@other.example/{i}", f"<html><body><article><p>Same words</p><p>Part {i}</p></article></body></html>"))
    return rows + [(30, "http://lone.example/", "<body><div>Welcome back</div><p>t"), (31, None, "<p>n"), (32, "x", None), (None, "http://lone.example/", "<article>q"),
                   (0, "https://host.example/p0", rows[0][2])]


def test_template_of_a_host(spark):
    df = spark.createDataFrame(site(spark), SCHEMA).withColumn("host", F.lit(0)).withColumn("template", F.lit("x")).withColumn("text", F.lit(1))
    classes = X.template_classes(df).collect()
    assert {r["host"] for r in classes} == {"host.example", "other.example"}
    out = {(r["page_id"], r["url"]): r for r in X.extract(df).collect()}
    assert len(out) == len(site(spark))
    for i in range(1, 12):
        # the greeting shares its occurrence vector with the markup, so the template prints it
        assert out[i, f"https://Host.example:80/p{i}"]["text"] == f"Text {i} of page" + ("" if "the end" in _printed(classes) else " the end")
    for i in range(12, 20):
        assert out[i, f"http://u@other.example/{i}"]["text"] == f"Same words Part {i}"
    assert out[30, "http://lone.example/"]["text"] == "Welcome back t"
    assert out[31, None]["text"] == "n" and out[32, "x"]["text"] == "" and out[None, "http://lone.example/"]["text"] == "q"
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())


def _printed(classes):
    key = X._hash(X.token_key(">html>body>div[q2]>p", "the end"))
    return {"the end"} if key in {r["token"] for r in classes if r["is_text"]} else set()


def test_empty_table(spark):
    assert X.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_test_pages_keep_the_article(spark):
    import html as entities
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r["page_id"]: r["text"] for r in X.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        plain = " ".join(entities.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h\d|br)>", " ", inner))).split())
        assert out[r["page_id"]] == plain


def texts_of(spark, rows):
    return {r["page_id"]: r["text"] for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_copies_keep_their_text(spark):
    page = "<body><div class='q1'>Hello</div><div class='q2'><p>The only story</p></div></body>"
    rows = [(i, f"http://copies.example/{i}", page) for i in range(9)]  # a host of copies only
    rows += [(20, "http://five.example/", page)] * 5  # one row five times
    rows += [(30 + i, None, page) for i in range(6)]  # copies without a host
    # copies but for a comment: their html differs, their text does not
    rows += [(40 + i, f"http://stamp.example/{i}", page + f"<!-- {i} -->") for i in range(7)]
    got = texts_of(spark, rows)
    assert len(got) == 9 + 1 + 6 + 7 and set(got.values()) == {"Hello The only story"}


def test_copies_inside_a_large_host(spark):
    def frame(part):
        return f"<body><div class='q1'>Welcome</div>{part}</body>"

    rows = [(i, f"http://big.example/{i}", frame(f"<div class='q2'>Words {i}</div>")) for i in range(10)]
    rows += [(50 + i, f"http://big.example/c{i}", frame("<div id='p-77'><b>One</b> long story</div>") + f"<nav>Menu {i}</nav>") for i in range(9)]
    got = texts_of(spark, rows)
    # the greeting is on every page, whose texts differ: it stays template
    assert all(got[i] == f"Words {i}" for i in range(10))
    assert all(got[50 + i] == "One long story" for i in range(9))


def test_text_of_the_content_element_is_never_template(spark):
    rows = [(i, f"http://c.example/{i}", f"<body><div class='q1'>Hi</div><main><h1>Daily note</h1><p>Day {i}</p></main></body>") for i in range(8)]
    assert texts_of(spark, rows) == {i: f"Daily note Day {i}" for i in range(8)}


def test_tokens_without_a_fixed_place_leave_their_class(spark):
    """Two blocks that the pages print in either order share a vector, but their class is not ordered."""
    rows = []
    for i in range(12):
        pair = ["<div class='a1'>Alpha</div>", "<div class='b1'>Beta</div>"]
        rows.append((i, f"http://o.example/{i}", f"<body><div class='q1'>Welcome</div>{''.join(pair[::-1] if i % 2 else pair)}<div class='q2'>Words {i}</div>"))
    got = texts_of(spark, rows)
    assert got == {i: ("Beta Alpha" if i % 2 else "Alpha Beta") + f" Words {i}" for i in range(12)}


def test_of_two_classes_that_cross_one_is_valid(spark):
    """x1 y1 x2 y2: neither class lies between two tokens of the other, so the one on fewer pages is dropped."""
    def page(i):
        y1, y2 = ("<div class='y1'>Yone</div>", "<div class='y2'>Ytwo</div>") if i % 2 else ("", "")
        return f"<body><div class='x1'>Xone</div>{y1}<div class='x2'>Xtwo</div>{y2}<div class='q2'>Words {i}</div>"

    rows = [(i, f"http://n.example/{i}", page(i)) for i in range(16)]
    assert texts_of(spark, rows) == {i: ("Yone Ytwo " if i % 2 else "") + f"Words {i}" for i in range(16)}
    # within one gap of the other class it stays
    rows = [(i, u, h.replace("<div class='x2'>Xtwo</div>", "")) for i, u, h in rows]
    assert texts_of(spark, rows) == {i: f"Words {i}" for i in range(16)}


def test_order_and_nesting_of_a_page():
    assert {(c, t): (lo, hi, w) for c, t, lo, hi, w in X.places([1, 2, 9, 1, 2, 3], {1: 7, 2: 7, 3: 8})} == {
        (7, 1): (0, 0, True), (7, 2): (1, 1, True), (8, 3): (0, 0, True)}
    assert all(not w for *_, w in X.places([1, 1, 2, 2], {1: 7, 2: 7}))
    member = {1: (7, 0, 2, 9), 2: (7, 1, 2, 9), 3: (8, 0, 2, 5), 4: (8, 1, 2, 5)}
    assert X.crossed([1, 3, 4, 2, 1, 2], member) == X.crossed([1, 2, 3, 4], member) == set()
    assert X.crossed([1, 3, 2, 4], member) == X.crossed([3, 1, 4, 2], member) == {8}

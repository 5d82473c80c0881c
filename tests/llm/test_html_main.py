"""Main text of pages: the given pages against their known layout, and odd markup."""
import html
import re

from cargolens.llm import entry, html_main

DATA = "/root/testdata/sf0.01"
LONG = "Some prose, with commas, that goes on for a while and says a thing or two about nothing. " * 3


def layout(page):
    """The given pages hold their text in one article of headings and paragraphs."""
    article = re.search("<article>(.*?)</article>", page or "", re.DOTALL)
    parts = re.split("</?(?:p|h1)>", article[1]) if article else []
    texts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in parts)
    return "\n\n".join(filter(None, texts))


def test_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = entry.op5_html_main(spark, DATA).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == layout(pages[r["page_id"]])
        assert r["n_chars"] == len(r["text"])


def test_boilerplate_goes():
    page = f"""<html><body><header><h1>Site</h1></header><div id="sidebar">{LONG}</div>
    <div class="cookie-notice">We use cookies, many, many.</div>
    <div class="content"><h2>Title</h2><p>{LONG}</p><div><p>Second&nbsp;&amp; {LONG}</p></div>
    <form><input><p>{LONG}</p></form><div class="ad-box">Buy, buy, buy now, please do.</div>
    <ul class="x"><li><a href="/1">One more story to read here</a></li></ul></div>
    <section id="comments"><p>{LONG}</p></section>
    <footer><p>{LONG}</p></footer><script>if (1 < 2) "</p>"</script></body></html>"""
    one = " ".join(LONG.split())
    assert html_main.main_text(page) == f"Title\n\n{one}\n\nSecond & {one}"


def test_an_article_stays_whole():
    page = f"<article><div><p>{LONG * 5}</p></div><div><p>Short.</p></div></article>"
    assert html_main.main_text(page).endswith("\n\nShort.")


def test_odd_markup():
    main = html_main.main_text
    assert main("") == "" and main("<html></html>") == "" and main("<!-- <p>no</p>") == ""
    assert main("no markup at all") == "no markup at all"
    assert main("<p>a<p>b<br>c</b></div>") == "a\n\nb c"
    assert main("<ul><li>one<li>two</ul>") == "one\n\ntwo"
    assert main("<p title='a>b'>x &lt;y&gt; 1 < 2</p>") == "x <y> 1 < 2"
    deep = "<div>" * 20_000 + LONG + "</div>" * 20_000
    assert main(deep) == " ".join(LONG.split())


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, None, None, "t"), (None, "u", "<p>x", "t"), (1, None, None, "t")],
                               "page_id bigint, url string, html string, text string")
    rows = sorted(map(tuple, html_main.extract(df).collect()), key=repr)
    assert rows == sorted([(1, None, "", 0), (1, None, "", 0), (None, "u", "x", 1)], key=repr)
    assert html_main.extract(df.where("false")).collect() == []


def test_wrappers_with_unlikely_names():
    one = " ".join(LONG.split())
    body = f"<p>{LONG}</p><p>{LONG}</p>"
    for start, end in (("<div class='layout has-sidebar'>", "</div>"), ("<form id='aspnetForm'>", "</form>"),
                       ("<div id='content-sidebar-wrap'>", "</div>"), ("<nav>", ""),
                       ("<div class='page sticky-header'><form>", "</form></div>")):
        for inside in (body, f"<article>{body}</article>", f"<main>{body}</main>",
                       f"<div>{body}</div><div class='sidebar'><p>{LONG}</p></div>",
                       f"<article>{body}</article><section id='comments'><p>{LONG * 40}</p></section>"):
            page = f"<body><header>Site</header>{start}{inside}{end}<footer>Notes</footer></body>"
            assert html_main.main_text(page) == f"{one}\n\n{one}", page
    short = "<body><div class='page sticky-header'><p>Short.</p></div></body>"
    assert html_main.main_text(short) == "Short."
    hidden = f"<body><div hidden>{body}</div><p>Short.</p></body>"
    assert html_main.main_text(hidden) == "Short."


def test_long_parts_stay_out():
    one = " ".join(LONG.split())
    page = f"""<article><p>{LONG}</p></article><section id="comments"><article class="comment"><p>{LONG * 40}</p>
    </article></section><div class="related"><article><p>{one[:100]}</p></article></div>"""
    assert html_main.main_text(page) == one


def test_unclosed_elements():
    one = " ".join(LONG.split())
    for odd in ("<svg><path d='x'>", "<object data='x'>", "<select><option>Choice", "<video src='x'>",
                "<iframe src='x'>", "<svg><svg></svg>", "<noscript>", "<svg><g>x<select>"):
        for page in (f"<div>{odd}</div><article><p>{LONG}</p></article>",
                     f"<article>{odd}<p>{LONG}</p></article>",
                     f"<article>{odd}<p>{LONG}</p><svg><text>no</text></svg></article>",
                     f"<div>{odd}<div><p>{LONG}</p></div></div>"):
            assert html_main.main_text(page) == one, page
    assert html_main.main_text(f"<p>{LONG}</p><object><div><p>Fallback</p></div></object>") == one
    many = "<svg>" * 20_000 + f"<p>{LONG}</p>" + "<div><svg></div>" * 20_000
    assert html_main.main_text(many) == one

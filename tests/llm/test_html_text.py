import html as H
import re

from tiergrain.llm.html_text import extract_pages, main_text

P1 = "The first paragraph of the article is long enough to be one, with commas, and stops."
P2 = "A second paragraph says more about the same subject &amp; keeps to the point in hand."
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(8)) + "</ul>"


def test_plain_article_between_furniture():
    page = (f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav>{MENU}"
            f"</nav><!-- x --><div class=\"ad\">Buy this now and save.</div><article><h1>Head</h1><p><b>{P1}<br>"
            f"<p>{P2}</p></article><footer>&copy; somebody</footer></body></html>")
    assert main_text(page) == f"Head\n\n{P1}\n\n{H.unescape(P2)}"


def test_layout_without_an_article_element():
    body = "".join(f"<p>{P1} {i}</p>" for i in range(6))
    page = (f"<body><div id=top>{MENU}</div><div><div><h1>Title of it</h1><div class=post>{body}</div></div>"
            f"<div>{MENU}</div></div><div class='comments'><p>{P2}</p><p>{P2}</p></div>"
            f"<form><p>{P1}</p><input></form><div class='cookie-notice'>{P1}</div><aside><p>{P1}</p></aside>")
    assert main_text(page) == "\n\n".join(["Title of it"] + [f"{P1} {i}" for i in range(6)])


def test_broken_and_odd_markup():
    assert main_text(None) == "" == main_text("") == main_text("<p>  </p>") == main_text("<script>x")
    assert main_text("just text &lt;b&gt;") == "just text <b>"
    assert main_text("<p>one <a href='x>y'>two</a>\n three<p>four <unknown>five") == "one two three\n\nfour five"
    assert main_text(f"<article><p>{P1}<div cla") == P1
    deep = "<div>" * 5000 + P1 + "</div>" * 5000
    assert main_text(deep) == P1
    long = "<article>" + f"<p>{P1}</p>" * 20_000 + "</article>"
    assert main_text(long).count("\n\n") == 19_999


def plain(page):
    """The generator's pages: blocks of the one article element."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    out = []
    for b in re.split(r"</?(?:p|h1)>", body):
        t = " ".join(H.unescape(re.sub(r"</?(?:b|br)>", " " if "<br>" in b else "", b)).split())
        if t:
            out.append(t)
    return "\n\n".join(out)


def test_query_against_plain_code(spark):
    from tiergrain.llm.registry import op1_html_text

    d = "/root/testdata/sf0.01"
    want = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = {r.page_id: (r.url, r.text) for r in op1_html_text(spark, d).collect()}
    assert got == want


def test_edges(spark):
    rows = [(1, "u", None, 0), (None, None, f"<p>{P1}</p>", 1), (1, "u", "", 2), (1, "u", f"<p>{P1}</p>", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in extract_pages(df).collect()), key=str)
    assert got == sorted([(1, "", 0), (None, P1, len(P1)), (1, "", 0), (1, P1, len(P1))], key=str)
    assert extract_pages(df.limit(0)).count() == 0


def test_script_bodies_are_no_markup():
    article = f"<article><p>{P1}</p></article>"
    bodies = ["for(var i=0;i<len;i++){f(i);}", "if(a<b)x='it", "<!-- no end", "if(a<b && c>\"d", "x='<p>';y=\"</div>\"", "a</b"]
    for name in ("script", "STYLE", "textarea", "iframe"):
        for body in bodies:
            page = f"<body><{name} a='b'>{body}</{name.lower()} >{article}<{name}>{body}</{name}><p>"
            assert main_text(page) == P1, page
            assert main_text(f"<html><head><{name}>{body}</{name}></head><body>{article}") == P1
    assert main_text(f"<head><title>a <b 'c</title></head>{article}<script>f(a<b") == P1
    assert main_text(f"<svg><title>x</title><script/></svg>{article}") == P1
    many = "<title>" * 20_000
    assert main_text(f"{article}<svg>{many}") == P1 and main_text(f"{article}" + "<script>a<b;</script>" * 20_000) == P1


def test_wrappers_with_furniture_words_are_kept():
    body = "".join(f"<p>{P1} {i}</p>" for i in range(6))
    want = "\n\n".join(f"{P1} {i}" for i in range(6))
    furniture = f"<div class=sidebar><p>{P2}</p></div><div class='comments-area'><p>{P2}</p></div>"
    for open_, close in (("<div class='page has-sidebar'>", "</div>"), ("<div class='post comments-open'>", "</div>"),
                         ("<div id=no-header>", "</div>"), ("<form id='aspnetForm'>", "</form>"),
                         ("<form id='aspnetForm'><div class='page has-sidebar'>", "</div></form>"),
                         ("<div class='sidebar'>", "</div>"), ("<div class=contentSidebarWrap>", "</div>")):
        assert main_text(f"<body><nav>{MENU}</nav>{open_}{body}{close}<footer>{P2}</footer>") == want, open_
        if "'sidebar'" not in open_:
            assert main_text(f"<body>{MENU}{open_}{body}{furniture}{close}") == want, open_
        assert main_text(f"<body>{open_}{furniture}<article>{body}</article>{close}") == want, open_
    assert main_text(f"<div class='comments'>{body}</div>") == want
    assert main_text(f"<div hidden>{body}</div>") == ""


def test_comments_stay_out():
    body = "".join(f"<p>{P1} {i}</p>" for i in range(3))
    want = "\n\n".join(f"{P1} {i}" for i in range(3))
    reader = f"<article class='comment'><p>{P2}</p></article>" * 20
    plain = f"<article><p>{P2}</p></article>" * 20
    for said in (reader, plain):
        for box in ("<section class='comments'>", "<section id=comments-list>"):
            assert main_text(f"<article>{body}{box}{said}</section></article>") == want
            assert main_text(f"<main><article>{body}</article>{box}{said}</section></main>") == want
            assert main_text(f"<div>{body}</div>{box}{said}</section>") == want
    assert main_text(f"<article>{body}{reader}</article>") == want
    assert main_text(f"<article>{body}</article><aside>{plain}</aside><div class=sidebar>{plain}</div>") == want
    assert main_text(f"<article class='post comments-open'>{body}</article>") == want


def test_parse_is_linear_in_stray_and_deep_tags():
    import time

    n = 50_000
    for page in ("<div>" * n + "x" + "</section>" * n, "<div>" * n + "<li>a" * n, "<ul><li>" * n + "</td>" * n):
        began = time.process_time()
        main_text(page)
        assert time.process_time() - began < 5
    short, long = (min(timed(k) for _ in range(3)) for k in (10_000, 40_000))
    assert long < 8 * short


def timed(n):
    import time

    page = "<div>" * n + "x" + "</section>" * n + "<li>y" * n
    began = time.process_time()
    main_text(page)
    return time.process_time() - began


def test_names_that_only_mention_furniture_keep_article_text():
    for name in ("share-price", "search-theory", "alert-system"):
        page = f"<article><p>One two three.</p><div class='{name}'><p>The price rose.</p></div></article>"
        assert main_text(page) == "One two three.\n\nThe price rose."
    for name in ("share-buttons", "related-posts", "newsletter-box", "ad-slot", "cookie-banner"):
        page = f"<article><p>One two three.</p><div class='{name}'><p>Click here now.</p></div></article>"
        assert main_text(page) == "One two three."

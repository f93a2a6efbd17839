from townsquare.llm import webpages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li>One<li>Two</ul></nav><!-- c --><div class="ad">Buy</div>
<article><header><h1>Head &amp; line</h1><p>by someone</p></header><p><b>First
  paragraph<br>goes&nbsp;on.<p>Sec<i>ond</i></p><aside>See also</aside><form><p>Name</p></form>
<section class="comments"><p>nice</p></section></article><footer>&copy; x</footer></body></html>"""


def test_article_without_furniture():
    assert webpages.text(webpages.content(webpages.read(PAGE))) == "Head & line First paragraph goes on. Second"


def test_broken_markup():
    read = lambda h: webpages.text(webpages.content(webpages.read(h)))
    assert read("") == "" and read(None) == "" and read("plain &lt; text") == "plain < text"
    assert read("<p>a<p>b</div></p>c<td>d") == "a b c d"
    assert read("<div hidden>x</div><main>y<div style='display: none'>z</div></main>") == "y"
    assert read("<div>" * 3000 + "deep" + "</div>") == "deep"
    assert read("<article>a</article><article class='comment'>b</article><article>c</article>") == "a c"


def test_names_do_not_lose_the_article():
    read = lambda h: webpages.text(webpages.content(webpages.read(h)))
    for names in ("class=no-sidebar", "class='site-content has-sidebar'", "class='post has-comments'", "class=category-social", "id=privacy-notice", "class=widget", "id=social"):
        assert read(f"<body><div {names}><article><h1>T</h1><p>x</p></article></div></body>") == "T x", names
        assert read(f"<body><nav>n</nav><article {names}><h1>T</h1><p>x</p></article></body>") == "T x", names
        assert read(f"<body><p>before</p><div {names}><main>x</main></div></body>") == "x", names
        assert read(f"<main>y<div {names}><article>x</article></div></main>") in ("x", "y x"), names
    assert read("<article><header class=entry-header><h1>T</h1></header>x</article>") == "T x"
    assert read("<article><header class=header><h1>T</h1></header>x</article>") == "T x"
    assert read("<main>a</main><p>between</p><main>b<main>c</main></main>") == "a b c"
    assert read("<article>x</article><div class=related><article>other</article></div>") == "x"
    assert read("<article>x<section class=comments><article>nice</article></section></article>") == "x"
    assert read("<article>x<div class='box cookie-banner'>Accept</div></article>") == "x"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, text string")


def test_template_of_a_host_goes(spark):
    rows = []
    for i in range(12):
        body = f"<div><b>Welcome to the site</b></div><div><p>Own text {i}</p><p>Said often</p></div><div><i>Call us</i></div>"
        rows.append((i, f"http://A.example.com:80/{i}", f"<body>{body}</body>"))
    rows += [(50 + i, "http://b.example.com/", "<body><div><b>Welcome to the site</b></div><div>Same</div></body>") for i in range(9)]
    rows += [(90, None, "<body><div><b>Welcome to the site</b></div>x</body>"), (91, "http://c.example.com/", None), (91, "http://c.example.com/", None)]
    out = {r["page_id"]: (r["text"], r["n_chars"]) for r in webpages.extract(pages(spark, rows)).collect()}
    assert out[3] == ("Own text 3", 10)
    assert out[50] == ("Welcome to the site Same", 24), "copies of one page are one page"
    assert out[90] == ("Welcome to the site x", 21) and out[91] == ("", 0)


def test_passages_of_articles_stay(spark):
    rows = [(i, "https://a.org/x?y", f"<nav>Menu</nav><article><p>Shared</p><p>Own {i}</p></article>") for i in range(20)]
    out = {r["page_id"]: r["text"] for r in webpages.extract(pages(spark, rows)).collect()}
    assert out == {i: f"Shared Own {i}" for i in range(20)}


def test_site_blocks_inside_articles_go(spark):
    menu = "<ul><li><a href=/a>Start here</a><li><a href=/b>All topics</a></ul>"
    rows = []
    for i in range(12):
        body = f"<p>Shared passage</p><div class=x><p>Quoted by many</p></div>{menu}<p>Own {i}</p>"
        rows.append((i, "https://a.org/", f"<body><article><h1>Title {i}</h1><div><p>Read our letter</p></div>{body}<section>Sign up now</section></article></body>"))
    rows += [(50 + i, f"https://b{i}.org/", rows[i][2]) for i in range(12)]
    out = {r["page_id"]: r["text"] for r in webpages.extract(pages(spark, rows)).collect()}
    assert all(out[i] == f"Title {i} Shared passage Quoted by many Own {i}" for i in range(12))
    assert out[50] == "Title 0 Read our letter Shared passage Quoted by many Start here All topics Own 0 Sign up now"


def test_templates_do_not_depend_on_the_size_of_a_host(spark):
    rows = [(i, "http://a.org/", f"<body><div>Notice</div><p>Own {i}</p></body>") for i in range(5)]
    more = [(5 + i, "http://a.org/", f"<body><p>Other {i}</p></body>") for i in range(60)]
    rare = [(90 + i, "http://b.org/", f"<body><div>Notice</div><p>Own {i}</p></body>") for i in range(3)]
    for given in (rows + rare, rows + more + rare):
        out = {r["page_id"]: r["text"] for r in webpages.extract(pages(spark, given)).collect()}
        assert [out[i] for i in range(5)] == [f"Own {i}" for i in range(5)] and out[90] == "Notice Own 0"
        assert len(out) == len(given) and all(out[5 + i] == f"Other {i}" for i in range(60) if 5 + i in out)


def test_rows_and_empty_table(spark):
    frame = pages(spark, [(None, None, None), (1, "http://a/", "<p>" + "long " * 100_000)])
    assert sorted(r["n_chars"] for r in webpages.extract(frame).collect()) == [0, 499_999]
    assert webpages.extract(frame.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    """The supplied pages hold one article each: its text with the tags taken out."""
    import html
    import re

    from townsquare.llm import registry

    source = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    out = {r["page_id"]: r for r in registry.queries()["op7_webpages"](spark, "/root/testdata/sf0.001").collect()}
    assert len(out) == len(source)
    for page in source:
        article = re.search(r"<article>(.*?)</article>", page["html"] or "", re.S)
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article[1])).split()) if article else ""
        row = out[page["page_id"]]
        assert (row["url"], row["text"], row["n_chars"]) == (page["url"], expected, len(expected))

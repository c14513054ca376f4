from itertools import combinations, product


from sharedsignal.llm import htmlcut as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="<p>no</p>";</script></head><body>
<header class="site-header"><p>My site, the best of all sites.</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site.</div><article><h1>A &lt;great&gt; title</h1><p>First  paragraph &amp; more<br>text.
<p>Second one, with a <a href="x">link</a> in it.</p><div class="advert">Buy now and save a lot of money.</div>
<form><label>Mail</label><input></form><section id="comments"><p>Reader: I liked this article a lot.</p></section></article>
<aside><p>Related story about other things.</p></aside><footer>&copy; nobody</footer></body></html>"""


def test_article_only():
    assert H.main_text(PAGE) == ("A <great> title First paragraph & more text. Second one, with a link in it.")


def test_edge_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<script>x</script>") == ""
    assert H.main_text("only plain words here") == "only plain words here"
    assert H.main_text("<p>5 < 6 and 7 > 3 here") == "5 < 6 and 7 > 3 here"
    assert H.main_text("<article><p>a&nbsp;&nbsp;b c d e</p><!-- <p>x</p> --></article>") == "a b c d e"
    assert len(H.main_text("<article>" + "<div>" * 5000 + "<p>deep text in the page here.</p>")) == 27


def test_articles_in_wrappers_with_listed_names():
    long = "This paragraph of the article tells a long story with many words, which goes on for a while and then ends here."
    body = f"<h1>A title of the story</h1><p>{long}</p><p>{long}</p><p>{long}</p>"
    want = " ".join(["A title of the story", *[long] * 3])
    ad = '<div class="ad">Buy this now and save money.</div><div class="sidebar"><p>Other stories of the week, which you may like.</p></div>'
    for name in ("content-with-sidebar", "entry-content no-sidebar", "post has-social", "post-content legal", "elementor-widget-container"):
        for attribute in ("class", "id"):
            assert H.main_text(f'<body><nav>Home</nav>{ad}<div {attribute}="{name}">{body}</div>{ad}<footer>(c)</footer></body>') == want, name
    thread = f'<section class="comments"><p>{long}</p><p>{long}</p><p>{long}</p><p>{long}</p></section><div class="post-comments"><p>{long}</p></div>'
    assert H.main_text(f"<body><article>{body}{thread}</article></body>") == want
    assert H.main_text(f'<body><div class="post-content legal">{body}</div><div role="complementary"><p>{long}</p></div></body>') == want


def brute(n, edges):
    best, sides = None, None
    for bits in product((0, 1), repeat=n):
        side = (1, 0, *bits)  # source side 1, sink side 0
        cost = sum(c for a, b, c in edges if side[a] == 1 and side[b] == 0)
        if best is None or cost < best:
            best, sides = cost, side
    return best, sides


def test_cut_is_minimal(rng):
    for _ in range(60):
        n = int(rng.integers(2, 7))
        flow, edges = H.Flow(n + 2), []
        for v in range(2, n + 2):
            a, b = (int(x) for x in rng.integers(0, 9, 2))
            flow.add(0, v, a)
            flow.add(v, 1, b)
            edges += [(0, v, a), (v, 1, b)]
        for u, v in combinations(range(2, n + 2), 2):
            if rng.random() < 0.6:
                c = int(rng.integers(0, 6))
                flow.add(u, v, c, c)
                edges += [(u, v, c), (v, u, c)]
        side = flow.cut()
        cost = sum(c for a, b, c in edges if side[a] and not side[b])
        assert cost == brute(n, edges)[0]


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "kept"), (2, None, None, None), (1, "u", PAGE, "kept")],
                               "page_id bigint, url string, html string, text string")
    out = H.extract(df)
    assert out.columns == ["page_id", "url", "text"]
    got = sorted((r.page_id, r.text) for r in out.collect())
    assert got[0] == got[1] and got[0][1].startswith("A <great>") and got[2] == (2, "")
    assert H.extract(df.limit(0)).count() == 0

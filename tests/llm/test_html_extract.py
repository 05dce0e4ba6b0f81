from funnelforge.llm import html_extract as he

LONG = "The end of the story was that it is in the hands of the people who were there with him. " * 4


def test_article_without_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>Not this</title><style>p{{}}</style><script>var t="</p>";</script></head>
    <body class="has-sidebar"><header>Site name</header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- no <p>x</p> -->
    <div class="ad">{LONG}</div><div id="cookie-notice">{LONG}</div>
    <article><header><h1>Title &amp; more</h1></header><p>Short.</p><p><b>Bold</b>er &eacute;t&#233; <a href="x">link</a>
       text&nbsp;here.<br>Next<p>{LONG}<aside>{LONG}</aside>
    <form><input>Give mail</form><section class="comments"><p>{LONG}</p></section><p>End</p></article>
    <div class="sidebar"><p>{LONG}</p></div><footer>&copy; x</footer></body></html>"""
    assert he.main_text(page) == f"Title & more Short. Bolder été link text here. Next {LONG.strip()} End"


def test_page_without_article():
    page = (f"<body><div><a href=x>Home</a> <a href=y>News</a></div><h1>Head</h1><p>{LONG}</p><p>Tiny one</p><p>{LONG}</p>"
            f"<p>Copyright line</p><div><a href=q>{LONG}</a></div></body>")
    assert he.main_text(page) == f"Head {LONG.strip()} Tiny one {LONG.strip()}"


def test_skipped_elements_without_end():
    article = f"<article><p>{LONG}</p></article>"
    for opener in ("<svg class='i'/>", "<math/>", "<svg><title/><style/></svg>", '<object data="a">', '<iframe src="a"/>', "<button>",
                   "<select>", "<svg>", "<noscript>", "<svg-icon>"):
        for after in ("", "<svg><text>x</text></svg><iframe>x</iframe><button>x</button><select><option>x</select><object>x</object>"):
            assert he.main_text(f"<body>{opener}{article}{after}</body>") == LONG.strip(), (opener, after)
    inside = "<svg><svg><text>x</text></svg><text>x</text></svg><button>x<script>'</button>'</script>x</button><object><object/>x</object>x</object>"
    assert he.main_text(f"<article><p>{inside}{LONG}</p></article>") == LONG.strip()


def test_edges(frame):
    assert he.main_text(None) == he.main_text("") == he.main_text("<p></p>") == ""
    assert he.main_text("just text") == "just text"
    assert he.main_text("<article>a <b>b</article") .startswith("a b")
    assert he.main_text("<article><p>x <script>never closed") == "x"
    assert he.main_text("<article>" + "<div>" * 20_000 + "deep") == "deep"
    assert len(he.main_text("<article><p>" + "word " * 100_000)) == 499_999
    assert he.main_text('<article><p title="a > b">x</p><p class=\'q" y\'>z</p></article>') == "x z"
    he.main_text("<" * 50_000)
    he.main_text('<a b="' * 5_000)
    rows = [(1, "u", None, "x"), (2, None, "<p>t</p>", "y"), (2, None, "<p>t</p>", "y"), (None, "v", "", "z")]
    got = he.extract(frame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert sorted(((r.page_id, r.url, r.text, r.n_chars) for r in got), key=repr) == \
        sorted([(1, "u", "", 0), (2, None, "t", 1), (2, None, "t", 1), (None, "v", "", 0)], key=repr)
    assert he.extract(frame([], "page_id bigint, url string, html string")).collect() == []

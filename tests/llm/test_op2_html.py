from ordertide.llm import op2_html as O

EN = "the cat is on the mat and it was one of the best days for them. "
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{a: "</p>"}}</style></head><body class="page">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a><li><a>More</a></ul></nav>
<div id="cookie-notice"><p>{EN * 5}</p></div><div class="ad"><p>{EN * 5}</p></div>
<div><h2>Heading &amp; more</h2><p>{EN * 5}</p><p>Short &lt;one&gt;&nbsp;here.</p><p>{EN * 4}<b>bold</b>   text</p>
<script>var x = "<p>not text</p>"; if (1 < 2) {{}}</script><!-- <p>gone</p> --></div>
<form><p>{EN * 5}</p></form><aside><p>{EN * 5}</p></aside><section class="comments"><p>{EN * 5}</p></section>
<p>Related: <a href=x>some link text that is long enough to count</a></p><footer><p>{EN * 5}</p></footer></body></html>"""


def squash(s):
    return " ".join(s.split())


def test_block_rules():
    assert O.main_text(PAGE).split("\n") == ["Heading & more", squash(EN * 5), "Short <one> here.", squash(EN * 4) + " bold text"]


def test_two_passes():
    t, f, n = True, False, None
    assert O.second_pass([n, t, n, n, t, n, f, n], [False] * 8) == [f, t, t, t, t, t, f, f]
    assert O.second_pass([f, n, t], [False, True, False]) == [f, t, t]
    assert O.second_pass([f, n, n, n, t], [False] * 5) == [f, f, f, t, t]
    assert O.second_pass([n, n], [False] * 2) == [f, f]


def test_article_is_kept_whole():
    odd = " | ".join(["xyzzy"] * 300)
    page = f"<body><nav>a</nav><article><h1>H</h1><p>{odd}<p>x<br>y</article><footer>z</footer>"
    assert O.main_text(page) == "\n".join(["H", odd, "x", "y"])
    assert O.main_text(page[: page.index("<br>")]) == "\n".join(["H", odd, "x"])


def test_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<p>"), (5, "u", "<article>" + "é " * 200_000)]
    df = spark.createDataFrame([r + (0,) for r in rows], "page_id long, url string, html string, text int")
    got = O.extract(df).collect()
    assert len(got) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["n_chars"] for r in got}[5] == 399_999
    assert [r["text"] for r in got if r["page_id"] in (2, 3, None)] == ["", "", ""]
    assert O.extract(df.limit(0)).collect() == []


def test_all_pages_of_the_tables(spark, sf_dir):
    """On the given pages every article block is found, and nothing else."""
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in O.op2_html(spark, sf_dir).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = [squash(html.unescape(re.sub(r"<[^>]+>", "", p))) for p in re.split(r"</?(?:p|h1|br)>", inner)]
        assert got[r["page_id"]] == "\n".join(p for p in parts if p)


def test_marks_are_whole_names():
    """A boilerplate word inside a wrapper's name doesn't drop the page."""
    text = squash(EN * 5)
    for name in ("has-sidebar", "no-sidebar", "search-results", "with_comments"):
        assert O.main_text(f'<body><div class="x {name}"><p>{EN * 5}</p></div>') == text
    for name in ("sidebar", "left-sidebar", "cookie-notice", "x main-nav", "comments"):
        assert O.main_text(f'<body><div class="{name}"><p>{EN * 5}</p></div>') == ""
    head = '<div class="article-header"><h1>T</h1></div><div class="header"><h2>U</h2></div>'
    assert O.main_text(f"<body><article>{head}<p>{EN * 5}</p></article>") == f"T\nU\n{text}"


def test_article_clears_marks():
    text = squash(EN * 5)
    for tag in ("article", "main"):
        page = f"<{tag}><p>{EN * 5}</p></{tag}>"
        for around in ("<form>", '<div class="widget">', '<form id="search"><div>'):
            assert O.main_text(f"<body>{around}{page}") == text
        for around in ("<nav>", "<aside>", "<div hidden>", '<article><section class="comments">'):
            assert O.main_text(f"<body>{around}{page}") == ""
    assert O.main_text(f"<body><main><form><article><p>{EN * 5}</p></article></form></main>") == text
    assert O.main_text(f'<body><article class="comment"><p>{EN * 5}</p></article>') == ""


def test_prose_of_other_languages():
    """Long blocks with few links aren't dropped for want of known stop words."""
    polish = "Wczoraj wieczorem mieszkańcy miasta zebrali się przed ratuszem, żeby wspólnie świętować rocznicę. " * 3
    japanese = "昨日の夜、町の人々は市役所の前に集まり、記念日を一緒に祝いました。" * 8
    for prose in (polish.strip(), japanese):
        assert O.main_text(f"<body><nav><a>Menu</a></nav><div><p>{prose}</p></div><div>{prose}</div>") == f"{prose}\n{prose}"
        assert O.main_text(f"<body><div><p><a>{prose}</a></p></div>") == ""


def test_boilerplate_inside_an_article():
    """Named boilerplate and link lists go; what the tag alone decides stays."""
    text = squash(EN * 5)
    for name in ("responses", "discussion", "author-bio", "author_bio", "entry-meta"):
        assert O.main_text(f'<body><article><p>{EN * 5}</p><div class="{name}"><p>{EN * 5}</p></div></article>') == text
    assert O.main_text(f"<body><article><p>{EN * 5}</p><ul><li><a>{EN}</a></ul><p>x y z</article>") == f"{text}\nx y z"


def test_pages_without_a_decided_block():
    """Short prose is kept where nothing speaks against it."""
    assert O.main_text("<body><h1>Head</h1><p>Short one.</p><p>And two.</p></body>") == "Head\nShort one.\nAnd two."
    assert O.main_text("<body><nav><a>Menu</a></nav><article><p>Short.</p></article><footer>c</footer>") == "Short."
    assert O.main_text("<body><div>Home</div><div>About</div></body>") == ""


def test_the_article_tag_is_one_vote():
    """Captions and single-link paragraphs go with their neighbours; calls to
    the reader and link lists go, also inside an article or main element."""
    text = squash(EN * 5)
    page = f'<article><p>{EN * 5}</p><p><a href="x">One link only</a></p><figure><img src="i"><figcaption>A caption</figcaption></figure></article>'
    assert O.main_text(f"<body>{page}<footer>f</footer>") == f"{text}\nOne link only\nA caption"
    page = f"<main><p>Accept our terms</p><p>{EN * 5}</p><p>Log in to read more</p><p><a>one</a> <a>two</a></p></main>"
    assert O.main_text(f"<body>{page}") == text
    block = O.Block("x" * 100, "div", 0, True, 0)
    assert O.first_pass(block) is None and O.first_pass(block._replace(text=EN * 2)) is True
    assert O.first_pass(block._replace(content=False, text=EN * 2)) is None  # more is asked outside
    t, f, n = True, False, None
    inside = [False, True, True, True, False]
    assert O.second_pass([f, n, f, n, f], [False] * 5, inside) == [f, t, f, t, f]
    assert O.second_pass([f, n, n, n, f], [False] * 5, inside) == [f, t, t, t, f]
    assert O.second_pass([n, f, n, t, n], [False] * 5) == [f, f, f, t, t]  # equally near: the one before


def test_a_loose_name_cannot_take_the_page():
    text = squash(EN * 5)
    assert O.main_text(f'<body><nav>a</nav><section class="discussion"><p>{EN * 5}</p></section>') == text
    both = f'<body><article><p>{EN * 5}</p></article><section class="discussion"><p>{EN * 4}</p></section>'
    assert O.main_text(both) == text

import time
from html import escape

import pytest
from layerloom.llm import host_paths
from layerloom.llm.registry import op1_host_paths

SF = "/root/testdata/sf0.001"
ARTICLE = "<h1>Head &amp; more</h1><p>One  line<br>two<p>Third <b>bo</b>ld &lt;x&gt; <a href='/'>link</a>.</p>"
TEXT = "Head & more One line two Third bold <x> link."


def page(body, article=ARTICLE):
    return f"<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body>{body.format(article=article)}</body></html>"


SHAPES = {
    "plain": "<nav><a>menu</a></nav><article>{article}</article><footer>foot</footer>",
    "classes": "<div class='top-nav'>menu</div><div class='content post-{{}}'><div class='ad'>buy</div>{article}</div>"
    "<div id='comments'><p>reader says a lot of things here</p></div>",
    "inside": "<main><article class='post'>{article}<aside>side</aside><form>mail <input></form>"
    "<section class='comments'><article class='comment'><p>reader text</p></article></section></article></main>",
    "wrapped": "<div class='page-with-sidebar'><article>{article}</article><div class='sidebar'>side</div></div>",
    "notice": "<div class='cookie-notice'>we use</div><article>{article}<script>var t='</p>';</script><!-- <p>no</p> --></article>",
    "head": "<header>site</header><article><header>{article}</header></article><footer>foot",
    "hidden": "<article>{article}<p hidden>gone</p><div style='display: none'>gone</div></article>",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes(shape):
    html = page(SHAPES[shape].replace("{{}}", "17"))
    vote = host_paths._vote(html)
    assert host_paths.extract(html, [vote]) == TEXT
    assert host_paths.extract(html, ["body/nothing"]) == TEXT


def test_long_comments_lose_to_the_hosts_path(spark):
    """One page whose comments are longer than its article, on a host that agrees on the place."""
    body = "<div class='story'>{article}</div><div class='below'>" + "<p>much more text than the article</p>" * 40 + "</div>"
    usual = "<div class='story'>{article}</div><div class='below'>x</div>"
    rows = [(k, "http://h.example.com/a", page(body if k == 0 else usual, ARTICLE * 3)) for k in range(9)]
    found = host_paths.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r["text"] for r in found.collect()} == {" ".join([TEXT] * 3)}


def test_unclosed_and_broken_markup():
    assert host_paths.extract("<article><p><b>a<br><p>b</article><p>c", ["body/article"]) == "a b"
    assert host_paths.extract("<article>1 < 2 <a title=\"x>y\">z</a><p class=\"q>w</p></article>", ["body/article"]).startswith("1 < 2 z")
    assert host_paths.extract("no markup at all", []) == "no markup at all"
    assert host_paths.extract("<script>never closed", []) == ""
    assert host_paths.extract("<article></article><nav>menu</nav>", ["body/article"]) == ""


def test_deep_page():
    html = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert host_paths.extract(html, []) == "deep"


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "no host", "<p>x</p>"), (4, "HTTP://Me@A.com:80/x", "<p>y</p>")]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string").selectExpr(
        "*", "'z' AS text", "'z' AS host", "'z' AS paths"
    )
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in host_paths.extract_pages(df).collect())
    assert got == [("1", "", 0), ("1", "", 0), ("2", "", 0), ("4", "y", 1), ("None", "x", 1)]
    assert host_paths.extract_pages(df.limit(0)).count() == 0
    hosts = [r[0] for r in df.select(host_paths.host_of(df["url"])).collect()]
    assert hosts == ["", "", "", "a.com", ""]


def test_whole_table(spark):
    """The article of the test pages, cut out by hand."""
    import re
    from html import unescape

    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in op1_host_paths(spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", rows[r["page_id"]], re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))
        assert r["text"] == " ".join(unescape(plain).split())
        assert r["n_chars"] == len(r["text"])


def test_escapes_round_trip():
    text = "a & b < c > d \" ' é 漢"
    assert host_paths.extract(f"<article><p>{escape(text)}</p></article>", []) == text


def test_nested_containers():
    """Title, lead and every section belong to the article, however deep they lie."""
    one, two, three = ("one " * 125).strip(), ("two " * 75).strip(), ("three " * 20).strip()
    parts = f"<section>{one}</section><section>{two}</section><section>{three}</section>"
    body = f"{one} {two} {three}"
    for html, want in (
        (f"<article><h1>T</h1><div class=c>{parts}</div></article>", f"T {body}"),
        (f"<div>out</div><article><h1>T</h1><div><div><div>{one}</div></div></div></article>", f"T {one}"),
        (f"<main><h1>T</h1><article><div>{parts}</div></article></main><div>out</div>", f"T {body}"),
        (f"<div class=c>{parts}</div><div class=d>out</div>", body),
        (f"<div class=c><div class=e>{parts}</div></div><div class=d>out</div>", body),
    ):
        vote = host_paths._vote(html)
        assert host_paths.extract(html, [vote]) == want
        assert host_paths.extract(html, []) == want


def test_scores_reach_every_ancestor():
    page = host_paths.Page("<div><div><div><p>" + "x" * 80 + "</p></div></div></div>")
    assert page.scores(page.noise()) == {0: 10.0, 1: 20.0, 2: 40.0, 3: 80.0}


def test_cut_paths_do_not_reach_around_the_best():
    html = "<div>" * 9 + "<div>out</div><div>" + "in " * 50 + "</div>" + "</div>" * 9
    path = "/".join(["div"] * host_paths.STEPS)
    assert host_paths.extract("<div>far</div>" + html, [path]) == "out " + ("in " * 50).strip()


def test_pages_of_another_template(spark):
    """Mostly plain hosts, pages without a host and a rare template: text around an article is out."""
    out = "<p>unmarked text</p>"
    plain, whole = "<p>some plain text of a page</p>", "some plain text of a page"
    article, story = f"{out}<article>{ARTICLE}</article>{out}", f"{out}<div class=story>{ARTICLE * 3}</div>{out}"
    long = " ".join([TEXT] * 3)
    thread = "<p>a reader says more than the article</p>" * 9
    rows = [("plain", plain, whole)] * 60 + [("plain", article, TEXT)] * 25 + [("plain", story, long)] * 15
    rows += [("rare", plain, whole)] * 199 + [("rare", article, TEXT)]
    # A path inside the article's that wins on few of the pages that have it does not replace it.
    told = "<div class=story>" + ARTICLE + "<div class=thread>{}</div></div>"
    rows += [("thread", told.format("ok"), TEXT + " ok")] * 50
    rows += [("thread", told.format(thread), TEXT + " a reader says more than the article" * 9)] * 3
    rows = [(k, f"http://{h}.example.com/{k}", x, want) for k, (h, x, want) in enumerate(rows)]
    rows += [(1000, None, plain, whole)] * 9 + [(1001, None, article, TEXT), (1002, "no host", story, long)]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in host_paths.extract_pages(df).collect()}
    assert got == {k: want for k, _, _, want in rows}


WORDS = " ".join(f"word{k}" for k in range(60))


@pytest.mark.parametrize(
    "html,want",
    [
        (f'<body><form id="aspnetForm"><div class=content><h1>T</h1><p>{WORDS}</p></div></form></body>', f"T {WORDS}"),
        (f'<body><form action="x"><div><p>{WORDS}</p></div></form><p>end</p></body>', WORDS),
        (f"<body><article><p>{WORDS}</p><form><p>Your mail</p></form></article></body>", WORDS),
        (f'<article><section id="discussion"><p>{WORDS}</p></section><section id="related-work"><p>more</p></section></article>', f"{WORDS} more"),
        (f'<article><p>{WORDS}</p><section id="comments"><p>first!</p></section></article>', WORDS),
        (f'<article><h2 id="form-validation">Forms</h2><h2 id="search">Find</h2><p>{WORDS} <em class="ad">ad</em></p></article>', f"Forms Find {WORDS} ad"),
        (f"<body><header><h2>Site</h2></header><article><header><h2>Title</h2></header><p>{WORDS}</p></article></body>", f"Title {WORDS}"),
        (f'<article><p>{WORDS}</p><p title="a > b">x</p><p title="open>y</p></article>', f"{WORDS} x y"),
    ],
)
def test_keeps_the_article(html, want):
    assert host_paths.extract(html, []) == want


@pytest.mark.parametrize(
    "part", ["<a ", '<a "', "<svg>", "</section>", "<b>", "<!", "<div><b></i>", "<div></p>", "<li><b>", "<a<", "<p '", "<!-- ", "<title"]
)
def test_broken_markup_takes_linear_time(part):
    html = "<article><p>text</p>" + part * (1_000_000 // len(part))
    began = time.process_time()
    host_paths.extract(html, [])
    host_paths.extract(html + ">", [])
    assert time.process_time() - began < 20

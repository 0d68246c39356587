import pytest

from stallkeeper.llm.main_text import extract_main_text, main_text

LONG = "This sentence is long enough to count as the text of an article by its length alone."


@pytest.mark.parametrize(
    "body, expected",
    [
        ("", ""),
        (None, ""),
        (f"<p>{LONG}</p>", LONG),
        (f"<article><h1>T</h1><p>{LONG}<br>more<p>end</article>", f"T\n\n{LONG} more\n\nend"),
        (f"<nav><ul><li>Menu</ul></nav><article><p>{LONG}</p></article><footer>f</footer>", LONG),
        (f'<div class="ad">Buy</div><p>{LONG}</p><div id="comments"><p>{LONG}</p></div>', LONG),
        (f"<form>{LONG}</form><script>var t='</p>';</script><p>{LONG}</p>", LONG),
        (f"<div class='sidebar'><div>x</div>y</div><div><p>{LONG}</p></div>", LONG),
        (f"<p>{LONG} &amp; &lt;b&gt;&nbsp;x</p>", f"{LONG} & <b> x"),
        ("<p>short</p>", "short"),
        (f"<article><p>{LONG}</p><p>cut in the mid", f"{LONG}\n\ncut in the mid"),
        ("no markup at all", "no markup at all"),
        (f"<nav>never closed<p>{LONG}</p>", f"never closed\n\n{LONG}"),
    ],
)
def test_main_text(body, expected):
    assert main_text(body) == expected


def test_links_do_not_surge():
    links = "".join(f"<li><a href='/{i}'>{LONG}</a></li>" for i in range(5))
    gap = "<hr><div></div><div></div><div></div>"
    assert main_text(f"<ul>{links}</ul>{gap}<p>{LONG}</p>") == LONG


def test_rows_nulls_and_clashing_columns(spark):
    rows = [(1, None, "u"), (2, "", None), (2, "<p>x</p>", "v"), (None, "<p>y</p>", "w")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = extract_main_text(pages, keys=("page_id",))
    assert found.columns == ["page_id", "text", "n_chars"]
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == [(1, "", 0), (2, "", 0), (2, "x", 1), (None, "y", 1)]
    assert extract_main_text(pages.limit(0), keys=("page_id",)).collect() == []


@pytest.mark.parametrize(
    "body, expected",
    [
        (f"<div><p class=notice>n<p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
        (f"<ul><li class=menu-item>m<li>{LONG}</ul><p>{LONG}</p>", f"{LONG}\n\n{LONG}"),
        (f"<div><div class=sidebar>s</div><div><div class=ad>x</div><p>{LONG}</div></div>", LONG),
        (f"<div><div><div class=sidebar>side</div><div><p>{LONG}</p></div>", LONG),
        (f"<section><div class=sidebar>side</section><div><p>{LONG}</p></div>", LONG),
        (f"<div class='content has-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<div class=no-sidebar><div class=elementor-widget><p>{LONG}</p></div></div>", LONG),
        (f"<form id=page><nav>n</nav><article><p>{LONG}</p></article></form>", LONG),
        (f"<form id=page><nav>n</nav><div><p>{LONG}</p></div></form>", LONG),
        (f"<p>{LONG}</p><div class=comments-area><p>{LONG}</p><p>{LONG}</p></div>", LONG),
        (f"<main><article><p>{LONG}</p></article></main><aside><article>{LONG * 3}</article></aside>", LONG),
    ],
)
def test_unwanted_parts_end_and_wrappers_stay(body, expected):
    assert main_text(body) == expected


@pytest.mark.parametrize("wrap", ["article", "main"])
def test_short_parts_of_an_article_stay(wrap):
    parts = ["Head", LONG, "Short.", "A quote", LONG, "End"]
    body = "".join(f"<div><div><div><p>{p}</p></div></div></div>" for p in parts)
    assert main_text(f"<{wrap}>{body}</{wrap}>") == "\n\n".join(parts)
    gap = "<div></div>" * 4
    links = f"<p>see <a href=x>{LONG}</a></p>"
    assert main_text(f"<{wrap}><h2>Head</h2>{gap}<p>{LONG}</p>{gap}{links}</{wrap}>") == (
        f"Head\n\n{LONG}\n\nsee {LONG}"
    )


def test_short_parts_between_kept_ones_stay():
    gap = "<div></div>" * 4
    body = f"<p>{LONG}</p>{gap}<p>Short.</p>{gap}<p>{LONG}</p>"
    assert main_text(body) == f"{LONG}\n\nShort.\n\n{LONG}"

"""Main text of pages."""

import html
import re

from ebbmark.llm import html_text

SF = "/root/testdata/sf0.001"


def test_given_pages_give_their_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    sources = {p.page_id: p.html for p in pages.collect()}
    rows = html_text.extract(pages).collect()
    assert len(rows) == len(sources)
    for r in rows:
        body = re.search(r"<article>(.*?)(</article>|$)", sources[r.page_id], re.S)[1]
        blocks = [
            " ".join(html.unescape(re.sub("<[^>]*>", " ", part)).split()) for part in re.split("</?(?:p|h1)>", body)
        ]
        assert r.text == "\n\n".join(filter(None, blocks))
        assert r.n_chars == len(r.text)


LONG = "Some words of an article that go on and on, as articles do, &amp; then stop."
PAGE = f"""<!doctype html><html><head><title>T</title><style>p {{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1><p>{LONG}</p></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="cookie-notice">{LONG}</div>
<main><h1>The   title</h1><p>{LONG}<p>Short.<form><input name=q><label>Search {LONG}</label></form>
<div class="advert">{LONG}</div><ul><li>First &lt;item&gt;</li><li>Second<br>line</li></ul>
<script>document.write("<p>{LONG}</p>")</script><p hidden>{LONG}</p><p>{LONG} <span class="ad">Buy</span>Last.</p>
<section id="comments"><h2>Comments</h2><p>{LONG}</p></section></main>
<aside><p>{LONG}</p></aside><footer><p>{LONG}</p></footer></body></html>"""


def test_parts_that_are_not_the_article_go():
    text = LONG.replace("&amp;", "&")
    assert html_text.main_text(PAGE) == "\n\n".join(
        ["The title", text, "Short.", "First <item>", "Second line", f"{text} Last."]
    )


def test_link_lists_without_a_name_go():
    links = "".join(f"<li><a href={k}>L{k}</a></li>" for k in range(12))
    page = f"<body><div><ul>{links}</ul></div><div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></div><table><tr><td><a>x</a></td></tr></table></body>"
    text = LONG.replace("&amp;", "&")
    assert html_text.main_text(page) == "\n\n".join(["Head", text, text])


def test_lead_and_headline_beside_a_long_body_stay():
    lead, long = "A lead that says what this is about. " * 8, "<p>" + LONG * 10 + "</p>"
    for tag in ("article", "main", "div"):
        page = f"<body><{tag}><h1>Head</h1><p>{lead}</p><div class=body>{long * 7}</div><div><p>{lead}</p></div></{tag}></body>"
        found = html_text.main_text(page).split("\n\n")
        assert found[-1] == lead.strip() and len(found) == (10 if tag != "div" else len(found))
        assert found[:2] == ["Head", lead.strip()]


def test_tables_and_short_sections_of_the_article_stay():
    cells = "".join(f"<tr><td>k{i}<td><a href={i}>{i}</a></tr>" for i in range(9))
    menu = "".join(f"<li><a href={k}>Link {k}</a></li>" for k in range(9))
    paragraphs = f"<p>{LONG}</p>" * 6
    page = (
        f"<article>{paragraphs}<table>{cells}</table><section><h2>Short</h2><p>a</p><ul><li>b</li></ul></section>"
        f"<div><ul>{menu}</ul></div><div><p>c</p></div></article>"
    )
    rest = [x for i in range(9) for x in (f"k{i}", f"{i}")]
    assert html_text.main_text(page).split("\n\n")[6:] == [*rest, "Short", "a", "b", "c"]


def test_broken_pages_do_not_fail():
    for page in ("", "<", "<p", "text &am", "</div></p>", "<p>a<p>b", "<article><p>a", "<script>x", "<!-- a", "<div class><p>a</div>", "a\0b"):
        html_text.main_text(page)
    assert html_text.main_text("<p>a<p>b") == "a\n\nb"
    assert html_text.main_text("text &amp") == "text &"
    assert html_text.main_text("<div>" * 3000 + "deep") == "deep"


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "<p>a</p>"), (2, ""), (3, "<p>é</p>")]
    pages = spark.createDataFrame(rows, "page_id int, html string").selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS tags")
    found = html_text.extract(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars, r.tags) for r in found) == [
        (0, "a", 1, 3),
        (1, "", 0, 3),
        (2, "", 0, 3),
        (2, "", 0, 3),
        (3, "é", 1, 3),
    ]
    assert html_text.extract(pages.limit(0)).count() == 0


def paragraphs(n):
    return [f"Paragraph {k} of a text, long enough to be told from a menu by what it holds." for k in range(n)]


def test_names_that_say_something_else_stay():
    body = "".join(f"<p>{p}</p>" for p in paragraphs(6))
    parts = {"social-history": "id", "related-work": "class", "market-share": "class", "comment-on-style": "id"}
    inner = "".join(f"<section {kind}={name}><h2>{name}</h2>{body}</section>" for name, kind in parts.items())
    for page in (f"<body><article><h1>Head</h1>{inner}</article></body>", f"<body><div><h1>Head</h1>{inner}</div></body>"):
        found = html_text.main_text(page).split("\n\n")
        assert found == ["Head", *(x for name in parts for x in [name, *paragraphs(6)])]


def test_doubtful_names_go_where_links_or_ratios_agree():
    body = "".join(f"<p>{p}</p>" for p in paragraphs(6))
    linked = "".join(f"<li><a href={k}>Another text with number {k}</a> today</li>" for k in range(2))
    short = "".join(f"<li><b>{k}</b> <i>x</i> <u>y</u></li>" for k in range(6))
    for inner in (linked, short):
        page = f"<body><article><h1>Head</h1>{body}<div class='related-reading'><ul>{inner}</ul></div></article></body>"
        assert html_text.main_text(page).split("\n\n") == ["Head", *paragraphs(6)]


def test_formulas_stay():
    page = f"<body><article><p>{LONG}</p><p>So <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>E=mc^2</annotation></math> holds.</p></article></body>"
    assert html_text.main_text(page).endswith("\n\nSo E=mc2 holds.")


def without_article():
    """A page of plain divs: menu, article, list of other pages, footer."""
    links = "".join(f"<div><a href={k}>Page {k}</a></div>" for k in range(15))
    body = "".join(f"<p>{p}</p>" for p in paragraphs(8))
    return f"<body><div>{links}</div><div><h1>Head</h1>{body}</div><div>{links}</div><p><b>2024</b> <i>Site</i></p></body>"


def test_pages_without_article_are_read_by_their_ratios():
    assert html_text.main_text(without_article()).split("\n\n") == ["Head", *paragraphs(8)]


def test_other_ratios_give_another_text(monkeypatch):
    plain = html_text.main_text(without_article())
    # The ratios turned round: what was dense is thin.
    smoothed = html_text._smoothed
    monkeypatch.setattr(html_text, "_smoothed", lambda own: smoothed(1 / (own + 0.1)))
    assert html_text.main_text(without_article()) != plain


def test_a_page_of_some_megabytes():
    many = paragraphs(30_000)
    page = "<body><nav>" + "<a href=x>Menu</a>" * 2000 + "</nav><div>" + "".join(f"<p>{p}</p>" for p in many) + "</div></body>"
    assert len(page) > 2_500_000
    assert html_text.main_text(page).split("\n\n") == many

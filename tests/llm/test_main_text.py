"""Which blocks of a page are content."""

import time

import pytest

from pageflow.llm import main_text

PARAGRAPHS = [f"This is paragraph {n} of the text, with enough words, commas, and sense to be read by anyone." for n in range(5)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


def lines(html):
    return main_text.extract(html).split("\n")


def test_ratios_decide_inside_an_article():
    links = "".join(f"<li><a href='/{n}'>Another story {n}</a></li>" for n in range(4))
    html = (
        f"<body><article><h1>Title of it</h1><div>Share this</div>{BODY[: len(BODY) // 5 * 3]}<h2>Middle</h2><p>Short.</p>"
        f"{BODY[len(BODY) // 5 * 3 :]}<div>All rights reserved</div><h3>More of us</h3><ul>{links}</ul></article></body>"
    )
    assert lines(html) == ["Title of it", *PARAGRAPHS[:3], "Middle", "Short.", *PARAGRAPHS[3:]]


def test_an_article_is_a_prior_only():
    html = f"<body><main><p>Welcome.</p></main><div><div>{BODY}</div></div></body>"
    assert set(PARAGRAPHS) <= set(lines(html))


def test_words_of_links_inside_paragraphs_stay():
    body = BODY.replace("enough words", "<a href='/w'>enough words</a>")
    assert lines(f"<body><div>{body}</div></body>") == PARAGRAPHS


REST = (
    "<h2>Steps</h2><ul><li>First item</li><li>Second item</li></ul><blockquote>Quoted.</blockquote><pre>x = 1</pre>"
    "<table><tr><td>Cell</td></tr></table>"
)
REST_LINES = ["Steps", "First item", "Second item", "Quoted.", "x = 1", "Cell"]


def test_lists_headings_and_tables_stay_without_an_article():
    bold = BODY.replace("enough words", "<b>enough words</b>")
    for body in (BODY, bold):
        html = f"<body><nav><a href='/'>Home</a></nav><div><h1>Title</h1>{body}{REST}</div><footer>Someone</footer></body>"
        assert lines(html) == ["Title", *PARAGRAPHS, *REST_LINES]


def test_a_split_body_stays_whole():
    lead = "A lead paragraph of some length, which stands beside the body, and says what it is about."
    html = f"<body><div><h1>Title</h1><p>{lead}</p><div>{BODY}{REST}</div></div></body>"
    assert lines(html) == ["Title", lead, *PARAGRAPHS, *REST_LINES]
    html = f"<body><div><div>{BODY}</div><section>{BODY}{REST}</section></div></body>"
    assert lines(html) == [*PARAGRAPHS, *PARAGRAPHS, *REST_LINES]


def test_a_body_of_list_items_keeps_its_heading():
    items = "".join(f"<li>{p}</li>" for p in PARAGRAPHS)
    assert lines(f"<body><div><h2>Notes</h2><ul>{items}</ul><p>End.</p></div></body>") == ["Notes", *PARAGRAPHS, "End."]


WRAPPERS = [
    "class='entry-content ad-free'", "class='layout-sidebar'", "class='post comments-open'", "class='search-results-page'",
    "class='content notice'", "class='social-science'", "class='related-articles'", "class='post-share-enabled'", "id='comments-page'",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_a_hint_does_not_empty_the_page(wrapper):
    page = f"<body><nav><a href='/'>Home</a></nav><div {wrapper}><h1>Title</h1>{BODY}</div><div class='footer'>Someone 2020</div></body>"
    assert lines(page) == ["Title", *PARAGRAPHS]
    nested = f"<body><div {wrapper}><h1>Title</h1>{BODY}<div class='sidebar'><p>{PARAGRAPHS[0]}</p></div></div></body>"
    assert lines(nested) == ["Title", *PARAGRAPHS]


def test_a_form_round_the_page_and_small_forms():
    assert lines(f"<body><form action='/'><h1>Title</h1>{BODY}</form></body>") == ["Title", *PARAGRAPHS]
    form = "<form><p>Your name, please, and your address:</p><input><button>Send</button></form>"
    assert lines(f"<body><div>{BODY}{form}</div></body>") == PARAGRAPHS


def comment(n, look="class='item'", tag="div"):
    return f"<{tag} {look}><div>Reader {n} says: 12 May 2020</div><p>I read all of it, {n} times, and I think that it is right, or nearly so.</p></{tag}>"


@pytest.mark.parametrize("inside", [True, False])
@pytest.mark.parametrize(
    "section",
    [
        "<ol class='commentlist'>" + "".join(comment(n, tag="li") for n in range(4)) + "</ol>",
        "<div id='responses'>" + "".join(comment(n) for n in range(2)) + "</div>",
        "<div class='respond'><p>Leave your thoughts, we read all of them, and answer most.</p></div>",
        "<section class='talkback'>" + "".join(comment(n) for n in range(3)) + "</section>",
        "<div class='reader-feedback'>" + comment(1) + "</div>",
        "<h2>3 Comments</h2><div>" + "".join(comment(n, f"class='entry entry-{n}'") for n in range(3)) + "</div>",
        "<h3>What readers wrote</h3>" + "".join(comment(n, "") for n in range(3)),
    ],
)
def test_reader_comments_are_left_out(inside, section):
    article = f"<h1>Title</h1>{BODY}{section}"
    page = f"<body><article>{article}</article></body>" if inside else f"<body><div>{article}</div></body>"
    assert [line for line in lines(page) if line not in ("3 Comments", "What readers wrote")] == ["Title", *PARAGRAPHS]


def test_many_comments_go_even_where_they_are_most_of_the_page():
    section = "<div class='comments'>" + "".join(comment(n) for n in range(40)) + "</div>"
    assert lines(f"<body><article>{BODY}</article>{section}</body>") == PARAGRAPHS
    assert lines(f"<body><div>{BODY}</div>{section}</body>") == PARAGRAPHS


def test_dated_entries_that_are_the_text_stay():
    entries = "".join(f"<div class='entry'><div>{n}:15</div><p>{p}</p></div>" for n, p in enumerate(PARAGRAPHS, 10))
    assert set(PARAGRAPHS) <= set(lines(f"<body><div><h1>As it happened</h1>{entries}</div></body>"))


def test_what_is_not_shown_is_left_out():
    hidden = f"<div style='color:red; display : none'><p>{PARAGRAPHS[0]} Hidden.</p></div><div class='adsbygoogle'>Buy, buy, buy.</div>"
    assert lines(f"<body><div>{BODY}{hidden}<div id='cookiebar'><p>We use cookies.</p></div></div></body>") == PARAGRAPHS


@pytest.mark.parametrize(
    "broken",
    ["</div>" * 40_000, "<!--" * 40_000, "<b>" * 20_000 + "</i>" * 20_000, "<p><span>" * 10_000, "<div class='ad'>x" * 4_000,
     "<div class='ad'>word</div>" * 10_000, "<" * 40_000, "<a " * 20_000, "&" * 40_000],
)
def test_broken_markup_takes_time_in_proportion(broken):
    page = f"<body><article>{BODY}</article>{broken}"
    begin = time.process_time()
    assert lines(page)[:5] == PARAGRAPHS
    assert time.process_time() - begin < 2

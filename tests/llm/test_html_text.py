"""Exact texts of pages whose structure is not the usual one."""
from tideline.llm import html_text


def test_letters_that_grow_in_lower_case():
    page = "İ" * 10 + "<SCRIPT>x</Script><article><p>First.</p></article><p>After.</p>"
    assert [(x[0], bool(x[1])) for x in html_text.lines(page) if x[0]] == [
        ("İ" * 10, False), ("First.", True), ("After.", False)]
    assert html_text.main_text(page) == "First."


BODY = ["A sentence of the body that is long enough to be the text of a page, whatever stands around it.",
        "Another one, which also holds more than enough characters to begin a text on its own, as it should."]


def test_unmarked_page():
    """The windows find the body, and an advert in it ends nothing."""
    page = ("<body><div>Tagline</div><nav><a href=/>Home</a></nav><ul><li><a href=1>One thing to read</a><li><a href=2>"
            "Another thing to read</a><li><a href=3>A third thing to read</a></ul>"
            f"<div><p>{BODY[0]}</p><p>Short.</p><div class=ad>Buy now</div><p>Short end.</p></div><ul><li><a href=4>A link"
            "</a><li><a href=5>A link</a><li><a href=6>A link</a></ul><p>(c) Someone</p></body>")
    assert html_text.main_text(page) == f"{BODY[0]} Short. Short end."


def test_body_beside_teasers():
    """Articles that are only teasers do not hide the body, and do not end it."""
    cards = "".join(f"<article><a href={i}>A title that leads to the story number {i}</a></article>" for i in range(4))
    page = f"<body><div>Tagline</div>{cards}<div><p>{BODY[0]}</p><p>{BODY[1]}</p>{cards}<p>Short end.</p></div></body>"
    assert html_text.main_text(page) == f"{BODY[0]} {BODY[1]} Short end."


def test_marked_article():
    """A short article is kept with its linked title; text beside it that is no surge is not."""
    page = ("<body><p>Welcome to this site</p><article><h2><a href=1>A linked title</a></h2><p>Only a few words.</p>"
            "<aside>An advert</aside><p>End.</p></article><p>Short note</p></body>")
    assert html_text.main_text(page) == "A linked title Only a few words. End."
    assert html_text.main_text("<article><a href=1>Nothing but a link</a></article>") == "Nothing but a link"
    assert html_text.main_text("<p>Tiny</p>") == "Tiny"


def test_a_long_notice_beside_an_article():
    notice = "<div><p>" + "We may change the terms of this site at any time and without further word. " * 2 + "</p></div>"
    page = f"<body>{notice}<article><p>{BODY[0]}</p><p>{BODY[1]}</p></article>{notice}</body>"
    assert html_text.main_text(page) == f"{BODY[0]} {BODY[1]}"
    teaser = "<article><p>What else happened today.</p></article>"
    assert html_text.main_text(f"<body>{teaser}<div><p>{BODY[0]}</p><p>{BODY[1]}</p></div></body>").endswith(f"{BODY[0]} {BODY[1]}")


def test_a_list_of_links_ends_no_text():
    links = "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a><li><a href=4>Four</a></ul>"
    page = f"<body>{links}<div><p>{BODY[0]}<p>{BODY[1]}</p>{links}<p>Last short line.</p></div>{links}<p>(c) Someone</p></body>"
    assert html_text.main_text(page) == f"{BODY[0]} {BODY[1]} One Two Three Four Last short line."
    # in the page itself nothing tells the end of the text from what follows
    assert html_text.main_text(f"<body><p>{BODY[0]}</p>{links}<p>(c) Someone</p></body>") == BODY[0]


def test_names_inside_an_article():
    page = ("<div class=entry-header>Menu of the site</div><article><div class='entry-header'><h1>Title</h1></div>"
            f"<p class='related work'>{BODY[0]}</p><section class=menu-of-the-day><p>Soup.</p></section>"
            "<div class=ad-slot>Buy</div><div class='large ad'>Now</div><p class=ad>More</p><div id=comments>Nice</div>"
            "<div role=navigation>Go</div><p class='share'>Send</p><p>End.</p></article>")
    assert html_text.main_text(page) == f"Title {BODY[0]} Soup. End."


def test_pages_without_blocks_or_with_stray_tags():
    for page in ("", "   ", "</div></p></article>", "<p>", "<div><div><div>", "<article></article>"):
        assert html_text.main_text(page) == ""
    assert html_text.main_text("</div><p>" + BODY[0] + "</section></p></p>") == BODY[0]

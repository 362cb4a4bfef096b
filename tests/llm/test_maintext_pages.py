"""Pages whose names or wrappers mislead."""

import pytest

from shopfloor.llm import maintext

P = "The committee met again on Tuesday, and the vote was put off, as it had been before; nobody was surprised."
PAGES = {
    "<article><p>P</p><aside><p>P a</p></aside><p>P b</p></article>": "P\nP b",
    "<article><p>P</p><footer><p>P a</p></footer></article>": "P",
    "<article><p>P</p><div class='related'><p>P a</p></div></article>": "P",
    "<article><p>P</p><div class='comments'><p>P a</p><p>P c</p></div></article>": "P",
    "<article><p>P</p><form><div class='text'>Leave a reply, please, and be kind.</div></form></article>": "P",
    "<div class='content no-sidebar'><p>P</p></div>": "P",
    "<div class='site-content has-sidebar'><p>P</p></div>": "P",
    "<article class='post comments-open'><p>P</p></article>": "P",
    "<div class='story share-enabled'><p>P</p></div>": "P",
    "<form><div class='article'><p>P</p></div></form>": "P",
    "<article><header class='post-header'><h1>A title</h1></header><p>P</p></article>": "A title\nP",
    "<div class='comments'><article><p>P</p></article></div>": "",
    "<div>Short text</div>": "Short text",
    "plain text only": "plain text only",
    "<nav><a href=x>Home</a></nav><div class=menu><a href=x>About</a></div>": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_names_are_evidence_for_what_an_element_is(page):
    full = "<p>" in page
    want = PAGES[page].replace("P", P) if full else PAGES[page]
    assert maintext.main_text(page.replace("<p>P", f"<p>{P}") if full else page) == want

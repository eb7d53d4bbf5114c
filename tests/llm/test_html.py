"""Pages on which the cut, and not the sign of a block's own cost, decides; odd markup; long pages."""

import time

import pytest

from shoprank.llm.html_cut import blocks_of, labelled, main_text

LONG = "It is a paragraph of the article, and all of it is to be read. " * 4


def test_the_cut_corrects_the_sign_of_short_blocks():
    page = f"<body><h1>Title</h1><p>{LONG}</p><pre>x = 1</pre><p>{LONG}</p><p>Bye</p><div><a href=x>Home</a> <a href=y>News</a></div></body>"
    blocks = blocks_of(page)
    costs, content = labelled(blocks)
    text = [b.text for b in blocks]
    changed = {t for t, cost, label in zip(text, costs, content) if (cost > 0) != label}
    assert {"x = 1", "Bye"} <= changed
    assert [t for t, label in zip(text, content) if label] == ["Title", LONG.strip(), "x = 1", LONG.strip(), "Bye"]


@pytest.mark.parametrize("page", [
    '<article><div class="notice-of-works"><p>%s</p></div></article>', '<article><ul class="responses"><li>%s</li></ul></article>',
    '<article><p>%s</p><div class="ad"><p>Buy this and that, as it is cheap.</p></div><div class="notice">We use cookies.</div></article>',
    '<!--><article><p>%s</p></article>', '<article><p title="a > b">%s</p></article>', "<article><p it's>%s</p></article>",
    '<article><p data-note="the hidden gem">%s</p><p hidden>Not this.</p></article>'])
def test_articles_keep_their_text(page):
    assert main_text(page % LONG + '<div class="sidebar"><p>Other things.</p></div>')[0] == LONG.strip()


def test_inline_elements_do_not_part_words():
    assert main_text('<article><p>inter<img src="x">rupted, in<script>x</script>tact<picture><source src="y"></picture>ly so.</p></article>')[0] == \
        "interrupted, intactly so."


def test_long_pages_take_time_by_their_length():
    for make in (lambda n: "<div>" * n + "text", lambda n: "<a '>" * n, lambda n: '<a ="' * n, lambda n: "<b>" * n + "<li>x" * n,
                 lambda n: "<form>" * n, lambda n: "<!--" * n):
        took = []
        for n in (10_000, 80_000):
            start = time.process_time()
            main_text(make(n))
            took.append(time.process_time() - start)
        assert took[1] < 30 * max(took[0], 0.02), make(2)

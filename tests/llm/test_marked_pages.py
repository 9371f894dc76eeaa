"""op8 on pages that mark articles: surges choose among the marked elements, and keep them whole."""

from staylens.llm import html_blocks

LONG = "word " * 30


def test_marked_elements_without_a_surge_are_left_out():
    teasers = "<article>Read on</article><p>1</p><p>2</p><p>3</p><p>4</p>"
    body = f"<article><h1>Title</h1><p>{LONG}</p><p>end</p></article>"
    assert html_blocks.main_text(teasers + body) == f"Title\n\n{LONG.strip()}\n\nend"


def test_a_marked_element_with_a_surge_stays_whole():
    short = "".join(f"<p>{n}</p>" for n in range(9))
    page = f"<p>before</p><main>{short}<nav>menu</nav><p>{LONG}</p>{short}</main><p>after</p>"
    kept = [str(n) for n in range(9)]
    assert html_blocks.main_text(page).split("\n\n") == [*kept, LONG.strip(), *kept]


def test_marked_text_without_any_surge_is_kept():
    assert html_blocks.main_text("<p>x</p><article>one</article><p>y</p><article>two</article>") == "one\n\ntwo"

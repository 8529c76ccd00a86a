"""Blocks that are mostly links, in the main element and outside it."""

from millrace.llm.extraction import main_text

PAGE = (
    "<p><a href=0>away</a></p><article><h1><a href=1>Title</a></h1><p><a href=2>A whole linked paragraph</a></p>"
    "<ul><li>Ref <a href=3>of a longer name</a></ul><nav><a href=4>next</a></nav></article><p><a href=5>more</a></p>"
)


def test_linked_blocks_of_the_main_element_stay():
    assert main_text(PAGE) == "Title A whole linked paragraph Ref of a longer name"
    assert main_text(PAGE.replace("article", "main")) == "Title A whole linked paragraph Ref of a longer name"


def test_linked_blocks_elsewhere_go():
    prose = "This is the text of the page and it is for you to read, as it was on the day that we had it. " * 3
    assert main_text(f"<p><a href=0>{prose}</a></p><p>{prose}</p>") == prose.strip()

"""Short headings and paragraphs are kept, and broken pages take linear time."""

import time

import pytest

from ridelake.llm import htmltext

TREE = htmltext.grow(*htmltext.labelled())
LONG = " ".join(f"word{i}" for i in range(40))


def text(page):
    return htmltext.main_text(page, TREE)[0]


def test_short_headings_and_paragraphs_outside_containers():
    page = (f"<body><h1>Short Title</h1><p>{LONG}.</p><h2>Results</h2><p>It failed.</p><p>{LONG}!</p></body>")
    assert text(page).split("\n") == ["Short Title", f"{LONG}.", "Results", "It failed.", f"{LONG}!"]


def test_captions_stay_whatever_their_class_says():
    page = (f'<div class=story><h1>One Title</h1><p>{LONG}</p><figure class="side"><figcaption>A caption of '
            f'twelve words that tells what the picture shows us</figcaption></figure><p>{LONG}</p></div>')
    assert "A caption" in text(page)


@pytest.mark.parametrize("page", [
    '<a title="x ' * 90_000, "<a title='x \"" * 80_000, "<div class=content>" * 60_000, "<" * 1_000_000,
    "<a <b " * 180_000, "<div>" * 100_000 + "</p>" * 120_000, "</script" * 130_000, "<script></script " * 60_000,
    "<!-- " * 200_000, '<a x="1" ' * 110_000 + ">", '<p class="comment">' * 50_000 + "text", "<![CDATA[" * 110_000])
def test_a_megabyte_of_broken_mark_up_ends_soon(page):
    began = time.monotonic()
    htmltext.main_text(page + "<p>end", TREE)
    assert time.monotonic() - began < 12


def test_tags_as_before():
    page = '<p title="a > b">one <b>two</b> 3 < 4 & <!-- no --> five</p><p>six <![CDATA[ seven ]]></p><p x="1>eight</p>nine'
    assert [b.text for b in htmltext.blocks(page)] == ["one two 3 < 4 & five", "six seven", "eight", "nine"]

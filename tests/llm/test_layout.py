"""Text of pages against a plain walk of their trees, hiding rules, and deep pages."""

import random
import re
import time

import pytest

from hubcat.llm import html_layout
from hubcat.llm.html_layout import visible_text


@pytest.mark.parametrize("source, text", [
    ("<style>.h{display:none}</style><p class=h>hid<p>seen", "seen"),
    ("<head><style>/* .x{display:none} */ #a , b.c { color:red; display : none !important }</style></head><body><p id=A>no<p><b class='d C'>no</b><b>yes</b><i class=x>x</i>", "yesx"),
    ("<style>.h{display:none}.h{display:block}</style><p class=h>seen", "seen"),
    ("<style>p.h{display:none}.h{display:block}</style><p class=h>no<div class=h>seen", "seen"),
    ("<style>.h{display:none!important}.h{display:block}</style><p class=h style='display:block'>no<p>yes", "yes"),
    ("<style>.h{display:none}</style><p class=h style='display:block'>own style wins", "own style wins"),
    ("<style>@media print{.h{display:none}} @media screen{.s{display:none}} @import 'x'; .t{display:none}</style><p class=h>seen<p class=s>no<p class=t>no", "seen"),
    ("<style media=print>p{display:none}</style><p>seen", "seen"),
    ("<style>div .h, .h:hover, [x], a>.h{display:none}</style><p class=h>seen", "seen"),
    ("<style>.v{visibility:hidden}.w{visibility:visible}</style><div class=v>no <b class=w>yes</b></div>", "yes"),
    ("<style>.a{display:none}.b{display:none}.a{display:block}</style><p class='a b'>seen", "seen"),
    ("<style>p{display:none", ""),
    ("<style>}}{ {p{display:none}}</style><p>seen", "seen"),
])
def test_hiding_rules_of_the_page(source, text):
    assert visible_text(source) == text


def made_page(rng, depth=0):
    """Well-formed markup, and its words in order, hidden ones left out."""
    out, words = [], []
    for _ in range(rng.randrange(1, 5)):
        kind = rng.randrange(7)
        if kind < 2 or depth > 5:
            word = f"w{rng.randrange(10 ** 6)}"
            out.append(word)
            words.append(word)
        elif kind == 2:
            inner, _ = made_page(rng, depth + 1)
            out.append(rng.choice([f"<div hidden>{inner}</div>", f"<script>{'var x;'}</script>", f"<div style='display: none'>{inner}</div>", f"<div class=gone>{inner}</div>"]))
        else:
            inner, own = made_page(rng, depth + 1)
            out.append({3: f"<div>{inner}</div>", 4: f"<ul><li>{inner}</li></ul>", 5: f"<b>{inner}</b>", 6: f"<section><span>{inner}</span></section>"}[kind])
            words += own
    return " ".join(out), words


def test_all_shown_words_in_order():
    rng = random.Random(5)
    for _ in range(300):
        source, words = made_page(rng)
        assert re.findall(r"w\d+", visible_text(f"<style>.gone{{display:none}}</style>{source}")) == words


def plain_end(opened, tag, within):
    """How many elements a stray or matching end tag leaves open, element by element."""
    for depth in range(len(opened) - 1, 0, -1):
        if opened[depth] == tag:
            return opened[:depth]
        if opened[depth] in within:
            return opened
    return opened


def test_ends_against_a_walk_of_the_open_elements():
    rng = random.Random(9)
    tags = ["b", "i", "div", "table", "td", "tr", "span"]
    for _ in range(400):
        opened, source = ["html"], ""
        for k in range(25):
            tag = rng.choice(tags)
            if rng.random() < 0.55 and tag in ("b", "i", "div", "span"):
                opened.append(tag)
                source += f"<{tag}>"
            elif tag in ("b", "i", "div", "span"):
                source += f"</{tag}>"
                opened = plain_end(opened, tag, html_layout.P_ENDS)
        node, depth = html_layout.build(source + "MARK"), 0
        found = []
        while True:
            inner = [c for c in node.children if not isinstance(c, str)]
            found.append(node.tag)
            if any(isinstance(c, str) and "MARK" in c for c in node.children):
                break
            node = inner[-1]
        assert found == opened


@pytest.mark.parametrize("source", [
    "<div>" * 200_000 + "x", "<b>" * 200_000 + "x" + "</i>" * 200_000, "<p>" * 100_000 + "x", "<p><b>" * 100_000 + "</p>x" * 10, "</div>" * 200_000 + "x",
    "<span>" * 100_000 + "</p>" * 3 + "x" + "</span>" * 100_000, "<style>" + ".a{display:none}" * 50_000 + "</style>" + "<b class='b c'>" * 50_000 + "x"])
def test_deep_pages_take_time_in_proportion(source):
    start = time.process_time()
    assert "x" in visible_text(source)
    assert time.process_time() - start < 20

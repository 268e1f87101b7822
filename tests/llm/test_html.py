"""Main text of made pages, the ratio's part in it, and time on hostile pages."""

from __future__ import annotations

import math
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import html


def long(k: int) -> str:
    return " ".join(f"word{k}x{i}" for i in range(40)) + "."


P1, P2 = f"<p>{long(1)}</p>", f"<p>{long(2)}</p>"
MENU = "<ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>"
TALK = "<div class=talk><div><b>Ann</b> <i>2 days</i><p>Nice one</p></div><div><b>Bob</b> <i>3 days</i><p>I agree</p></div></div>"
PAGES = {
    "menu inside the article": (f"<article><h1>Title</h1>{P1}{MENU}{P2}<p>Short.</p></article>", ["Title", long(1), long(2), "Short."]),
    "comments of an unknown class": (f"<article><h1>T</h1>{P1}{P2}<p>End.</p>{TALK}</article>", ["T", long(1), long(2), "End."]),
    "footer list": (f"<div><h1>T</h1>{P1}{P2}<p>End.</p></div><div></div><ul><li>About us<li>Contact<li>Imprint</ul>", ["T", long(1), long(2), "End."]),
    "marked article": (f"<nav>x</nav><article class='story notice'><h1>T</h1>{P1}{P2}</article>", ["T", long(1), long(2)]),
    "marked division": (f"<div class=ad>Buy this now!</div><div class='story notice'><h1>T</h1>{P1}{P2}</div>", ["T", long(1), long(2)]),
    "advert longer than the article": (f"<div class=ad>{long(3)}</div><article><p>Few words.</p></article>", ["Few words."]),
    "comments longer than the article": (f"<div><p>Few words, but an article.</p></div><div id=comments>{P1}{P2}</div>", ["Few words, but an article."]),
    "a list ends the article": (f"<article>{P1}<ul><li>one</li><li>two</li></ul></article><footer>f</footer>", [long(1), "one", "two"]),
    "a paragraph that is a link": (f"<article>{P1}<p><a href=x>See there</a></p>{P2}</article>", [long(1), "See there", long(2)]),
    "heading in an element of its own": (f"<div><div><h2>Part</h2></div><div>{P1}{P2}</div></div>", ["Part", long(1), long(2)]),
    "unended tag": (f"<p>{long(1)}</p><p>and < more <a href='x", [long(1), "and < more"]),
}


@pytest.mark.parametrize("name", PAGES)
def test_made_pages(name):
    page, want = PAGES[name]
    assert html.main_text(page).split("\n\n") == want


def test_the_ratio_decides():
    """Without a threshold the comments and the footer list stay."""
    for name in ("comments of an unknown class", "footer list"):
        page, want = PAGES[name]
        assert len(html.main_text(page, share=0.0).split("\n\n")) > len(want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=40), st.sampled_from([0.7, 1.0, 2.0]), st.sampled_from([0.5, 1.0, 1.5]))
def test_regions_against_brute_force(values, sigma, share):
    reach, n = max(1, math.ceil(3 * sigma)), len(values)
    level = []
    for i in range(n):
        near = [(math.exp(-0.5 * ((j - i) / sigma) ** 2), values[j]) for j in range(max(0, i - reach), min(n, i + reach + 1))]
        level.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    assert np.allclose(html.smoothed(np.array(values, float), sigma), level)
    least = min(share * float(np.std(level)), max(level))
    if any(abs(x - least) < 1e-9 for x in [*level, *values]):
        return  # rounding decides
    want, i = [], 0
    while i < n:
        j = i
        while j < n and level[j] >= least:
            j += 1
        own = [k for k in range(i, j) if values[k] >= least and values[k] > 0]
        if own:
            want.append((own[0], own[-1] + 1))
        i = max(j, i + 1)
    got = html.regions(np.array(values, float), sigma, share)
    assert got == want or not want and len(got) == any(values)


HOSTILE = {
    "nested": "<div>x" * 170_000,
    "unended": "<a " * 340_000,
    "ended once": "<a " * 340_000 + ">x",
    "open inline elements": "<p><div>" + "<b>" * 150_000 + "<hr>" * 150_000,
    "unknown ends": "<div>" * 100_000 + "</foo>" * 90_000,
    "items": "<ul>" + "<span>" * 80_000 + "<li>x</li>" * 50_000,
    "marks": "<div class=ad>x" * 70_000,
    "comments": "<!--" * 250_000,
    "attributes": '<a x="' * 170_000 + ">",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_a_megabyte_takes_seconds(name):
    start = time.process_time()
    html.main_text(HOSTILE[name])
    assert time.process_time() - start < 20

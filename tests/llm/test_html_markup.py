"""What markup keeps and drops."""

import pytest

from tabspark.llm.html_extract import blocks

CASES = [
    ("<div class='comments'><article>reader one</article><p>first!</p></div><article>real</article>", ["real"]),
    ("<article>real</article><section id=comments><article class=comment><p>a reader</p></article></section>", ["real"]),
    ("<div class='post-comments'><p>" + "many words of readers " * 20 + "</p></div><p>short story</p>", ["short story"]),
    ("<article><p>x <math><mi>a</mi><mo>+</mo><mn>1</mn></math> y</p></article>", ["x a+1 y"]),
    ("<article><p>press <button>Start</button> now</p><noscript><p>plain words</p></noscript><object>fallback</object></article>", ["press Start now", "plain words", "fallback"]),
    ("<article><p class='share'>Share of the market rose.</p><h2 class=alert>Alert</h2><p class='related'>Related work.</p></article>", ["Share of the market rose.", "Alert", "Related work."]),
    ("<article><p>x</p><p class='ad'>Buy</p><p class='cookie-notice'>c</p><div class='share'><a>Tweet</a></div></article>", ["x"]),
    ("<p>one</p><figure><img src=x><figcaption>A caption.</figcaption></figure><p>two</p>", ["one", "A caption.", "two"]),
    ("<article><header><h1>Title</h1></header><p>x</p></article><header>Site</header>", ["Title", "x"]),
    ("<article><p>x</p><form><button>Send</button></form><script>b()</script><select><option>o</option></select></article>", ["x"]),
]


@pytest.mark.parametrize("body, text", CASES)
def test_markup(body, text):
    assert [t for _, t in blocks(f"<html><body>{body}</body></html>")] == text

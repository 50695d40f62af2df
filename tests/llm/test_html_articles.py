"""op6 on articles in parts and on layout wrappers."""

import pytest

from refiscope.llm import html_text

LONG = ["".join(f"Sentence {k} of part {i} goes on. " for k in range(12)).strip() for i in range(3)]
COMMENTS = "<div class='comments-area'><p>" + "A comment that is long. " * 30 + "</p></div>"
TWO = "<h1>Head</h1><p>Intro.</p>"
ALL = "Head\nIntro.\n" + "\n".join(LONG[:2])
CASES = {
    "sections": (f"<article>{TWO}<section><p>{LONG[0]}</p></section><section><p>{LONG[1]}</p></section></article>", ALL),
    "header": (f"<article><header><h1>Head</h1></header><div class=body><p>{LONG[0]}</p></div></article>", "Head\n" + LONG[0]),
    "two divs": (f"<article>{TWO}<div class=one><p>{LONG[0]}</p></div><div class=two><p>{LONG[1]}</p></div></article>", ALL),
    "two bare divs": (f"<div class=post>{TWO}<div class=one><p>{LONG[0]}</p></div><div class=two><p>{LONG[1]}</p></div></div>", ALL),
    "same bare divs": (f"<div class=post>{TWO}<div class=part><p>{LONG[0]}</p></div><div class=part><p>{LONG[1]}</p></div></div>", ALL),
    "has-sidebar": (f"<div class='layout has-sidebar'><div class=content>{TWO}<p>{LONG[0]}</p><p>{LONG[1]}</p></div><div class=sidebar><p>{LONG[2]}</p></div></div>", ALL),
    "no-comments": (f"<section class='no-comments'>{TWO}<p>{LONG[0]}</p><p>{LONG[1]}</p></section>", ALL),
    "comments": (f"<div class=post>{TWO}<p>{LONG[0]}</p></div>{COMMENTS}", "Head\nIntro.\n" + LONG[0]),
}


@pytest.mark.parametrize("case", CASES)
def test_article(case):
    html, want = CASES[case]
    page = html_text.read_page(f"<body><nav>Menu</nav>{html}<div>Short other text.</div><footer>Foot</footer></body>")
    winner = max(html_text.votes(page), key=lambda v: (v[1], len(v[0]), v[0]))[0]
    assert html_text.extract(page, winner) == want

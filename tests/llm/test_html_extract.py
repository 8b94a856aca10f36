"""Extraction: what stays and goes inside an article, time on odd pages, and the choice of named elements against a slow one."""

import random
import time

import pytest

from strata.llm import html_extract as h

A = "One long sentence, with some words in it, and more. " * 3
B = "Another long sentence, with words in it too, as before. " * 3
WANT = "Title\n" + A.strip() + "\n" + B.strip()
ARTICLE = f"<h1>Title</h1><p>{A}</p><p>{B}</p>"


@pytest.mark.parametrize("extra", [
    '<div class="author-bio-newsletter"><p>Sign up, today.</p></div>', '<section class="tags-and-share"><p>Tell others, please.</p></section>',
    '<div id="cookie-notice-v2"><p>We use cookies, as all do.</p></div>', '<article><p>A reader says, this is good.</p></article>',
    '<ul class="more"><li><a href=a>First other story</a></li><li><a href=b>Second other story</a></li></ul>',
    '<div class="userDiscussion"><p>I think, it is so.</p><p>Me too, indeed.</p></div>'])
def test_extras_in_an_article_go(extra):
    assert h.main_text(f"<body><article>{ARTICLE}{extra}</article></body>") == WANT
    assert h.main_text(f"<body><main><article>{ARTICLE}{extra}</article></main></body>") == WANT


def test_one_article_is_the_text():
    card = "<article class=x><h2>Other story</h2><p>Teaser text, read more.</p></article>"
    assert h.main_text(f"<body>{card}<article>{ARTICLE}</article>{card * 3}</body>") == WANT
    assert h.main_text(f"<body><main>{card}<article><p>{A}</p><p>{B}</p></article>{card * 3}</main></body>") == WANT.removeprefix("Title\n")
    assert h.main_text(f"<body><main><h1>Title</h1><article><p>{A}</p><p>{B}</p></article></main></body>") == WANT


def test_headings_short_blocks_and_states_stay():
    page = f'<article class="has-sidebar"><h1><a href=x>Title</a></h1><div class="with-ads"><p>{A}</p><h2>Part</h2><p>Yes.</p><ul><li>One<li>Two</ul><p>{B}</p></div></article>'
    assert h.main_text(page).split("\n") == ["Title", A.strip(), "Part", "Yes.", "One", "Two", B.strip()]


PAGES = {"nested": "".join(f'<div class="sidebar s{i}">' for i in range(4000)) + "<p>Some text, here.</p>" * 10,
         "named": '<div class="ad"><p>x, y.</p>' * 4000, "headings": '<div class="notice"><h1>x</h1>' * 4000,
         "stray": "<div>" * 4000 + "</section></p></li>" * 4000, "no end": "<p>a, b." + "<a " * 100_000, "declarations": "<!" * 100_000 + "x",
         "deep": "<blockquote>" * 4000 + "<p>t, t.</p><li>x" * 2000, "paths": "".join(f'<div class="c{i}">t, u.' for i in range(4000))}


@pytest.mark.parametrize("name", PAGES)
def test_odd_pages_take_linear_time(name):
    start = time.perf_counter()
    h.main_text(PAGES[name])
    assert time.perf_counter() - start < 2


def slow_noise(page):
    """Which blocks are noise, from every block's full list of named elements around it."""
    blocks, _, named, _ = h.read_blocks(page)
    chains = []
    for b in blocks:
        k, chain = b[5], []
        while k >= 0:
            chain.insert(0, k)
            k = named[k][1]
        chains.append(chain)
    prose = [max(len(b[2]) - b[3], 0) for b in blocks]

    def heading(k):
        return named[k][2] or any(heading(j) for j in range(len(named)) if named[j][1] == k)

    over = set()
    shown = sum(n for n, b, c in zip(prose, blocks, chains) if not b[4] and not c)
    for k in range(len(named)):
        mine = [i for i, c in enumerate(chains) if k in c and not blocks[i][4]]
        own = sum(prose[i] for i in mine if not any(j > k and named[j][0] & h.COMMENTS for j in chains[i]))
        if own and own >= h.OVERRULE * (own + shown) and (heading(k) or not named[k][0] & h.STRICT):
            over.add(k)
            shown += sum(prose[i] for i in mine if set(chains[i]) <= over)
    return [b[4] or not set(c) <= over for b, c in zip(blocks, chains)]


@pytest.mark.parametrize("seed", range(60))
def test_named_elements_as_by_the_slow_way(seed):
    r = random.Random(seed)

    def part(depth):
        out = []
        for _ in range(r.randrange(1, 4)):
            u = r.random()
            if u < 0.45 or depth > 5:
                out.append(f"<p>{'word, ' * r.choice([1, 3, 30])}</p>")
            elif u < 0.55:
                out.append("<h1>Main</h1>")
            else:
                name = r.choice(["sidebar", "comments", "menu", "ad", "plain", "cookie-box", "has-ads"])
                out.append(f'<{(e := r.choice(["div", "section", "nav", "article", "form"]))} class="{name}">{part(depth + 1)}</{e}>')
        return "".join(out)
    page = f"<body>{part(0)}{part(0)}</body>"
    assert [b[4] for b in h.blocks_of(page)[0]] == slow_noise(page)

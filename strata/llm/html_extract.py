"""Main text of web pages by tag-path ratios.

A page is read once into blocks of text, each with the path of block elements
from the root to it.  Per distinct path the text length, punctuation and link
text are summed over its blocks; the ratios per block are smoothed along the
page, fused into one score, and paths from a threshold on are content.  On a
page with articles the one with the most prose by score is the text: an article
inside it or beside it (a card, a comment) is not.  What lies beside a content
path in it (headings, lists, short paragraphs) belongs to it, except blocks that
are mostly links on a path below the threshold; menus, headers, footers,
sidebars, notices, adverts, forms, comments and scripts never do, by element or
by class name.  A name counts as a whole class, id or role, or with words that
only say where or what (``site-footer``); on an element that holds others, also
beside unknown words (``tags-and-share``), unless they tell a state of the page
(``has-sidebar``).  One on an element that holds most of the page's prose is
overruled.

Work is linear in the page, however deep its elements nest.

Defined results: null or empty html gives an empty text; html without any tag
is one block.  A line break element is white space.  Formulas are text.
Unclosed, stray and wrongly nested tags are read as a browser would, but an
embedded element (``EMBEDDED``) that is never closed holds nothing.  Hidden
elements (hidden, aria-hidden, display or visibility) are left out, whatever
they hold.  Repeated rows are extracted one by one.  Pages of any length are
read whole; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import append, fresh, table

#: A path is content from this share of the scores' standard deviation on.
THRESHOLD = 0.8

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Elements whose text is never shown or never prose; an unclosed one takes the rest of the page, as in a browser.
RAW = {"script", "style", "noscript", "iframe", "textarea", "title"}
#: The same for elements that are skipped up to their own end tag.
EMBEDDED = {"template", "svg", "object", "canvas", "annotation", "annotation-xml"}
PAIRS = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|iframe|textarea|title)\b.*?(?:</\1\s*>|\Z)"
                   r"|<(/?)(" + "|".join(sorted(EMBEDDED, key=len, reverse=True)) + r")(?=[\s/>])((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>",
                   re.S | re.I)
VOID = {"br", "hr", "img", "input", "meta", "link", "source", "wbr", "area", "base", "col", "embed", "track", "param"}
BLOCK = {"html", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li",
         "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure",
         "figcaption", "address", "header", "footer", "nav", "aside", "form", "fieldset", "details", "summary", "dialog",
         "center", "hgroup", "menu", "head", "select", "button", "label", "search", "hr"}
NOISE = {"nav", "aside", "footer", "form", "menu", "dialog", "head", "select", "button", "fieldset", "search"}
WORDS = {"ad", "ads", "advert", "advertisement", "adverts", "adsense", "sponsor", "sponsored", "promo", "promotion",
         "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay",
         "newsletter", "subscribe", "signup", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb",
         "breadcrumbs", "footer", "masthead", "comment", "comments", "reply", "replies", "disqus", "share", "sharing",
         "social", "related", "widget", "toolbar", "pagination", "pager", "complementary", "contentinfo", "search"}
#: Words that may stand beside one of WORDS in a name.
BESIDE = {"site", "page", "main", "global", "top", "bottom", "left", "right", "primary", "secondary", "header", "container",
          "wrapper", "wrap", "box", "block", "bar", "area", "section", "list", "item", "items", "inner", "outer", "links",
          "link", "button", "buttons", "icons", "posts", "articles", "form", "post", "article", "slot", "unit", "text", "message",
          "policy", "panel", "group", "title", "body", "thread", "media", "email", "mobile", "desktop"}
#: Names of prose that is not the page's; on such an element the prose counts only below the page's main heading.
STRICT = WORDS - {"sidebar", "menu", "nav", "navbar", "navigation", "banner", "masthead", "related", "widget", "toolbar",
                  "search", "share", "sharing", "social", "pagination", "pager", "complementary", "breadcrumb", "breadcrumbs"}
COMMENTS = {"comment", "comments", "reply", "replies", "disqus", "discussion", "responses", "commenter", "commentary"}
#: Words before a noise word that tell a state, not what an element holds.
STATES = {"has", "with", "no", "without", "is", "not", "show", "hide", "hides", "under", "next", "overflow"}
#: Elements that hold other blocks: there a noise word beside unknown words counts too.
HOLDERS = {"div", "section", "ul", "ol", "dl", "table", "details", "figure", "header", "blockquote"}
#: In the article, blocks with less than this share of text outside links go where their path is below the threshold.
LINKED = 0.3
#: A named element is content from this share of its own and the shown prose on.
OVERRULE = 2 / 3
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
LISTS = {"ul", "ol", "dl", "table", "menu", "div", "section", "article", "main", "body"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


def attributes(raw: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for a in ATTRIBUTE.finditer(raw):
        out.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
    return out


def is_hidden(own: dict[str, str]) -> bool:
    if own.get("hidden", "until-found").strip().lower() != "until-found" or own.get("aria-hidden", "").strip().lower() == "true":
        return True
    style = (d.partition(":") for d in own.get("style", "").lower().split(";"))
    return any((k.strip(), v.replace("!important", "").strip()) in (("display", "none"), ("visibility", "hidden")) for k, _, v in style)


def noise_words(names: list[str], holder: bool = False) -> set[str]:
    """Words of noise in names: alone, beside words of BESIDE only, or, on an element that holds others, beside any but STATES."""
    out: set[str] = set()
    for name in names:
        split = {w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w}
        if split <= WORDS | COMMENTS | BESIDE or holder and not split & STATES:
            out |= split & (WORDS | COMMENTS)
    return out


def ends(page: str) -> dict[int, int]:
    """Where each closed embedded element's start tag ends, and where its end tag does."""
    open_: dict[str, list[int]] = {}
    out: dict[int, int] = {}
    for m in PAIRS.finditer(page):
        name = (m[3] or "").lower()
        if not name:
            continue
        if m[2]:
            if open_.get(name):
                out[open_[name].pop()] = m.end()
        elif not m[4].endswith("/"):
            open_.setdefault(name, []).append(m.end())
    return out


def blocks_of(page: str) -> tuple[list[tuple[int, int, str, int, bool]], dict[int, tuple[int, str]], list[int]]:
    """Blocks (path, article, text, link characters, noise) in page order, each path's parent and key, and the article around each article."""
    blocks, parents, named, around = read_blocks(page)
    prose = [max(len(b[2]) - b[3], 0) for b in blocks]
    shown = sum(n for n, b in zip(prose, blocks) if not b[4] and b[5] < 0)
    direct = [0] * len(named)               # prose with no named element between
    for n, b in zip(prose, blocks):
        if not b[4] and b[5] >= 0:
            direct[b[5]] += n
    own, heading = direct[:], [h for _, _, h in named]
    for k in range(len(named) - 1, -1, -1):     # inner elements first; comments count for nothing around them
        up = named[k][1]
        if up >= 0:
            own[up] += 0 if named[k][0] & COMMENTS else own[k]
            heading[up] = heading[up] or heading[k]
    content = [False] * len(named)
    for k, (words, up, _) in enumerate(named):  # outer elements first
        overruled = own[k] and own[k] >= OVERRULE * (own[k] + shown) and (heading[k] or not words & STRICT)
        content[k] = bool(overruled) and (up < 0 or content[up])
        shown += direct[k] if content[k] else 0
    return [(*b[:4], b[4] or b[5] >= 0 and not content[b[5]]) for b in blocks], parents, around


def read_blocks(page: str) -> tuple[list[tuple], dict[int, tuple[int, str]], list[tuple[set[str], int, bool]], list[int]]:
    """Blocks (path, article, text, link characters, noise by element, innermost named element or -1), the paths, the
    named elements (words, the named element around, whether a main heading is directly in it) and the article around each article."""
    paths: dict[tuple[int, str], int] = {}
    parents: dict[int, tuple[int, str]] = {0: (-1, "")}
    # open block elements: name, path, article (0: none), noise by element or hidden, innermost named element, hidden
    stack: list[tuple[str, int, int, bool, int, bool]] = [("", 0, 0, False, -1, False)]
    open_names: Counter[str] = Counter()
    out: list[tuple] = []
    named: list[tuple[set[str], int, bool]] = []
    around = [0]
    closed: dict[int, int] | None = None
    held: list[str] = []
    link = links = 0
    last = page.rfind(">")                 # no tag ends behind it

    def flush() -> None:
        nonlocal links
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                _, path, article, by_element, by_name, unseen = stack[-1]
                out.append((path, article, text, links, by_element or unseen, by_name))
        links = 0

    def text(part: str) -> None:
        nonlocal links
        held.append(part)
        if link:
            links += len(part.strip())

    def shut(i: int) -> None:
        for e in stack[i:]:
            open_names[e[0]] -= 1
        del stack[i:]

    at, end = 0, len(page)
    while at < end:
        less = page.find("<", at)
        if less < 0:
            text(page[at:])
            break
        if less > at:
            text(page[at:less])
        m = TAG.match(page, less) if less < last or page.startswith("<!--", less) else None
        if not m:
            text("<")
            at = less + 1
            continue
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:                                        # an end tag
            if name == "a":
                link = max(0, link - 1)
            elif name in BLOCK:
                flush()
                if open_names[name]:
                    shut(innermost(stack, name))
            continue
        if name in RAW:
            if not m[3].endswith("/"):
                close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if name in EMBEDDED:
            if closed is None:
                closed = ends(page)
            at = max(at, closed.get(at, at))
            continue
        if name in ("br", "wbr"):
            if name == "br":
                held.append(" ")
            continue
        if name == "a":
            link += 1
            continue
        if name not in BLOCK:
            continue
        flush()
        link = 0 if link and name in ("p", "div", "section", "article") else link
        if name in VOID:
            continue
        implied = open_names["p"] or any(open_names[x] for x in CLOSES.get(name, ()))
        for i in range(len(stack) - 1, 0, -1) if implied else ():       # implied ends
            here = stack[i][0]
            if here == "p" or here in CLOSES.get(name, ()):
                shut(i)
                if here != "p":
                    break
            elif here in LISTS or name not in CLOSES and here not in ("head",):
                break
        if name == "body" or name in ("article", "main") and stack[-1][0] == "head":
            while len(stack) > 1 and stack[-1][0] == "head":
                shut(len(stack) - 1)
        _, up, article, by_element, by_name, unseen = stack[-1]
        own = attributes(m[3]) if m[3].strip() else {}
        names = [w for a in ("class", "id", "role") for w in own.get(a, "").split()]
        marks = {w for n in names for w in re.split(r"[^a-z]+", n.lower())}
        noise = noise_words(names, name in HOLDERS)
        if name in ("html", "body"):
            noise = set()
        elif is_hidden(own):
            unseen = True
        if name in ("article", "main"):
            by_name, noise = -1, noise if noise & COMMENTS else set()
            around.append(article)
            article = len(around) - 1
        if noise:
            named.append((noise, by_name, False))
            by_name = len(named) - 1
        if name == "h1" and by_name >= 0:
            named[by_name] = (*named[by_name][:2], True)
        if name in NOISE or name == "header" and not article:
            by_element = True
        key = name + "." + min(marks - {""}, default="")
        path = paths.get((up, key))
        if path is None:
            path = paths[up, key] = len(parents)
            parents[path] = (up, key)
        stack.append((name, path, article, by_element, by_name, unseen))
        open_names[name] += 1
    flush()
    return out, parents, named, around


def innermost(stack: list[tuple], name: str) -> int:
    """Place of the innermost open element of that name; each element passed on the way is closed with it."""
    i = len(stack) - 1
    while stack[i][0] != name:
        i -= 1
    return i


def smooth(values: np.ndarray) -> np.ndarray:
    """Gaussian smoothing along the page (radius 2)."""
    kernel = np.exp(-np.arange(-2, 3) ** 2 / 2.0)
    padded = np.convolve(values, kernel)[2:-2] if len(values) else values
    weight = np.convolve(np.ones(len(values)), kernel)[2:-2] if len(values) else values
    return padded / weight


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    blocks, parents, around = blocks_of(page or "")
    shown = [b for b in blocks if not b[4]]
    if not shown:
        return ""
    number: dict[int, int] = {}
    own = np.array([number.setdefault(b[0], len(number)) for b in shown])
    n = np.bincount(own)
    length = np.array([len(b[2]) for b in shown], float)
    prose = np.maximum(length - [b[3] for b in shown], 0)
    marks = np.array([len(PUNCTUATION.findall(b[2])) for b in shown], float)
    ratios = []
    for values in (prose, marks):
        per_path = np.bincount(own, values) / n                 # text, punctuation per node of the path
        along = smooth(per_path[own])
        per_path = np.bincount(own, along) / n
        ratios.append(per_path / max(per_path.max(), 1e-9))
    unlinked = np.bincount(own, prose) / np.maximum(np.bincount(own, length), 1)
    score = (0.7 * ratios[0] + 0.3 * ratios[1]) * unlinked
    chosen = score >= threshold * score.std()
    best = int(np.bincount(own, prose * score[own]).argmax())
    chosen[best] = True
    ids = list(number)
    # the article with the most prose by score bounds the content; without articles, the parent element of the best path
    article_of = {b[0]: b[1] for b in shown}
    weight = np.zeros(len(around))
    np.add.at(weight, [b[1] for b in shown], prose * score[own])
    if article_of[ids[best]]:
        article = 1 + int(weight[1:].argmax())
        outer, up = set(), around[article]
        while up:
            outer.add(up)
            up = around[up]
        heading = {p for p in ids if re.match(r"h[1-6]\.", parents[p][1])}
        linked = {p for i, p in enumerate(ids) if not chosen[i] and unlinked[i] < LINKED} - heading
        # a main heading may stand outside its article, in the element that holds both
        return "\n".join(b[2] for b in shown if b[1] == article and b[0] not in linked or b[1] in outer and parents[b[0]][1].startswith("h1."))
    parent = parents[ids[best]][0]
    inside = {parent}
    for path in range(parent + 1, len(parents)):        # a path's parent has a smaller number
        if parents[path][0] in inside:
            inside.add(path)

    def beside(path: int) -> bool:
        return path != parent and path in inside

    ok = [bool(chosen[i]) and article_of[p] == 0 or (beside(p) and unlinked[i] > 0.5) for i, p in enumerate(ids)]
    return "\n".join(b[2] for b in shown if ok[number[b[0]]])


def extract(pages: DataFrame, html_col: str = "html") -> tuple[DataFrame, str]:
    """``pages`` plus one string column with the main text."""
    name = fresh("text")

    def make():
        def work(texts: pa.Array) -> list:
            return [[main_text(t.as_py()) for t in texts]]
        return work

    return append(pages, [html_col], [(name, T.StringType())], make), name


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col(name).alias("text"), F.length(name).cast("long").alias("n_chars"))


QUERIES = {"op9_html_extraction": op9_html_extraction}
SQL: dict[str, str] = {}

"""Pages as block trees: a tolerant HTML reader and simple tree matching."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+")

# Elements by how they are read (fixed by the HTML standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg canvas audio video "
                "select xmp noembed noframes annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                   "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var "
                   "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror "
                   "mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts "
                   "mtable mtr mtd".split())
CLOSES = {  # an opening tag ends an open element of these names, up to the stop names
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
SCOPE = frozenset("html body table td th caption button object article section div main".split())

# What is not main text: by element, by ARIA role, by names in class and id.
HARD_TAGS = frozenset("nav aside footer menu dialog head".split())
SOFT_TAGS = frozenset("header form fieldset button".split())
HARD_ROLES = frozenset("navigation contentinfo complementary search alert dialog "
                       "alertdialog".split())
SOFT_ROLES = frozenset("banner form".split())
HARD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe signup login menu menubar nav navbar navigation topnav subnav breadcrumb "
    "breadcrumbs sidebar aside footer comment comments commentlist disqus respond reply replies "
    "share sharing social related recommended recommendations widget widgets toolbar pagination "
    "pager skip".split())
SOFT_NAMES = frozenset("header masthead banner form search topbar".split())
CONTENT_NAMES = frozenset("content article post entry story main maincontent articlebody".split())
# A name such as site-header-wrapper is called after the last of its words that says
# more than a place or a box; what a thing has or lacks is not its name.
PLACES = frozenset("left right top bottom primary secondary inner outer wrapper wrap container "
                   "area box section block bar list item items group row column".split())
STATES = frozenset("has with without no not is".split())
WHOLE_ONLY = frozenset("widget widgets".split())     # page builders wrap all text in widgets
MAX_DEPTH = 200       # elements nested deeper stay blocks, but are no nodes of their own
MAX_GRID = 40_000     # cells of one alignment held at once; longer child lists are halved

BODY, HINT, MAIN, ARTICLE = range(4)


@dataclass
class Page:
    """Blocks as (text, node, level, boilerplate); nodes in document order."""
    blocks: list[tuple[str, int, int, bool]] = field(default_factory=list)
    signs: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)


def _called(value: str) -> tuple[set[str], set[str]]:
    """(whole names, what the names of a class or id attribute are called after)."""
    whole, heads = set(), set()
    for name in value.split():
        words = _NAME.findall(name)
        if not words or words[0] in STATES:
            continue
        whole.add("".join(words))
        if len(words) == 1:
            continue
        while len(words) > 1 and words[-1] in PLACES:
            words.pop()
        if words[-1] not in WHOLE_ONLY:
            heads.add(words[-1])
    return whole, heads


def _kind(tag: str, attrs: str) -> tuple[str, int, int]:
    """(signature, boilerplate 0/1 soft/2 hard, content level) of an element."""
    sign, junk, level = tag, 0, BODY
    if tag in HARD_TAGS:
        junk = 2
    elif tag in SOFT_TAGS:
        junk = 1
    elif tag == "article":
        level = ARTICLE
    elif tag == "main":
        level = MAIN
    if attrs and not attrs.isspace():
        whole: set[str] = set()
        heads: set[str] = set()
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), (a or b or c).lower()
            if name in ("class", "id"):
                more, called = _called(value)
                whole |= more
                heads |= called
                if name == "class":
                    sign += "." + "-".join(_NAME.findall(value))
            elif name == "role":
                if value in HARD_ROLES:
                    junk = 2
                elif value in SOFT_ROLES:
                    junk = max(junk, 1)
                elif value in ("main", "article"):
                    level = max(level, MAIN)
            elif name == "hidden" or (
                    name == "style" and "display:none" in value.replace(" ", "")) or (
                    name == "aria-hidden" and value == "true"):
                junk = 2
        if tag not in ("html", "body"):
            # a marked article is boilerplate by a whole name only, such as "comment"
            names = whole if level >= MAIN else whole | heads
            if names & HARD_NAMES:
                junk = 2
            elif names & SOFT_NAMES:
                junk = max(junk, 1)
            if not junk and names & CONTENT_NAMES:
                level = max(level, HINT)
    return sign, junk, level


def read(source: str) -> Page:
    """The blocks and the block tree of a page."""
    page = Page([], ["html"], [-1])
    # open elements: tag, node, boilerplate, content level
    stack: list[tuple[str, int, int, int]] = [("html", 0, 0, BODY)]
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                _, node, junk, level = stack[-1]
                page.blocks.append((text, node, level, junk > 0))
            parts.clear()

    def pop_to(depth: int) -> None:
        flush()
        del stack[depth:]

    at, end = 0, len(source)
    while at < end:
        m = _TAG.search(source, at)
        if m is None:
            parts.append(html.unescape(source[at:]))
            break
        if m.start() > at:
            parts.append(html.unescape(source[at:m.start()]))
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        attrs = m[3] or m[6] or ""
        if m[1] or m[4]:  # an end tag
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if tag in INLINE:
                        flush_inline(parts, stack, depth)
                    else:
                        pop_to(depth)
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = close.start() if close else end
            if not attrs.endswith("/") or tag != "svg":
                continue
            at = m.end()
            continue
        if tag == "br" or tag == "wbr":
            if tag == "br":
                parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        sign, junk, level = _kind(tag, attrs)
        if tag in INLINE:
            if junk == 2:
                stack.append((tag, stack[-1][1], 2, stack[-1][3]))
                parts.append("\0")
            continue
        flush()
        if tag in CLOSES:
            names, stops = CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in names:
                    del stack[depth:]
                    if tag != "tr":
                        break
                elif stack[depth][0] in stops:
                    break
        else:
            for depth in range(len(stack) - 1, 0, -1):  # any block ends an open paragraph
                if stack[depth][0] == "p":
                    del stack[depth:]
                    break
                if stack[depth][0] in SCOPE:
                    break
        if tag in ("html", "body"):
            if tag == "body":
                del stack[1:]
            continue
        _, parent, above, in_level = stack[-1]
        if level >= MAIN and above < 2 and junk < 2:
            above = junk = 0       # an article inside a form or a banner is an article
        if in_level >= MAIN and junk == 1 and tag == "header":
            junk = 0               # an article's own header holds its title
        node = parent
        if len(stack) < MAX_DEPTH:
            node = len(page.signs)
            page.signs.append(sign)
            page.parents.append(parent)
        stack.append((tag, node, max(above, junk), max(in_level, level)))
    flush()
    return page


def flush_inline(parts: list[str], stack: list, depth: int) -> None:
    """End a marked inline element: what it gathered goes."""
    while parts and parts[-1] != "\0":
        parts.pop()
    if parts:
        parts.pop()
    del stack[depth:]


@dataclass(frozen=True)
class Tree:
    """A tree of signatures in document order."""
    signs: tuple[str, ...]
    kids: tuple[tuple[int, ...], ...]


def collapse(page: Page) -> tuple[str, list[int]]:
    """Skeleton of a page (equal neighbours in one) and each node's place in it."""
    n = len(page.signs)
    kids: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        kids[page.parents[i]].append(i)
    ids: dict[tuple, int] = {}
    shape = [0] * n
    runs: list[list[list[int]]] = [[] for _ in range(n)]
    for i in range(n - 1, -1, -1):
        for k in kids[i]:
            if runs[i] and shape[runs[i][-1][0]] == shape[k]:
                runs[i][-1].append(k)
            else:
                runs[i].append([k])
        key = (page.signs[i], tuple(shape[r[0]] for r in runs[i]))
        shape[i] = ids.setdefault(key, len(ids))
    place, lines = [0] * n, []
    todo: list[tuple[list[int], int]] = [([0], 0)]
    while todo:
        same, depth = todo.pop()
        for i in same:
            place[i] = len(lines)
        lines.append(f"{depth} {page.signs[same[0]]}")
        # nodes of one run have the same runs below: go down them side by side
        for k in range(len(runs[same[0]]) - 1, -1, -1):
            todo.append(([x for i in same for x in runs[i][k]], depth + 1))
    return "\n".join(lines), place


@lru_cache(maxsize=4096)
def tree(skeleton: str) -> Tree:
    signs: list[str] = []
    kids: list[list[int]] = []
    path: list[int] = []
    for line in skeleton.split("\n"):
        depth, _, sign = line.partition(" ")
        del path[int(depth):]
        if path:
            kids[path[-1]].append(len(signs))
        path.append(len(signs))
        signs.append(sign)
        kids.append([])
    return Tree(tuple(signs), tuple(map(tuple, kids)))


def _kinds(*trees: Tree) -> list[list[int]]:
    """A number per node of each tree; equal subtrees have equal numbers."""
    ids: dict[tuple, int] = {}
    out = []
    for t in trees:
        mine = [0] * len(t.signs)
        for i in range(len(mine) - 1, -1, -1):  # children stand behind their parent
            mine[i] = ids.setdefault((t.signs[i], *(mine[k] for k in t.kids[i])), len(ids))
        out.append(mine)
    return out


def _halved(x: list[int], y: list[int], weight) -> list[tuple[int, int]]:
    """Places (p, q) of a heaviest alignment of two lists of subtree numbers, in
    linear memory: the first list is halved, the second cut where both halves'
    weights add up to the most. Equal ends are paired at once."""
    first_x = {k: p for p, k in reversed(list(enumerate(x)))}
    first_y = {k: q for q, k in reversed(list(enumerate(y)))}
    table = np.array([[weight(p, q) for q in first_y.values()] for p in first_x.values()],
                     dtype=np.int64)
    row_of = {k: n for n, k in enumerate(first_x)}
    col_of = {k: n for n, k in enumerate(first_y)}
    rows, cols = [row_of[k] for k in x], np.array([col_of[k] for k in y])

    def best(some: list[int], among: np.ndarray) -> np.ndarray:
        """Weight of the list against each front part of the other."""
        line = np.zeros(len(among) + 1, dtype=np.int64)
        for r in some:
            line[1:] = np.maximum.accumulate(np.maximum(line[1:], line[:-1] + table[r][among]))
        return line

    out, todo = [], [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and x[a] == y[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        if b - a == 1:
            q = int(table[rows[a]][cols[c:d]].argmax())
            if table[rows[a]][cols[c + q]]:
                out.append((a, c + q))
            continue
        mid = (a + b) // 2
        cut = c + int((best(rows[a:mid], cols[c:d])
                       + best(rows[mid:b][::-1], cols[c:d][::-1])[::-1]).argmax())
        todo += [(a, mid, c, cut), (mid, b, cut, d)]
    return sorted(out)


@lru_cache(maxsize=4096)
def align(skeleton: str, reference: str) -> tuple[int, ...]:
    """Simple tree matching: the reference node of each skeleton node, or -1."""
    if skeleton == reference:
        return tuple(range(skeleton.count("\n") + 1))
    a, b = tree(skeleton), tree(reference)
    weights: dict[tuple[int, int], int] = {}
    choice: dict[tuple[int, int], list[tuple[int, int]]] = {}
    kinds: list[list[int]] = []

    def weight(i: int, j: int) -> int:
        if a.signs[i] != b.signs[j]:
            return 0
        if (i, j) in weights:
            return weights[i, j]
        x, y = a.kids[i], b.kids[j]
        pairs: list[tuple[int, int]] = []
        if len(x) * len(y) > MAX_GRID:
            if not kinds:
                kinds.extend(_kinds(a, b))
            pairs = _halved([kinds[0][u] for u in x], [kinds[1][v] for v in y],
                            lambda p, q: weight(x[p], y[q]))
            pairs = [(x[p], y[q]) for p, q in pairs]
            best = sum(weight(u, v) for u, v in pairs)
        else:
            grid = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
            for p, u in enumerate(x, 1):
                for q, v in enumerate(y, 1):
                    grid[p][q] = max(grid[p - 1][q], grid[p][q - 1],
                                     grid[p - 1][q - 1] + weight(u, v))
            p, q = len(x), len(y)
            best = grid[p][q]
            while p and q:
                if grid[p][q] == grid[p - 1][q]:
                    p -= 1
                elif grid[p][q] == grid[p][q - 1]:
                    q -= 1
                else:
                    pairs.append((x[p - 1], y[q - 1]))
                    p, q = p - 1, q - 1
        weights[i, j] = best + 1
        choice[i, j] = pairs
        return best + 1

    found = [-1] * len(a.signs)
    weight(0, 0)
    todo = [(0, 0)] if a.signs[0] == b.signs[0] else []
    while todo:
        i, j = todo.pop()
        found[i] = j
        todo += choice[i, j]
    return tuple(found)

"""Main text of HTML pages by minimum-cut labelling.

A page is cut into blocks at block-level tags.  A linear classifier on a block's surroundings (the innermost telling
element, tag, share of text in links, length, end mark) gives a score; positive ones become the capacity from the source
(content), negative ones the capacity to the sink (boilerplate).  Neighbouring blocks, and consecutive blocks of one parent, are joined by
edges that grow with the part of the path from the root they share.  The minimum cut is the labelling of least
total cost; the blocks on the source's side are the text.  A block whose own capacity exceeds all its edges keeps its label in
every minimum cut, so it is settled beforehand and its edges become its neighbours' terminal capacities; max-flow runs on the rest.

Elements that tell boilerplate cost their blocks ``W_BOILER`` times one less the share of the page they hold: of the words under a content
element further in, or where the page has none, of all words outside links; for ``WRAPPERS`` the larger of the two.  So a form or a div named
has-sidebar around the whole article costs little, and those with half the share or more leave what is said around and inside them as it is.
Names of html and body say nothing.

Tags are read forward once: a page of a megabyte of open tags, quotes or nested elements takes about a second.

Inside a block white space becomes one space, character references are decoded; kept blocks are joined by a line end.  Nothing else is
dropped.

Defined results: null or empty html, or no kept block, gives an empty text; repeated pages are read one by one; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch

#: elements without an end tag, and those whose content is no text (fixed values)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg canvas video audio title textarea".split())
#: elements that end a block of text
BLOCK = frozenset("""
address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td
tfoot th thead tr ul
""".split())
#: a new one of these ends an open one of the same group
IMPLIED = {"p": BLOCK - {"body", "html", "head"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
#: elements, and words of class, id or role, that tell boilerplate or content
BOILER_TAGS = frozenset("nav aside footer form button select option menu dialog fieldset label".split())
CONTENT_TAGS = frozenset("article main".split())
#: boilerplate elements that may be put around a whole page
WRAPPERS = frozenset("form fieldset dialog label".split())
BOILER_WORDS = frozenset("""
ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies
disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted recommended related
reply replies respond search share sharing sidebar skip social sponsor sponsored subscribe subscription toc toolbar widget
""".split())
CONTENT_WORDS = frozenset("article articlebody content entry main maincontent post postbody story storybody".split())

#: the classifier: weights of the features of a block
W_BOILER, W_CONTENT, W_LINKS, W_TEXT_TAG, W_ITEM, W_LENGTH, W_END, W_BIAS = -8.0, 4.0, -4.0, 1.0, -0.3, 1.5, 0.6, -0.8
#: edges: adjacent blocks, and consecutive ones of one parent
E_NEXT, E_PARENT = 0.8, 0.5

#: what begins a token, and a tag up to its end: quotes hide a ">", and nothing is tried twice
_BEGIN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$))*+)>", re.S)
_BLIND = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_END = re.compile(r"[.!?:;\"')\]…»”]$")


def _telling(tag: str, attributes: str, inside: int) -> int:
    """-1 boilerplate, 1 content, 0 as around; ``inside`` is what the innermost telling element around says."""
    if tag in BOILER_TAGS or tag == "header" and inside <= 0:
        return -1
    if attributes and tag not in ("html", "body"):
        words = {w.lower() for m in _NAMES.finditer(attributes) for w in _WORD.findall(m[1] or m[2] or m[3] or "")}
        if words & BOILER_WORDS and not (words & CONTENT_WORDS and not words & {"comment", "comments", "sidebar", "related", "footer", "nav", "menu"}):
            return -1
        if words & CONTENT_WORDS:
            return 1
    return 1 if tag in CONTENT_TAGS else 0


class Blocks:
    """The blocks of a page: text, score, innermost block element around.  Reading takes time in proportion to the page."""

    def __init__(self, page: str):
        self.texts: list[str] = []
        self.scores: list[float] = []
        self.nodes: list[int] = []
        # block elements, the page itself first: the one around, depth, tag
        self.parent, self.depth, self._tags = [0], [0], [""]
        self._stack: list[tuple[str, int, int]] = []  # tag, innermost block element, innermost telling element
        self._open: dict[str, int] = {}  # how many elements of each tag are open
        # telling elements, the page itself first: what they say, the one around, is it a wrapper; and of each block its own and its words
        self._says, self._around, self._wraps = [0], [0], [False]
        self._of: list[int] = []
        self._words: list[float] = []
        self._parts: list[str] = []
        self._linked = 0
        self._tag = ""
        self._read(page)
        self._judge()

    def _pop(self) -> str:
        tag = self._stack.pop()[0]
        self._open[tag] -= 1
        return tag

    def _read(self, page: str) -> None:
        at, end, form = 0, len(page), _TAG
        without: set[str] = set()  # elements of which no end tag follows
        while at < end:
            begin = _BEGIN.search(page, at)
            if begin is None:
                break
            self._text(page[at : begin.start()])
            at, kind = begin.start(), begin[0]
            if kind == "<!--" or kind == "<![CDATA[":
                mark = "-->" if kind == "<!--" else "]]>"
                close = page.find(mark, begin.end())
                close = end if close < 0 else close
                if mark == "]]>":
                    self._text(page[begin.end() : close])
                at = close + 3
                continue
            if kind in ("<!", "<?"):
                close = page.find(">", at)
                if close < 0:
                    break
                at = close + 1
                continue
            m = form.match(page, at)
            if m is None and form is _TAG:  # a quote is left open: from here on quotes hide nothing
                form = _BLIND
                m = form.match(page, at)
            if m is None:
                break
            at = m.end()
            tag = m[2].lower()
            if m[1]:
                if self._open.get(tag):
                    if tag in BLOCK:
                        self._flush()
                    while self._pop() != tag:
                        pass
                elif tag in BLOCK:
                    self._flush()
                continue
            closed = m[3].endswith("/")
            if tag == "br":
                self._parts.append(" ")
            if tag in RAW:
                close = None if closed or tag in without else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if close:
                    at = close.end()
                elif not closed:
                    without.add(tag)
                    at = at if tag in ("svg", "object") else end
                continue
            if tag in BLOCK:
                self._flush()
                while self._stack and tag in IMPLIED.get(self._stack[-1][0], ()):
                    self._pop()
                if self._stack and tag not in ("p", "li") and any(t == "p" for t, _, _ in self._stack[-3:]) and tag in IMPLIED["p"]:
                    while self._pop() != "p":
                        pass
                self._tag = tag
            if tag in VOID or closed:
                continue
            _, node, inside = self._stack[-1] if self._stack else ("", 0, 0)
            if tag in BLOCK:
                self.parent.append(node)
                self.depth.append(self.depth[node] + 1)
                self._tags.append(tag)
                node = len(self.parent) - 1
            says = _telling(tag, m[3], self._says[inside])
            if says:
                self._says.append(says)
                self._around.append(inside)
                self._wraps.append(tag in WRAPPERS)
                inside = len(self._says) - 1
            self._stack.append((tag, node, inside))
            self._open[tag] = self._open.get(tag, 0) + 1
        self._text(page[at:])
        self._flush()

    def _text(self, text: str) -> None:
        if text:
            self._parts.append(text)
            if self._open.get("a"):
                self._linked += len(text)

    def _flush(self) -> None:
        raw = "".join(self._parts)
        text = " ".join(html.unescape(raw).split())
        linked, self._parts, self._linked = self._linked, [], 0
        if not text:
            return
        _, node, telling = self._stack[-1] if self._stack else ("", 0, 0)
        tag = self._tags[node] if node else self._tag
        words, links = text.count(" ") + 1, min(1.0, linked / max(1, len(raw)))
        score = W_BIAS + W_LINKS * links + W_LENGTH * min(words, 40) / 40 + (W_END if _END.search(text) else 0)
        score += W_TEXT_TAG if tag in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6") else W_ITEM if tag in ("li", "td", "th", "dt", "dd", "option") else 0
        self.texts.append(text)
        self.scores.append(score)
        self.nodes.append(node)
        self._of.append(telling)
        self._words.append(words * (1 - links))

    def _judge(self) -> None:
        """Add what the telling elements around each block cost or earn."""
        n = len(self._says)
        plain, content = [0.0] * n, [0.0] * n
        for e, words in zip(self._of, self._words):
            plain[e] += words
            content[e] += words if self._says[e] > 0 else 0
        for e in range(n - 1, 0, -1):  # elements around come before those inside
            plain[self._around[e]] += plain[e]
            content[self._around[e]] += content[e]
        # the least share of the boilerplate elements around, and what the innermost that counts says
        least, says = [1.0] * n, [0] * n
        for e in range(1, n):
            around = self._around[e]
            least[e], says[e] = least[around], says[around]
            if self._says[e] < 0:
                of_plain, of_content = (x[e] / x[0] if x[0] else 0.0 for x in (plain, content))
                share = max(of_plain, of_content) if self._wraps[e] else of_content if content[0] else of_plain
                least[e] = min(least[e], share)
                if share < 0.5:
                    says[e] = -1
            elif says[around] >= 0:
                says[e] = 1
        for i, e in enumerate(self._of):
            self.scores[i] += W_BOILER * (1 - least[e]) + (W_CONTENT if says[e] > 0 else 0)


def edges(nodes: list[int], parent: list[int], depth: list[int]) -> dict[tuple[int, int], float]:
    """Smoothness edges (i < j) of blocks in page order, given the block element of each and the tree of these."""

    def near(a: int, b: int) -> float:
        both = depth[a] + depth[b]
        while a != b:  # as many steps as elements began or ended between the two
            if depth[a] >= depth[b]:
                a = parent[a]
            else:
                b = parent[b]
        return 2 * depth[a] / max(1, both)

    out: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for j, node in enumerate(nodes):
        if j:
            out[j - 1, j] = E_NEXT * near(nodes[j - 1], node)
        i = last.get(parent[node])
        if i is not None:
            out[i, j] = out.get((i, j), 0.0) + E_PARENT * near(nodes[i], node)
        last[parent[node]] = j
    return {k: w for k, w in out.items() if w > 0}


def min_cut(scores: list[float], weights: dict[tuple[int, int], float]) -> list[bool]:
    """Is each node on the source's side of a minimum cut?  Ties go to the sink."""
    n = len(scores)
    score, near = list(scores), [dict() for _ in range(n)]
    for (i, j), w in weights.items():
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    # settle what its terminal alone decides
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(score[i]) > sum(near[i].values()):
            label[i] = score[i] > 0
            for j, w in near[i].items():
                score[j] += w if label[i] else -w
                del near[j][i]
                todo.append(j)
            near[i].clear()
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        side = _max_flow(rest, score, near)
        for i in rest:
            label[i] = i in side
    return [bool(x) for x in label]


def _max_flow(nodes: list[int], score: list[float], near: list[dict[int, float]]) -> set[int]:
    """The source's side after augmenting along shortest paths until none is left (level graphs, depth-first, no recursion)."""
    source, sink, tiny = -1, -2, 1e-12
    room: dict[int, dict[int, float]] = {source: {}, sink: {}}
    for i in nodes:
        room[i] = dict(near[i])
    for i in nodes:
        if score[i] > 0:
            room[source][i], room[i][source] = score[i], 0.0
        elif score[i] < 0:
            room[i][sink], room[sink][i] = -score[i], 0.0
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, c in room[u].items():
                if c > tiny and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return set(level)
        ways = {u: list(room[u]) for u in level}
        at = dict.fromkeys(level, 0)  # the edge in use; those before it lead nowhere any more
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= flow
                    room[b][a] += flow
                cut = next(k for k, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= tiny)
                del path[cut + 1 :]
                continue
            while at[u] < len(ways[u]):
                v = ways[u][at[u]]
                if level.get(v, -1) == level[u] + 1 and room[u][v] > tiny:
                    path.append(v)
                    break
                at[u] += 1
            else:
                path.pop()
                level[u] = -1


def main_text(page: str | None) -> str:
    blocks = Blocks(page or "")
    kept = min_cut(blocks.scores, edges(blocks.nodes, blocks.parent, blocks.depth))
    return "\n".join(t for t, k in zip(blocks.texts, kept) if k)


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): the main text and its length in code points."""

    def make():
        def fn(c):
            texts = [main_text(h) for h in c["html"]]
            return {"page_id": c["page_id"], "url": c["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return fn

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(by_batch(make, _OUT, 256), "page_id long, url string, text string, n_chars long")

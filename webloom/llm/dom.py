"""A tolerant HTML reader for extraction: block-level nodes with their features.

Nodes are the page, its block-level elements and the runs of text between block
borders.  Inline elements are transparent: their text belongs to the run around
them.  Raw text (scripts, styles, titles, ...) is skipped; character references
are decoded.  One pass, no recursion, no back-tracking over the page.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np

INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp
small span strike strong sub sup time tt u var wbr br picture source""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math object select xmp noframes canvas audio video".split())
#: Those whose start tag may close itself; on the others the slash means nothing.
CLOSES_ITSELF = frozenset("svg math object canvas audio video".split())
#: Opening one of these ends an open paragraph.
ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul""".split())
#: Opening the key ends an open element of the values, up to the nearest of its scope.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "body": ("head",)}
SCOPE = frozenset("ul ol menu dl table tbody thead tfoot body html div article section".split())

#: Words of tags, classes, ids and roles, by what they hint at (fixed lists).
HINTS = {
    "main": "article main content post entry story body text page maincontent articlebody mainentity prose richtext copy",
    "nav": "nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager toc tabs sitemap links skip",
    "head": "header head masthead topbar top logo brand banner",
    "foot": "footer foot bottom copyright legal colophon",
    "side": "aside sidebar side rail widget widgets complementary related recommended recommendations more trending popular tags tagcloud",
    "ad": "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion commercial taboola outbrain dfp",
    "notice": "notice notices cookie cookies consent gdpr alert alerts warning popup modal overlay dialog toast message paywall disclaimer",
    "comment": "comment comments commentlist disqus reply replies respond discussion thread reviews feedback",
    "form": "form search login signup signin subscribe subscription newsletter register input button fieldset contact select",
    "social": "share sharing social follow twitter facebook byline author meta metadata date timestamp",
}
HINT_OF = {w: i for i, ws in enumerate(HINTS.values()) for w in ws.split()}
KINDS = ("#text", "p", "h1 h2 h3 h4 h5 h6", "li dt dd", "ul ol dl menu", "div section center", "article main", "td th", "table tbody thead tfoot tr",
         "blockquote pre figure figcaption", "nav header footer aside", "form fieldset button input", "html body #page")
KIND_OF = {t: i for i, ts in enumerate(KINDS) for t in ts.split()}

_TAG = re.compile(r"<(?:!--(.*?)(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([!?/][^>]*+)(?:>|\Z))", re.S)
_LOOSE = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""(?:^|[\s"'/])(?:class|id|role|itemprop|aria-label)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_HIDDEN = re.compile(r"""(?:^|[\s"'])(?:hidden(?=[\s/=]|$)|aria-hidden\s*+=\s*+["']?true)|display\s*+:\s*+none""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_END_MARK = re.compile(r"[.!?…。]")


class Page:
    """Nodes in page order; ``parent`` is always smaller than the node."""

    def __init__(self, html: str):
        self.tag, self.parent, self.depth = ["#page"], [-1], [0]
        self.hints, self.hidden = [0], [False]
        self.text: dict[int, str] = {}
        self.links: dict[int, int] = {}
        self._read(html)

    def _node(self, tag: str, parent: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.hints.append(0)
        self.hidden.append(False)
        return len(self.tag) - 1

    def _read(self, html: str) -> None:
        open_: list[tuple[str, int]] = [("#page", 0)]  # tags and the block node they are in
        counts = {"#page": 1}
        run: list[str] = []
        link_chars = a_depth = 0
        at, n = 0, len(html)

        def flush():
            nonlocal run, link_chars
            if run:
                text = " ".join("".join(run).split())
                if text:
                    i = self._node("#text", open_[-1][1])
                    self.text[i], self.links[i] = text, min(link_chars, len(text))
                run = []
            link_chars = 0

        def add(piece: str):
            nonlocal link_chars
            if piece:
                piece = unescape(piece) if "&" in piece else piece
                run.append(piece)
                if a_depth:
                    link_chars += len(piece.strip())

        def close(tag: str):
            nonlocal a_depth
            if not counts.get(tag):
                return
            while True:
                t, _ = open_[-1]
                if t not in INLINE:
                    flush()
                open_.pop()
                counts[t] -= 1
                if t == "a":
                    a_depth -= 1
                if t == tag:
                    return

        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                add(html[at:])
                break
            m = _TAG.match(html, lt)
            if m is None:
                m = _LOOSE.match(html, lt + 1)  # an unclosed quote or tag: up to the next >
                if m is None:
                    add(html[at:lt + 1])  # a bare <
                    at = lt + 1
                    continue
                end, tag, attrs = m[1], m[2].lower(), m[3]
            else:
                end, tag, attrs = m[2], (m[3] or "").lower(), m[4]
            add(html[at:lt])
            at = m.end()
            if not tag:
                continue  # a comment or declaration
            if end:
                if tag == "p" and not counts.get("p"):
                    flush()
                elif tag != "br":
                    close(tag)
                continue
            if tag in RAW:
                if tag not in CLOSES_ITSELF or not attrs.endswith("/"):
                    at = self._skip(html, tag, at)
                if tag not in ("title", "script", "style", "noscript", "template"):
                    run.append(" ")
                continue
            if tag == "br":
                run.append("\n")
                continue
            if tag in INLINE:
                if tag not in VOID and not (tag == "a" and a_depth and close("a")):
                    open_.append((tag, open_[-1][1]))
                    counts[tag] = counts.get(tag, 0) + 1
                    a_depth += tag == "a"
                continue
            flush()
            if tag in ENDS_P and counts.get("p"):
                close("p")
            for other in ENDS.get(tag, ()):
                for t, _ in reversed(open_):
                    if t == other:
                        close(other)
                        break
                    if t in SCOPE and not (t == "tbody" and other == "tr"):
                        break
            i = self._node(tag, open_[-1][1])
            hints = 1 << HINT_OF[tag] if tag in HINT_OF else 0
            if attrs:
                for x in _ATTR.finditer(attrs):
                    for w in _TOKEN.findall(x[1] or x[2] or x[3] or ""):
                        k = HINT_OF.get(w.lower())
                        if k is not None:
                            hints |= 1 << k
                self.hidden[i] = bool(_HIDDEN.search(attrs))
            self.hints[i] = hints
            if tag not in VOID:
                open_.append((tag, i))
                counts[tag] = counts.get(tag, 0) + 1
        flush()

    @staticmethod
    def _skip(html: str, tag: str, at: int) -> int:
        m = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*+>?", re.I).search(html, at)
        return m.end() if m else len(html)


def features(page: Page) -> np.ndarray:
    """A row of numbers per node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own = np.zeros((n, 6))  # characters, link characters, words, sentence ends, commas, texts
    for i, t in page.text.items():
        own[i] = len(t), page.links[i], t.count(" ") + 1, len(_END_MARK.findall(t)), t.count(","), 1
    total = own.copy()
    nodes = np.ones(n)
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        total[p] += total[i]
        nodes[p] += nodes[i]
    chars = total[:, 0]
    hints = np.array(page.hints, dtype=np.int64)
    above = np.zeros(n, dtype=np.int64)
    near = np.zeros(n, dtype=np.int64)
    rank, seen = np.zeros(n), np.zeros(n)
    for i in range(1, n):
        p = page.parent[i]
        above[i] = above[p] | hints[p]
        near[i] = hints[i] or near[p]
        rank[i] = seen[p]
        seen[p] += 1
    children = np.maximum(seen, 1)
    kind = np.array([KIND_OF.get(t, len(KINDS)) for t in page.tag])
    up = np.maximum(parent, 0)
    grand = up[up]
    before = np.cumsum(own[:, 0]) - own[:, 0]
    log = np.log1p
    share = lambda a, b: a / np.maximum(b, 1)
    longest_p = np.zeros(n)
    para = kind == KIND_OF["p"]
    np.add.at(longest_p, up[para], chars[para])  # characters in child paragraphs
    hidden = np.array(page.hidden)
    for i in range(1, n):
        hidden[i] |= hidden[page.parent[i]]
    cols = [log(chars), share(total[:, 1], chars), share(chars, nodes), share(chars, total[:, 2]), log(total[:, 3]),
            share(total[:, 3], total[:, 2]), share(total[:, 4], total[:, 2]), share(chars, chars[0]), np.array(page.depth), rank, share(rank, children[up]),
            children[up], share(chars, chars[up]), share(chars[up], chars[0]), share(total[up, 1], chars[up]), log(chars[up]), log(chars[grand]),
            log(longest_p), log(longest_p[up]), share(longest_p[up], chars[up]), share(before, chars[0]), log(nodes), log(total[:, 5]),
            kind, kind[up], kind[grand], hidden]
    for bits in (hints, hints[up], near, above):
        cols += [(bits >> k & 1) for k in range(len(HINTS))]
    return np.column_stack(cols).astype(np.float32)


def decode(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """The likeliest labels without contradictions, by dynamic programming.

    A node is labelled if main text is in it; so a labelled node's parent is
    labelled, and a labelled element has a labelled child."""
    n = len(page.tag)
    gain = log_odds.tolist()  # of the best labelling below a labelled node, over leaving all unlabelled
    some, best_child = [False] * n, [-np.inf] * n
    for i in range(n - 1, -1, -1):
        if i not in page.text and not some[i]:
            gain[i] = gain[i] + best_child[i]  # at least one child; -inf without children
        p = page.parent[i]
        if p >= 0:
            if gain[i] > 0:
                gain[p] += gain[i]
                some[p] = True
            best_child[p] = max(best_child[p], gain[i])
    label = np.zeros(n, dtype=bool)
    label[0] = gain[0] > 0
    taken = [False] * n  # the one child of a node that has no child worth it
    for i in range(1, n):
        p = page.parent[i]
        if label[p]:
            label[i] = gain[i] > 0 if some[p] else (not taken[p] and gain[i] == best_child[p])
            taken[p] |= bool(label[i])
    return label


def main_text(page: Page, label: np.ndarray) -> str:
    return " ".join(t for i, t in page.text.items() if label[i])

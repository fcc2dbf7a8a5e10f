"""HTML Column expressions: text extraction, tag bodies, links, URL resolution.

All of these are JVM built-ins (regex + higher-order array functions).  The
text extractor follows a DOM parser's view of text nodes: script and style
bodies are raw text (a '</p>' inside a script string is not a tag), comments
are not text, every other tag separates text nodes; each text node is trimmed,
kept when non-empty, and written on its own line.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from webloom.functions.text import re2

# --- fixed values ------------------------------------------------------------
# Link patterns of the reference, tried in this order on each tag body.
A_HREF = r"""[aA].+?[hH][rR][eE][fF]=['"](.+?)['"].*?"""
AREA_HREF = r"""[aA][rR][eE][aA].+?[hH][rR][eE][fF]=['"](.*?)['"].*?"""
FRAME_SRC = r"""[fF][rR][aA][mM][eE].+?[sS][rR][cC]=['"](.*?)['"].*?"""
IFRAME_SRC = r"""[iI][fF][rR][aA][mM][eE].+?[sS][rR][cC]=['"](.*?)['"].*?"""
LINK_PATTERNS = (A_HREF, AREA_HREF, FRAME_SRC, IFRAME_SRC)
# -----------------------------------------------------------------------------

# Line terminators a Java '.' does not cross.
_EOL = r"\n\r\x{85}\x{2028}\x{2029}"
# A tag body on one line: '<(.*?)>'.
TAG_PATTERN = "<([^>" + _EOL + "]*)>"
HTTP_PATTERN = r"^[hH][tT][tT][pP][sS]?://[^" + _EOL + r"]*\z"

# --- fixed values of the HTML tokenizer --------------------------------------
# Elements whose content holds no tags; in the latter references are decoded.
RAW_ELEMENTS = ("script", "style", "xmp", "iframe", "noembed", "noframes")
TEXT_ELEMENTS = ("title", "textarea")
# -----------------------------------------------------------------------------

# The tokenizer's states as one pattern (space: the characters that separate attributes).
# Every choice is settled by the next characters, so that possessive quantifiers change nothing.
_S = r"\t\n\f\r "
_VALUE = rf"""(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^{_S}>"'][^{_S}>]*+)"""
_ATTRIBUTES = rf"(?:[{_S}/]++|[^{_S}/>][^{_S}/>=]*+(?:[{_S}]*+=[{_S}]*+{_VALUE}?+)?+)*+(?:>|\z)"


def _element(name: str) -> str:
    """The element from its open tag to its end tag, or to the end of the page."""
    return rf"<(?i:{name})(?:[{_S}/]{_ATTRIBUTES}|>)(?s:.*?)(?:</(?i:{name})(?:[{_S}/]{_ATTRIBUTES}|>)|\z)"


def _pieces(ahead: str = "") -> str:
    return "|".join([
        r"[^<]++",
        ahead + "(?:" + "|".join(map(_element, RAW_ELEMENTS + TEXT_ELEMENTS)) + ")",
        rf"</?[a-zA-Z][^{_S}/>]*+{_ATTRIBUTES}",                # tag
        r"<!--(?:-?>|(?s:.*?)(?:--!?>|\z))",                   # comment
        r"<[!?][^>]*+(?:>|\z)", r"</(?:>|[^a-zA-Z>][^>]*+(?:>|\z))",  # declaration, bogus comment
        "<"])


# The look-ahead (Java only) passes over other tags at once; it changes no match.
PIECE_PATTERN_JAVA = _pieces(f"(?=<(?i:{'|'.join(sorted({e[:2] for e in RAW_ELEMENTS + TEXT_ELEMENTS}))}))")
PIECE_PATTERN = re2(_pieces())


def _opening(names) -> str:
    return rf"^<(?i:{'|'.join(names)})[{_S}/>]"


# Pieces that are elements with raw text or with text, all of them or all but scripts and styles; their content.
RAW_OPEN, TEXT_OPEN = _opening(RAW_ELEMENTS), _opening(TEXT_ELEMENTS)
ELEMENT_OPEN, KEPT_OPEN = _opening(RAW_ELEMENTS + TEXT_ELEMENTS), _opening(RAW_ELEMENTS[2:] + TEXT_ELEMENTS)
RAW_BODY_JAVA = (rf"^<[a-zA-Z]++(?:[{_S}/]{_ATTRIBUTES}|>)((?s:.*?))"
                 rf"(?:</(?i:{'|'.join(RAW_ELEMENTS + TEXT_ELEMENTS)})(?:[{_S}/]{_ATTRIBUTES}|>))?\z")
RAW_BODY = re2(RAW_BODY_JAVA)
# Characters Java's String.trim removes (every char <= U+0020).
TRIM_PATTERN = r"^[\x00-\x20]+|[\x00-\x20]+$"

# URL parts (generic syntax).
SCHEME_RE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
AUTHORITY_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)"
PATH_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"
QUERY_RE = r"^[^?#]*(\?[^#]*)"
# Characters that make a link unparseable as a URI (then it is kept as is).
ILLEGAL_URI = r"[\x00-\x20\"<>\\^`{|}]|%(?:[^0-9a-fA-F]|.[^0-9a-fA-F]|.?\z)|#.*#"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(s) -> Column:
    return F.regexp_replace(_c(s), TRIM_PATTERN, "")


# A text cut into character references, with or without their semicolon, and what lies between.
REFERENCE_PATTERN = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)|[^&]+|&"
#: Names that need no semicolon, as one pattern in which the longest comes first.
BARE_NAMES = "^&(?:" + "|".join(sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))) + ")"
#: Numbers 128 to 159 stand for the characters of windows-1252.
C1_CHARACTERS = {str(n): bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}


def _table(pairs: dict) -> Column:
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _numeric_reference(ref) -> Column:
    """The character of '&#N;' or '&#xH;' (any number of leading zeros);
    references to no valid code point stay as written."""
    hexed = ref.rlike("^&#[xX]")
    digits = F.regexp_extract(ref, r"^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
    short = F.when(F.length(digits) <= 7, digits).otherwise(F.lit("0"))
    cp = F.when(hexed, F.conv(short, 16, 10)).otherwise(F.when(short == "", "0").otherwise(short)).cast("bigint")
    valid = (cp >= 1) & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, cp).otherwise(63)), 8, "0")), "UTF-32")
    return (F.when(cp.between(128, 159), F.coalesce(_table(C1_CHARACTERS)[cp.cast("string")], plain))
            .when(valid, plain).otherwise(ref))


def unescape(s) -> Column:
    """Decodes every character reference once ('&amp;lt;' becomes '&lt;').  Of a name
    without semicolon, or an unknown one, the longest known beginning counts."""
    s = _c(s)
    names = _table({f"&{k}": v for k, v in html5.items() if k.endswith(";")})
    bare_names = _table({f"&{k}": v for k, v in html5.items() if not k.endswith(";")})

    def bare(p):
        name = F.regexp_extract(p, BARE_NAMES, 0)
        return F.when(name == "", p).otherwise(F.concat(bare_names[name], p.substr(F.length(name) + 1, F.length(p))))

    def piece(p):
        return (F.when(~p.startswith("&") | (p == "&"), p).when(p.startswith("&#"), _numeric_reference(p))
                .otherwise(F.coalesce(names[p], bare(p))))

    decoded = F.array_join(F.transform(F.regexp_extract_all(s, F.lit(REFERENCE_PATTERN), 0), piece), "")
    return F.when(F.contains(s, F.lit("&")), decoded).otherwise(s)


def html_text_nodes(html, keep_script: bool = True) -> Column:
    """array<string>: trimmed, non-empty text nodes in document order.  ``keep_script``
    keeps the content of scripts and styles."""
    pieces = F.regexp_extract_all(_c(html), F.lit(PIECE_PATTERN_JAVA), 0)

    def node(p):
        """A piece's text, if it has one, and whether references are decoded in it."""
        tag = p.startswith("<") & (F.length(p) > 1)
        dropped = tag & ~p.rlike(ELEMENT_OPEN if keep_script else KEPT_OPEN)
        text = F.when(~tag, p).when(~dropped, F.regexp_extract(p, RAW_BODY_JAVA, 1))
        return F.struct(text.alias("text"), (~tag | p.rlike(TEXT_OPEN)).alias("decoded"))

    texts = F.transform(F.filter(F.transform(pieces, node), lambda n: n["text"].isNotNull()),
                        lambda n: java_trim(F.when(n["decoded"], unescape(n["text"])).otherwise(n["text"])))
    return F.filter(texts, lambda t: t.isNotNull() & (F.length(t) > 0)
                    & ~(t.startswith("<!--") & t.endswith("-->"))
                    & ~(t.startswith("/*") & t.endswith("*/")))


def html_to_text(html, keep_script: bool = True) -> Column:
    """Text of a page: one text node per line, each line ending in '\\n'."""
    # The empty node at the end gives the last line its end, and no line none; the nodes are named,
    # and so evaluated, once.
    return F.array_join(F.concat(html_text_nodes(html, keep_script), F.array(F.lit(""))), "\n")


def html_tags(html) -> Column:
    """array<string> of tag bodies '<(.*?)>' found line by line."""
    return F.regexp_extract_all(_c(html), F.lit(TAG_PATTERN), 1)


def url_parts(base) -> dict:
    """Scheme, authority, path and query ('?...') of a URL, as Columns."""
    b = _c(base)
    return {"sch": F.regexp_extract(b, SCHEME_RE, 1), "auth": F.regexp_extract(b, AUTHORITY_RE, 1),
            "path": F.regexp_extract(b, PATH_RE, 1), "qry": F.regexp_extract(b, QUERY_RE, 1)}


def cut_query(link) -> Column:
    """Drop the query when '?' sits past the first character."""
    raw = _c(link)
    q = F.instr(raw, "?")
    return F.when(q > 1, raw.substr(F.lit(1), q - 1)).otherwise(raw)


def remove_dot_segments(path) -> Column:
    """An absolute path without '.' and '..' segments; '..' at the root stays there."""
    path = _c(path)

    def step(done, seg):
        return (F.when(seg == ".", done).when(seg == "..", F.regexp_replace(done, r"/[^/]*$", ""))
                .otherwise(F.concat(done, F.lit("/"), seg)))

    segments = F.split(F.regexp_replace(path, r"^/", ""), "/")
    folded = F.aggregate(segments, F.lit(""), step)
    return F.when(path.rlike(r"/\.{1,2}$"), F.concat(folded, F.lit("/"))).otherwise(folded)


def resolve_parts(lk, sch, auth, path, qry) -> Column:
    """Resolve a query-cut link against a base given by its parts.  Absolute,
    network-path, root-relative, fragment, query and relative-path links;
    '.' and '..' segments of the path removed.  An unparseable link comes back as is."""
    lk, sch, auth, path, qry = (_c(x) for x in (lk, sch, auth, path, qry))
    origin = F.concat(sch, F.lit("://"), auth)
    base_dir = F.regexp_replace(path, r"[^/]*$", "")
    start = F.instr(lk, "#")
    rel = F.when(start > 0, lk.substr(F.lit(1), start - 1)).otherwise(lk)
    rest = F.when(start > 0, lk.substr(start, F.length(lk))).otherwise(F.lit(""))
    merged = F.concat(origin, remove_dot_segments(F.concat(F.when(base_dir == "", F.lit("/")).otherwise(base_dir), rel)), rest)
    return (F.when(lk.rlike(ILLEGAL_URI), lk)
            .when(lk.rlike(SCHEME_RE), lk)
            .when(lk.startswith("//"), F.concat(sch, F.lit(":"), lk))
            .when(lk.startswith("/"), F.concat(origin, lk))
            .when(lk.startswith("#"), F.concat(origin, path, qry, lk))
            .when(lk.startswith("?"), F.concat(origin, path, lk))
            .when(lk == "", F.concat(origin, base_dir))
            .otherwise(merged))


def resolve_url(base, link) -> Column:
    """Resolve ``link`` against the page URL ``base`` (single-expression form)."""
    p = url_parts(base)
    return resolve_parts(cut_query(link), p["sch"], p["auth"], p["path"], p["qry"])


def is_http_link(url, page_url) -> Column:
    """An absolute http(s) URL that is not the page itself."""
    return _c(url).rlike(HTTP_PATTERN) & (_c(url) != _c(page_url))

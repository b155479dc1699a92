"""HTML tokens and text for the page operators: tags, text with character references decoded, blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

#: Values fixed by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body html button legend option optgroup td th tr tbody thead tfoot dd dt li summary figcaption".split())
SAME = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "optgroup": "option optgroup", "thead": "tbody thead tfoot tr td th", "tbody": "tbody thead tfoot tr td th", "tfoot": "tbody thead tfoot tr td th"}
SCOPE = {"li": "ul ol menu dir", "dt": "dl", "dd": "dl", "tr": "table", "td": "table", "th": "table", "thead": "table", "tbody": "table", "tfoot": "table", "option": "select", "optgroup": "select"}

#: Attributes as the standard reads them: a quoted value runs to its closing quote, whatever it holds; a quote that nothing closes is a letter of a name.
_ATTRIBUTES = r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]++)?+)?+)*+"
_TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z)|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)", re.S)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>]){_ATTRIBUTES}(?:>|\Z)", re.I) for name in RAW}
_SPACE = re.compile(r"\s+")


def tokens(source: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, data): ("text", "", raw text), ("open", name, attributes), ("close", name, "").

    Raw-text elements (scripts, styles, titles, ...) give their open and close tags and
    no text; comments and declarations are left out.
    """
    at, n = 0, len(source)
    while at < n:
        m = _TOKEN.search(source, at)
        if m is None:
            yield "text", "", source[at:]
            return
        if m.start() > at:
            yield "text", "", source[at : m.start()]
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            yield "close", name, ""
            continue
        yield "open", name, m[3]
        if name in RAW:
            end = _ENDS[name].search(source, at)
            at = end.end() if end else n
            yield "close", name, ""


_PAIR = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|((?![\"'])[^\s>]++))?+)?+")


def attributes(data: str) -> list[tuple[str, str]]:
    """(name in lower case, raw value) of the attributes of a tag, in order."""
    return [(k.lower(), a or b or c) for k, a, b, c in _PAIR.findall(data)]


def squeeze(text: str) -> str:
    """Character references decoded, white space turned into single spaces, trimmed."""
    return _SPACE.sub(" ", html.unescape(text) if "&" in text else text).strip()


def plain_text(source: str, see: Callable[[str, str], None] | None = None) -> str:
    """All text of a page, a line per block; `see` is told the name and attributes of every opening tag on the way."""
    lines, parts = [], []
    for kind, name, data in tokens(source):
        if kind == "text":
            parts.append(data)
            continue
        if see and kind == "open":
            see(name, data)
        if name in BLOCKS:
            if line := squeeze("".join(parts)):
                lines.append(line)
            parts = []
        elif name == "br":
            parts.append(" ")
    if line := squeeze("".join(parts)):
        lines.append(line)
    return "\n".join(lines)

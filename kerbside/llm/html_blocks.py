"""Leaf blocks of a web page: text between block-level tags, with the elements it stands in."""

import html
import re
from dataclasses import dataclass

#: Fixed values of HTML: elements without content, with raw content, and those that end a running block of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template svg textarea iframe object canvas noembed noframes xmp".split())
#: Those of them that do not hold the rest of a page if their end tag is missing: they end at the next block.
OPEN = frozenset("svg object canvas template".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
#: An opening tag closes the nearest of these elements, unless one of the walls stands in between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    text: str
    #: Open elements from the outermost to the innermost one: tag and name tokens of class, id and role.
    path: list[tuple[str, tuple[str, ...]]]
    #: Characters within links.
    linked: int


def tokens(attributes: str) -> tuple[str, ...]:
    """Lower-case words in the values of class, id and role."""
    found = []
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        found += [t.lower() for t in _NAME.findall(a or b or c)]
    return tuple(dict.fromkeys(found))


def _pairs(page: str, tag: str) -> dict[int, int]:
    """Where the elements of a name that have an end tag begin and end."""
    begun, ends = [], {}
    for m in re.finditer(rf"<(/?){tag}\b([^>]*+)>", page, re.I):
        if not m[1]:
            begun += [] if m[2].endswith("/") else [m.start()]
        elif begun:
            ends[begun.pop()] = m.end()
    return ends


def _next_block(page: str, at: int) -> int:
    """Start of the next tag of a block or of raw content; the title of a drawing is none."""
    for m in _MARKUP.finditer(page, at):
        tag = (m[2] or m[5] or "").lower()
        if tag in RAW or tag in BLOCK and tag != "title":
            return m.start()
    return len(page)


def blocks(page: str) -> list[Block]:
    """All blocks with text, in page order. White space is one space; ``br`` is white space; references are decoded."""
    out: list[Block] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    linked = links = 0
    pairs: dict[str, dict[int, int]] = {}

    def flush() -> None:
        nonlocal text, linked
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            out.append(Block(joined, [e for e in path if e[0] in BLOCK or e[1]], linked))
        text, linked = [], 0

    def close(i: int) -> None:
        nonlocal links
        links -= sum(1 for tag, _ in path[i:] if tag == "a")
        del path[i:]

    def add(part: str) -> None:
        nonlocal linked
        if part:
            text.append(part)
            linked += len(part) if links else 0

    at = 0
    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            i = next((i for i in range(len(path) - 1, -1, -1) if path[i][0] == tag), -1)
            if tag in BLOCK:
                flush()
            if i >= 0 and (tag in BLOCK or not any(t in BLOCK for t, _ in path[i:])):
                close(i)
            continue
        if tag == "br":
            text.append(" ")
        elif tag in BLOCK:
            flush()
            if path and path[-1][0] != tag or tag != "p":
                _imply(path, tag, close)
            else:
                close(len(path) - 1)
        attributes = m[3] or m[6] or ""
        if tag in OPEN:
            if not attributes.endswith("/"):
                if tag not in pairs:
                    pairs[tag] = _pairs(page, tag)
                at = pairs[tag].get(m.start()) or _next_block(page, at)
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end and not attributes.endswith("/") else at if attributes.endswith("/") else len(page)
        elif tag not in VOID and not (attributes.endswith("/") and tag not in BLOCK):
            path.append((tag, tokens(attributes) if attributes else ()))
            links += tag == "a"
    flush()
    return out


def _imply(path: list, tag: str, close) -> None:
    """Closes what the opening tag of a block ends without an end tag."""
    ends, walls = CLOSES.get(tag, (set(), set()))
    for i in range(len(path) - 1, -1, -1):
        name = path[i][0]
        if name in ends:
            close(i)
            return
        if name in walls:
            return
        if name == "p" or name not in BLOCK and any(t == "p" for t, _ in path[:i]):
            # A paragraph, with the inline elements that were left open in it, ends at any block.
            if name == "p":
                close(i)
                if not ends:
                    return
        elif name in BLOCK and not ends:
            return

"""A small forgiving reader of HTML: the block elements of a page as a tree, with their text blocks.

Inline elements do not make nodes; their text joins the block they stand in, and a share of it that
lies in links is remembered. Scripts, styles and what else is never shown make no text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

TEXT = "#text"
# fixed values of the language: elements without end tag, raw or hidden content, and inline elements
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_HIDDEN = {"script", "style", "template", "noscript", "iframe", "object", "svg", "math", "title", "textarea", "select"}
_INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
_ENDS_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1",
    "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
# a start tag ends an open element of these kinds, up to the given container
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, set()),
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HIDDEN_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE) for tag in _HIDDEN}
# elements nested deeper hang on the last one that counts, as browsers do; nothing is lost by it
_DEEPEST = 512


@dataclass
class Page:
    """Nodes in page order; node 0 is the root. ``label`` is what a ``data-label`` says, if any."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#root"])
    names: list[list[str]] = field(default_factory=lambda: [[]])
    text: list[str] = field(default_factory=lambda: [""])
    linked: list[float] = field(default_factory=lambda: [0.0])
    label: list[int | None] = field(default_factory=lambda: [None])

    def add(self, parent: int, tag: str, names: list[str], text: str, linked: float, label: int | None) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(label)
        return len(self.tag) - 1


def read(source: str) -> Page:
    """The tree of a page; never fails, whatever the markup."""
    page, stack = Page(), [0]
    # depths in the stack of the open elements of each kind
    open_at: dict[str, list[int]] = {}
    parts: list[str] = []
    in_link = linked = 0

    def parent() -> int:
        return stack[min(len(stack), _DEEPEST) - 1]

    def innermost(kinds: set[str]) -> int:
        return max((open_at[k][-1] for k in kinds if open_at.get(k)), default=0)

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            page.add(parent(), TEXT, [], text, min(1.0, linked / max(1, len(text))), None)
        parts.clear()
        linked = 0

    def close(kinds: set[str], within: set[str]) -> None:
        depth = innermost(kinds)
        if depth > innermost(within):
            flush()
            for node in reversed(stack[depth:]):
                open_at[page.tag[node]].pop()
            del stack[depth:]

    at = 0
    while token := _TOKEN.match(source, at):
        at = token.end()
        if token["text"]:
            parts.append(token["text"])
            linked += len(token["text"]) if in_link else 0
            continue
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if token["end"]:
            if tag == "a":
                in_link = 0
            elif tag not in _INLINE:
                close({tag}, {"td", "th", "table"} if tag not in ("table", "tr", "td", "th", "tbody") else set())
                in_link = 0
            continue
        if tag in _HIDDEN:
            # what stands inside is not read at all, whatever quotes and signs it holds
            end = _HIDDEN_ENDS[tag].search(source, at)
            at = end.end() if end else len(source)
        elif tag in ("br", "wbr"):
            parts.append(" " if tag == "br" else "")
        elif tag == "a":
            in_link = 1
        elif tag in _VOID:
            if tag == "hr":
                flush()
        elif tag not in _INLINE:
            flush()
            if tag in _ENDS_P:
                close({"p"}, {"td", "th", "table", "button"})
            if tag in _ENDS:
                close(*_ENDS[tag])
            attrs = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(token["attrs"] or "")}
            spelled = " ".join(attrs.get(k, "") for k in ("class", "id", "role"))
            names = [n.lower() for n in _NAME.findall(spelled)]
            label = attrs.get("data-label")
            node = page.add(parent(), tag, names, "", 0.0, int(label) if label in ("0", "1") else None)
            if not (token["attrs"] or "").endswith("/"):
                open_at.setdefault(tag, []).append(len(stack))
                stack.append(node)
    flush()
    return page

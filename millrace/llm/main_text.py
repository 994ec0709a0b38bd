"""Main text of web pages by a tree-structured graphical model.

Every block element and text block of a page is a node that is content or not. Potentials of a node
come from its tag, its class and id names and its text; potentials between parent and child carry
the decision through the tree. One pass of sum-product messages up the tree and one down give exact
marginals; the text blocks whose marginal is at least one half are the main text.

Training maximises the likelihood of labelled pages. A page labels itself where it has one
``article`` or ``main``. Copies of such pages teach what the sample's own markup does not show: in
them the container has another name, and side matter made of the page's own text is put in. The
sample is bounded (``max_pages``, by a hash of the id, of the pages that label themselves).
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.dom import TEXT, Page, read

BITS = 14
# names that containers of main text, and of what is around it, commonly have
_CONTENT_NAMES = (
    "content", "post", "entry", "story", "main content", "article body", "post content", "entry content", "text", "page body",
)
_SIDE_MATTER = (
    ("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget"), ("header", ""), ("header", "site header"),
    ("div", "header"), ("div", "masthead"), ("div", "menu"), ("nav", ""), ("div", "navigation"), ("ul", "nav menu"),
    ("div", "breadcrumbs"), ("footer", ""), ("div", "footer"), ("div", "copyright"), ("form", ""), ("form", "newsletter"),
    ("div", "subscribe signup"), ("form", "search"), ("div", "cookie notice"), ("div", "cookie banner"), ("div", "consent"),
    ("div", "notice"), ("div", "alert"), ("div", "banner"), ("div", "promo"), ("div", "ad"), ("div", "ads"),
    ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("div", "share social"), ("div", "related posts"),
    ("div", "recommended"), ("div", "tags meta"), ("div", "login"), ("div", "popup modal"), ("div", "pagination"),
)
_COMMENTS = (
    ("section", "comments"), ("div", "comments"), ("div", "comment list"), ("ol", "commentlist"), ("div", "discussion"),
    ("div", "responses"), ("div", "replies"), ("section", "reviews"), ("div", "disqus thread"),
)
_GROUPS = {
    TEXT: 0, "div": 2, "section": 2, "nav": 3, "aside": 3, "footer": 3, "header": 3, "form": 3, "article": 4, "main": 4,
}
_KINDS = 5


@dataclass(frozen=True)
class Settings:
    max_pages: int = 300
    max_bytes: int = 1 << 18
    copies: int = 3
    steps: int = 80
    rate: float = 0.3
    decay: float = 1e-4


@dataclass(frozen=True)
class Model:
    node: np.ndarray  # weight of each feature for "content"
    edge: np.ndarray  # kind of the child x label of the parent x label of the child


@dataclass
class Forest:
    """Nodes of many pages. ``depth`` orders the messages; ``features`` lie flat, by ``bounds``."""

    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    features: np.ndarray
    bounds: np.ndarray
    first: np.ndarray


def _described(page: Page) -> list[list[str]]:
    out = []
    for tag, names, text, linked, parent in zip(page.tag, page.names, page.text, page.linked, page.parent):
        above = page.tag[parent] if parent >= 0 else ""
        if tag == TEXT:
            size = len(text.split())
            out.append([
                "text", f"in {above}", f"words {min(size.bit_length(), 8)}", f"links {round(linked * 4)}",
                f"ends {text[-1] in '.!?…:;'}", f"long {size >= 15 and linked < 0.3}",
            ])
        else:
            out.append(["node", f"tag {tag}", *(f"name {n}" for n in names), *(f"{tag} name {n}" for n in names)])
    return out


_NUMBERS: dict[str, int] = {}


def _number(name: str) -> int:
    if name not in _NUMBERS:
        if len(_NUMBERS) > 100_000:
            _NUMBERS.clear()
        _NUMBERS[name] = zlib.crc32(name.encode()) & ((1 << BITS) - 1)
    return _NUMBERS[name]


def forest(pages: list[Page]) -> Forest:
    first = np.cumsum([0, *(len(p.tag) for p in pages)])
    parent = np.concatenate([np.array(p.parent) + np.where(np.array(p.parent) < 0, 0, f) for p, f in zip(pages, first)])
    depth = np.zeros(len(parent), np.int64)
    for k, up in enumerate(parent):  # parents come before their children
        if up >= 0:
            depth[k] = depth[up] + 1
    kind = np.array([_GROUPS.get(t, 1) for p in pages for t in p.tag])
    described = [d for p in pages for d in _described(p)]
    bounds = np.cumsum([0, *map(len, described)])
    features = np.array([_number(x) for d in described for x in d], np.int64)
    return Forest(parent, depth, kind, features, bounds, first)


def _spread(x: np.ndarray) -> np.ndarray:
    """log sum exp over the last axis, of two."""
    return np.logaddexp(x[..., 0], x[..., 1])


def beliefs(trees: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log marginals of every node, and of every (parent, node) pair, by sum-product."""
    n = len(trees.parent)
    sums = np.concatenate([[0.0], np.cumsum(model.node[trees.features])])
    own = np.zeros((n, 2))
    own[:, 1] = sums[trees.bounds[1:]] - sums[trees.bounds[:-1]]
    edge, up = model.edge[trees.kind], np.zeros((n, 2))
    order = np.argsort(trees.depth, kind="stable")
    levels = np.split(order, np.searchsorted(trees.depth[order], np.arange(1, trees.depth.max(initial=0) + 1)))
    for level in reversed(levels[1:]):  # leaves first: own now holds what a subtree says
        up[level] = _spread(edge[level] + own[level, None, :])
        np.add.at(own, trees.parent[level], up[level])
    full, pair = own.copy(), np.full((n, 2, 2), -np.inf)
    for level in levels[1:]:
        rest = full[trees.parent[level]] - up[level]
        pair[level] = rest[:, :, None] + edge[level] + own[level, None, :]
        full[level] = _spread(np.swapaxes(pair[level], 1, 2))
    total = _spread(full)
    return full - total[:, None], pair - total[:, None, None]


def fit(pages: list[Page], settings: Settings = Settings()) -> Model:
    """Maximum likelihood by AdaGrad; a node's label is that of its nearest labelled ancestor.

    Without pages all potentials are zero and every block counts as main text.
    """
    model = Model(np.zeros(1 << BITS), np.zeros((_KINDS, 2, 2)))
    if not pages:
        return model
    trees = forest(pages)
    label = np.zeros(len(trees.parent), np.int64)
    for k, said in enumerate(x for p in pages for x in p.label):
        label[k] = said if said is not None else (label[trees.parent[k]] if trees.parent[k] >= 0 else 0)
    child = trees.parent >= 0
    truth = np.zeros((len(label), 2, 2))
    truth[np.flatnonzero(child), label[trees.parent[child]], label[child]] = 1.0
    owner = np.repeat(np.arange(len(label)), np.diff(trees.bounds))
    seen_n, seen_e = np.full(model.node.shape, 1e-8), np.full(model.edge.shape, 1e-8)
    for _ in range(settings.steps):
        single, pair = beliefs(trees, model)
        off = (np.exp(single[:, 1]) - label) / len(pages)
        grad_n = np.bincount(trees.features, off[owner], 1 << BITS) + settings.decay * model.node
        gap = np.where(child[:, None, None], np.exp(pair) - truth, 0.0) / len(pages)
        grad_e = np.zeros_like(model.edge)
        np.add.at(grad_e, trees.kind, gap)
        seen_n += grad_n**2
        seen_e += grad_e**2
        model.node[:] -= settings.rate * grad_n / np.sqrt(seen_n)
        model.edge[:] -= settings.rate * grad_e / np.sqrt(seen_e)
    return model


# ---- labelled pages --------------------------------------------------------------------------

_MARKS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|textarea)\b[^>]*>.*?(?:</\1\b|\Z)"
    r"|<(?P<end>/?)(?P<tag>article|main)\b(?P<attrs>[^>]*)>",
    re.DOTALL | re.IGNORECASE,
)


def containers(source: str) -> list[tuple[re.Match, re.Match]]:
    """Start and end tags of the outermost articles and mains that are closed; one pass."""
    found, stack, held = [], [], {"article": 0, "main": 0}
    for mark in _MARKS.finditer(source):
        if mark["tag"] is None:
            continue
        tag = mark["tag"].lower()
        if not mark["end"]:
            stack.append((tag, mark))
            held[tag] += 1
        elif held[tag]:
            kind = None
            while kind != tag:
                kind, start = stack.pop()
                held[kind] -= 1
            if not stack:
                found.append((start, mark))
    return found


def labels_itself(source: str | None) -> bool:
    """Has the page exactly one outermost container?"""
    return len(containers(source or "")) == 1


def labelled(source: str, copies: int, seed: int) -> Iterator[str]:
    """The page with its container labelled, and copies with other names and side matter put in.

    Nothing for a page without exactly one container.
    """
    found = containers(source)
    if len(found) != 1:
        return
    start, end = found[0]
    before, inner, after = source[: start.start()], source[start.end() : end.start()], source[end.end() :]
    tag = start["tag"]
    yield f'{before}<{tag}{start["attrs"]} data-label="1">{inner}</{tag}>{after}'
    yield from _copies(before, inner, after, copies, seed)


def composed(source: str, copies: int, seed: int) -> Iterator[str]:
    """Labelled pages made of the longer paragraphs of a page that says nothing about itself."""
    page = read(source)
    long = [t for t, p in zip(page.text, page.parent) if t and len(t.split()) >= 8 and page.tag[p] == "p"]
    if long:
        inner = "".join(f"<p>{html.escape(t)}</p>" for t in long)
        yield from _copies("<html><body>", inner, "</body></html>", copies, seed)


def _copies(before: str, inner: str, after: str, copies: int, seed: int) -> Iterator[str]:
    dice = random.Random(seed)
    prose = [s.strip() for s in re.split(r"<[^>]*>", inner) if len(s.split()) >= 8] or ["."]
    words = re.sub(r"<[^>]*>", " ", inner).split() or ["."]

    def side(tag: str, name: str, body: str) -> str:
        attr = dice.choice(("class", "id")) if name else ""
        name = name if attr == "class" else name.replace(" ", "-")
        return f'<{tag} {attr}="{name}" data-label="0">{body}</{tag}>' if attr else f'<{tag} data-label="0">{body}</{tag}>'

    def phrase() -> str:
        at = dice.randrange(len(words))
        return " ".join(words[at : at + dice.randrange(1, 14)])

    def matter() -> str:
        tag, name = dice.choice(_SIDE_MATTER)
        shapes = (
            lambda: phrase(),
            lambda: f"<p>{phrase()}</p>",
            lambda: f"<h3>{phrase()}</h3><ul>" + "".join(f'<li><a href="/x">{phrase()}</a></li>' for _ in range(3)) + "</ul>",
            lambda: f"<p>{dice.choice(prose)}</p>",
            lambda: f"<div>{phrase()} <a href='/y'>{phrase()}</a></div>",
        )
        return side(tag, name, dice.choice(shapes)())

    def comments() -> str:
        tag, name = dice.choice(_COMMENTS)
        one = lambda: f'<div class="comment"><p>{dice.choice(prose)}</p></div>'
        return side(tag, name, f"<h3>{phrase()}</h3>" + "".join(one() for _ in range(dice.randrange(1, 4))))

    for _ in range(copies):
        name = dice.choice(_CONTENT_NAMES)
        tag = dice.choice(("article", "main", "div", "div", "section"))
        pieces = re.split(r"(?=<p\b)", inner)
        for _ in range(dice.randrange(0, 3)):
            pieces.insert(dice.randrange(1, len(pieces) + 1), matter())
        attr = f' {dice.choice(("class", "id"))}="{name}"' if tag in ("div", "section") or dice.random() < 0.3 else ""
        text = f'<{tag}{attr} data-label="1">{"".join(pieces)}</{tag}>'
        text = "".join(matter() for _ in range(dice.randrange(0, 4))) + text
        text += "".join(matter() for _ in range(dice.randrange(0, 4)))
        text += comments() if dice.random() < 0.6 else ""
        wrap = dice.choice(("", "div", "main"))
        if wrap and wrap != tag:
            text = f"<{wrap}>{text}</{wrap}>"
        yield before + text + after


# ---- over tables -----------------------------------------------------------------------------


def train(pages: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from at most ``max_pages`` of the pages that label themselves, none over ``max_bytes``.

    Where no page does, pages are composed of paragraphs of the table, with side matter around them.
    Where there are no paragraphs either, there is nothing to learn and every block is main text.
    """

    def telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["page_id"]).filter(pa.array([labels_itself(x) for x in batch.column("html").to_pylist()], pa.bool_()))

    known = pages.where("page_id IS NOT NULL").where(F.octet_length("html") <= settings.max_bytes)
    known = known.select(F.col("page_id").cast("long").alias("page_id"), "html")
    likely = known.where(F.col("html").rlike("(?i)<(article|main)\\b"))

    def sample(ids: DataFrame) -> list[tuple[int, str]]:
        # a proven bound for a broadcast, and for what reaches the driver
        picked = ids.orderBy(F.xxhash64("page_id", F.lit("main text")), "page_id").limit(settings.max_pages)
        rows = known.join(F.broadcast(picked), "page_id", "left_semi").orderBy("page_id", "html").limit(settings.max_pages)
        return sorted({(r.page_id, r.html) for r in rows.collect()})

    rows, made = sample(likely.mapInArrow(telling, "page_id long").distinct()), labelled
    if not rows:
        paragraphs = known.where(F.col("html").rlike("(?i)<p\\b")).select("page_id").distinct()
        rows, made = sample(paragraphs), composed
    return fit([read(s) for number, source in rows for s in made(source, settings.copies, number)], settings)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``pages (page_id, url, html)``: ``page_id, url, text, n_chars``.

    ``text`` has the main text's blocks in page order, one to a line; it is empty where there are
    none, as for a NULL or empty page. ``n_chars`` counts code points. Repeated rows get the same
    answer each; other columns are not read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source in range(0, batch.num_rows, 100):
                found = [read(x or "") for x in batch.column("html").slice(source, 100).to_pylist()]
                trees = forest(found)
                content = beliefs(trees, model)[0][:, 1] >= np.log(0.5) - 1e-12
                for page, a in zip(found, trees.first):
                    kept = [t for k, t in enumerate(page.text) if t and content[a + k]]
                    texts.append("\n".join(kept))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes]
            yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars"])

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return slim.mapInArrow(rows, "page_id long, url string, text string, n_chars long")

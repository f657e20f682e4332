"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the page tree.

A leaf block is the text between two borders of block elements, with its open elements. Features are the tags of
those ancestors, the words of their class, id and role names, and properties of the text; neighbouring
blocks are tied by label transitions. The field is trained on labelled pages and decoded by Viterbi.

Labelled pages: a bounded sample of the table's pages, whose seed labels come from their own semantic elements, and the
same blocks dressed anew in the mark-up that sites use for articles and for what surrounds them, so that the field
does not depend on one site's habits.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TRAIN_PAGES = 150
DRESSES = 3
TAGS_OF_BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " label legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page: code, styles, form controls, raw mark-up of frames, sources of formulas.
NO_TEXT = set("script style template head title textarea select iframe annotation annotation-xml".split())
CLOSES_ITSELF = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "td": "td th", "th": "td th", "option": "option", "p": "p"}
SCOPES = set("ul ol dl table article section div main body aside nav td th blockquote form".split())
OUTSIDE = set("nav aside footer header form menu dialog search".split())


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]
    names: frozenset[str]
    near: tuple[str, ...]
    linked: int


def _names(attrs: list[tuple[str, str | None]]) -> list[str]:
    found = []
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            spaced = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()
            found += re.findall(r"[a-z]{2,}", spaced)
    return found


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.hidden = self.links = 0
        self.pieces: list[str] = []
        self.linked = 0
        self.at: list[tuple[str, tuple[str, ...]]] | None = None

    def border(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text and self.at is not None:
            named = [names for _, names in self.at if names]
            # The innermost element that says what it is, by names or by its tag.
            near = next((names or (tag,) for tag, names in reversed(self.at) if names or tag in OUTSIDE), ())
            self.blocks.append(Block(text, tuple(t for t, _ in self.at), frozenset(n for names in named for n in names), near, self.linked))
        self.pieces, self.linked, self.at = [], 0, None

    def _leave(self, place: int) -> None:
        for tag, _ in self.open[place:]:
            self.hidden -= tag in NO_TEXT
            self.links -= tag == "a"
        del self.open[place:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("br", "wbr", "img", "input"):
            self.pieces.append(" " if tag != "wbr" else "")
        if tag in TAGS_OF_BLOCKS:
            self.border()
            closed = CLOSES_ITSELF.get(tag, "p").split()
            if tag not in ("html", "head", "body"):
                for place in range(len(self.open) - 1, -1, -1):
                    if self.open[place][0] in closed:
                        self._leave(place)
                        break
                    if self.open[place][0] in SCOPES:
                        break
        if tag not in VOID:
            self.open.append((tag, tuple(_names(attrs))))
            self.hidden += tag in NO_TEXT
            self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in TAGS_OF_BLOCKS:
            self.border()
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == tag:
                self._leave(place)
                break
            if tag not in TAGS_OF_BLOCKS and tag not in NO_TEXT and self.open[place][0] in SCOPES:
                break

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        if self.at is None and not data.isspace():
            self.at = list(self.open)
        self.pieces.append(data)
        if self.links:
            self.linked += len(data)


def leaf_blocks(html: str | None) -> list[Block]:
    """Leaf blocks in page order; broken mark-up never fails, marked sections are skipped."""
    tree = _Tree()
    tree.feed(re.sub(r"<!\[[^>]*>?", " ", html or ""))
    tree.close()
    tree.border()
    return tree.blocks


def heads_article(tags: tuple[str, ...]) -> bool:
    """Whether a block is a heading in an article's own header."""
    inner = next((i for i, t in enumerate(tags) if t in ("article", "main")), len(tags))
    return bool({"h1", "h2"} & set(tags)) and OUTSIDE & set(tags[inner:]) == {"header"} and not OUTSIDE & set(tags[:inner])


def block_features(block: Block, place: int, count: int) -> list[str]:
    n = len(block.text)
    words = block.text.count(" ") + 1
    ends = block.text[-1] in ".!?…:;\"»”'"
    link = block.linked / max(n, 1)
    found = ["bias", f"size {min(n.bit_length(), 10)}", f"words {min(words.bit_length(), 7)}", f"ends {ends}", f"link {min(int(link * 4), 4)}"]
    found += [f"own {t}" for t in block.tags[-1:]] + [f"over {t}" for t in block.tags[-2:-1]]
    found += [f"in {t}" for t in set(block.tags)] + [f"name {n}" for n in block.names]
    found += [f"near {n}" for n in block.near]
    if heads_article(block.tags):
        found.append("heads article")
    if "©" in block.text or "copyright" in block.text.lower():
        found.append("copyright")
    if place == 0:
        found.append("first")
    if place == count - 1:
        found.append("last")
    return found


def seed_labels(blocks: list[Block]) -> list[int]:
    """1 for blocks of an article or main element outside its own menus and asides; without one, long unlinked texts.

    Headings in the article's own header belong to it.
    """
    semantic = any("article" in b.tags or "main" in b.tags for b in blocks)
    out = []
    for b in blocks:
        outside = bool(OUTSIDE & set(b.tags)) or bool(b.names & OUTER_NAMES)
        inside = ("article" in b.tags or "main" in b.tags) if semantic else len(b.text) >= 80 and 4 * b.linked < len(b.text)
        heads = heads_article(b.tags) and not b.names & OUTER_NAMES - {"header"}
        out.append(int(inside and not outside or heads))
    return out


# Names that sites give to the elements around an article, by kind, and to the article itself.
OUTER = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav pagination pager toc tabs",
    "header": "header masthead banner branding topbar logo hero site-header page-header",
    "footer": "footer colophon copyright legal bottom site-footer page-footer credits imprint",
    "aside": "sidebar aside related recommended widget trending popular teaser rail promo-box more-stories read-more",
    "ad": "ad ads advert advertisement sponsor sponsored promo promoted adsbygoogle banner-ad ad-slot commercial",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay message warning disclaimer announcement cookie-banner paywall",
    "form": "form newsletter subscribe signup login search contact search-box subscription feedback poll",
    "comments": "comments comment comment-list commentlist reply replies discussion responses disqus respond reader-comments comment-body user-comments",
    "share": "share social sharing follow tags meta byline-tools toolbar print author-box bio",
}
INNER = "content article post entry story main body text entry-content article-body post-content main-content story-body page-content article-text"
OUTER_NAMES = {n for names in OUTER.values() for x in names.split() for n in re.findall(r"[a-z]{2,}", x)} - {"site", "page", "body", "more", "user", "box", "text"}
ELEMENTS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section", "notice": "div", "ad": "div", "share": "div"}


def _attribute(rng: random.Random, names: str) -> str:
    chosen = rng.choice(names.split())
    extra = rng.choice(["", "", " box", " wrap", " clearfix", " col-4", " js-x"])
    return rng.choice([f' class="{chosen}{extra}"', f' id="{chosen}"', f' class="{chosen}"', f' class="l-{chosen} block"'])


def _surround(rng: random.Random, kind: str, texts: list[str]) -> list[tuple[str, int]]:
    """One part of a page that is no article: rows of (html, label)."""
    element = ELEMENTS[kind] if rng.random() < 0.5 else rng.choice(["div", "div", "section", "aside" if kind in ("aside", "ad") else "div"])
    # Menus need no name: their links tell.
    bare = element not in ("div", "section") and rng.random() < 0.4 or kind == "nav" and rng.random() < 0.2
    named = "" if bare else _attribute(rng, OUTER[kind])
    rows: list[tuple[str, int]] = [(f"<{element}{named}>", -1)]
    if kind in ("nav", "share") or kind in ("footer", "header", "aside") and rng.random() < 0.5:
        rows += [("<ul>", -1)] + [(f'<li><a href="#">{escape(" ".join(t.split()[: rng.randint(1, 4)]))}</a></li>', 0) for t in texts[:5]] + [("</ul>", -1)]
    elif kind == "comments":
        for t in texts[: rng.randint(1, 4)]:
            inner = _attribute(rng, OUTER[kind]) if rng.random() < 0.5 else ""
            rows += [(f"<div{inner}>", -1), (f"<p>{escape(t)}</p>", 0), ("</div>", -1)]
    elif kind == "form":
        rows += [(f"<label>{escape(' '.join(texts[0].split()[:3]))}</label>", 0), (f"<p>{escape(texts[-1][:90])}</p>", 0), ("<button>Go</button>", 0)]
    else:
        wrap = rng.choice(["p", "div", "span", "h3"])
        rows += [(f"<{wrap}>{escape(t[: rng.choice([60, 150, 400])])}</{wrap}>" + ("" if wrap != "span" else "<hr>"), 0) for t in texts[: rng.randint(1, 2)]]
    return [*rows, (f"</{element}>", -1)]


def dressed_page(rng: random.Random, content: list[str], other: list[str]) -> tuple[str, list[int]]:
    """A page of the given texts in one of many mark-ups, with the label of every leaf block."""
    pick = lambda: [rng.choice(other) for _ in range(6)] if rng.random() < 0.7 else [rng.choice(content) for _ in range(4)]
    rows: list[tuple[str, int]] = []
    for kind in rng.sample(["header", "nav", "notice", "ad", "aside", "form"], rng.randint(1, 4)):
        rows += _surround(rng, kind, pick())
    element = rng.choice(["article", "article", "main", "div", "div", "section", "td"])
    named = _attribute(rng, INNER) if element in ("div", "section") or rng.random() < 0.4 else ""
    outer = rng.choice(["", "", "main", "div"])
    rows += [(f"<{outer}>", -1)] if outer else []
    rows.append((f"<{element}{named}>", -1))
    inside = rng.random() < 0.5
    for i, text in enumerate(content):
        if inside and i and rng.random() < 0.2:
            rows += _surround(rng, rng.choice(["ad", "aside", "share", "form", "notice"]), pick())
        tag = rng.choice(["h1", "h2"]) if i == 0 and rng.random() < 0.6 else rng.choice(["p", "p", "p", "p", "div", "li", "blockquote", "h2", "pre"])
        body = escape(text)
        if rng.random() < 0.2:
            body = f'<a href="#">{body[:20].split("&")[0]}</a>{body[len(body[:20].split("&")[0]):]}'
        own = element in ("article", "main") and tag in ("h1", "h2") and rng.random() < 0.3
        rows.append((f"<header><{tag}>{body}</{tag}></header>" if own else f"<{tag}>{body}</{tag}>", 1))
    if inside and rng.random() < 0.4:
        rows += _surround(rng, "comments", [rng.choice(content) for _ in range(4)])
    rows.append((f"</{element}>", -1))
    for kind in rng.sample(["comments", "aside", "ad", "share", "form", "notice"], rng.randint(0, 3)):
        rows += _surround(rng, kind, [rng.choice(content) for _ in range(4)] if kind == "comments" else pick())
    rows += [(f"</{outer}>", -1)] if outer else []
    rows += _surround(rng, "footer", pick()) if rng.random() < 0.8 else []
    return "<html><body>" + "".join(h for h, _ in rows) + "</body></html>", [k for _, k in rows if k >= 0]


@dataclass
class Field:
    """Weights of the two labels by feature, of label pairs and of the first label."""

    weights: dict[str, tuple[float, float]] = field(default_factory=dict)
    pairs: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def emissions(self, blocks: list[Block]) -> list[tuple[float, float]]:
        out = []
        get, n = self.weights.get, len(blocks)
        for i, block in enumerate(blocks):
            a = b = 0.0
            for f in block_features(block, i, n):
                w = get(f)
                if w is not None:
                    a += w[0]
                    b += w[1]
            out.append((a, b))
        return out

    def viterbi(self, blocks: list[Block]) -> list[int]:
        """The most probable label of every block; ties keep the block out."""
        if not blocks:
            return []
        (t00, t01), (t10, t11) = self.pairs
        rows = self.emissions(blocks)
        s0, s1 = rows[0]
        back = []
        for e0, e1 in rows[1:]:
            from0, from1 = s1 + t10 > s0 + t00, s1 + t11 > s0 + t01
            back.append((from0, from1))
            s0, s1 = (s1 + t10 if from0 else s0 + t00) + e0, (s1 + t11 if from1 else s0 + t01) + e1
        label = int(s1 > s0)
        out = [label]
        for pointers in reversed(back):
            label = int(pointers[label])
            out.append(label)
        return out[::-1]


def trained_field(pages: list[tuple[list[Block], list[int]]], rounds: int = 15, decay: float = 2e-3) -> Field:
    """Maximum likelihood with adaptive gradient steps; gradients by the forward-backward recursion."""
    number: dict[str, int] = {}
    data = []
    for blocks, labels in pages:
        if blocks:
            rows = [[number.setdefault(f, len(number)) for f in block_features(b, i, len(blocks))] for i, b in enumerate(blocks)]
            data.append((np.concatenate([np.array(r) for r in rows]), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array(labels)))
    weights, pairs = np.zeros((len(number), 2)), np.zeros((2, 2))
    squares, pair_squares = np.full((len(number), 2), 1e-6), np.full((2, 2), 1e-6)
    order = np.arange(len(data))
    rng = np.random.default_rng(3)
    for _ in range(rounds):
        rng.shuffle(order)
        for k in order:
            columns, rows, labels = data[k]
            n = len(labels)
            emit = np.zeros((n, 2))
            np.add.at(emit, rows, weights[columns])
            forward, backward = np.empty((n, 2)), np.zeros((n, 2))
            forward[0] = emit[0]
            for i in range(1, n):
                forward[i] = emit[i] + np.logaddexp(forward[i - 1, 0] + pairs[0], forward[i - 1, 1] + pairs[1])
            for i in range(n - 2, -1, -1):
                onward = emit[i + 1] + backward[i + 1]
                backward[i] = np.logaddexp(pairs[:, 0] + onward[0], pairs[:, 1] + onward[1])
            total = np.logaddexp(*forward[-1])
            error = np.exp(forward + backward - total)
            error[np.arange(n), labels] -= 1
            slope = np.zeros_like(weights)
            np.add.at(slope, columns, error[rows])
            touched = np.unique(columns)
            g = slope[touched] + decay * weights[touched]
            squares[touched] += g * g
            weights[touched] -= 0.3 * g / np.sqrt(squares[touched])
            if n > 1:
                both = np.exp(forward[:-1, :, None] + pairs[None] + (emit + backward)[1:, None, :] - total).sum(0)
                np.add.at(both, (labels[:-1], labels[1:]), -1)
                pair_squares += both * both
                pairs -= 0.3 * both / np.sqrt(pair_squares)
    return Field({f: tuple(weights[i].tolist()) for f, i in number.items()}, tuple(map(tuple, pairs.tolist())))


def labelled_pages(htmls: list[str]) -> list[tuple[list[Block], list[int]]]:
    """Seed-labelled pages and their blocks in other dresses."""
    rng = random.Random(11)
    parsed = [(blocks, seed_labels(blocks)) for blocks in map(leaf_blocks, htmls)]
    other = [b.text for blocks, labels in parsed for b, y in zip(blocks, labels, strict=True) if not y]
    out = list(parsed)
    for blocks, labels in parsed:
        content = [b.text for b, y in zip(blocks, labels, strict=True) if y]
        for _ in range(DRESSES if content and other else 0):
            html, wanted = dressed_page(rng, content[: rng.randint(1, 12)], other)
            found = leaf_blocks(html)
            if len(found) == len(wanted):
                out.append((found, wanted))
    return out


def main_text(model: Field, html: str | None) -> str:
    blocks = leaf_blocks(html)
    return "\n".join(b.text for b, y in zip(blocks, model.viterbi(blocks), strict=True) if y)


def _extracted(model: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(model, x.as_py()) for x in batch.column("html")]
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return run


def extract_pages(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    text joins the chosen blocks by one line feed; it is empty for NULL or empty pages and pages without text. The field is
    fitted on at most ``train_pages`` pages chosen by hash. Repeated rows are treated alike; no rows give no rows.
    """
    rows = pages.select("page_id", "url", "html")
    count = max(1, rows.count())
    hashed = F.pmod(F.xxhash64("page_id", "url", F.lit("field")), F.lit(1_000_000))
    sampled = rows.where("html is not null").where(hashed < int(1_000_000 * min(1.0, 2 * train_pages / count)) + 1)
    htmls = [r["html"] for r in sampled.select("html", hashed.alias("h")).orderBy("h", "html").limit(train_pages).collect()]
    model = trained_field(labelled_pages(htmls))
    return rows.mapInArrow(_extracted(model), "page_id long, url string, text string, n_chars long")

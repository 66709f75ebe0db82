"""Main text of web pages by a conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between the starts and ends of block
elements.  A block's features are the tags of its ancestors, the words of their classes
and ids, and marks of its text (length, share of links, punctuation).  A linear chain
over the blocks of a page, trained on labelled pages by its likelihood, tells main text
from the rest; Viterbi decodes the best sequence.

Cases: a null or empty page has no text; unclosed, misnested and cut-off markup is read
as far as it goes; very long pages and very deep markup are read whole, in time that grows
with their length; repeated rows give a row each; an empty table gives an empty result;
further columns are left aside.
"""

from __future__ import annotations

import html as references
import random
import re
from collections.abc import Container
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import Batches, in_arrow

# Elements that start a block, that have no end, whose content is no markup,
# that are empty if they close themselves, and that end an open element of the same kind.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea"
SELF_CLOSED = frozenset([*RAW.split("|"), "svg", "math", "object", "iframe"])
SIBLINGS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"),
            "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Elements beyond which no sibling is looked for.
LISTS = ("ul", "ol", "dl", "table", "select", "tbody")

_PARTS = re.compile(
    rf"<!--.*?(?:-->|(?P<open>\Z))|"
    rf"<(?P<raw>{RAW})(?=[\s/>])[^>]*+(?<!/)>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|(?P<cut>\Z))|<[!?][^>]*+>|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<more2>[^>]*+)>|(?P<text>[^<]++|<)", re.S | re.I)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Leaf:
    """Text of a leaf block, the features of its ancestors, its own tag, and how many
    characters of it are links."""

    text: str
    inside: tuple[str, ...]
    tag: str
    linked: int


class _Open:
    """The open elements of a page, found by name or as the innermost block at once."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...]]] = []  # with the features of all ancestors
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.links = 0

    def innermost(self, names: tuple[str, ...]) -> int:
        """Where the innermost open element of these names lies; -1: there is none."""
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def push(self, name: str, inside: tuple[str, ...]) -> None:
        self.at.setdefault(name, []).append(len(self.stack))
        if name in BLOCK:
            self.blocks.append(len(self.stack))
        self.links += name == "a"
        self.stack.append((name, inside))

    def close(self, upto: int) -> None:
        while len(self.stack) > upto:
            name, _ = self.stack.pop()
            self.at[name].pop()
            if name in BLOCK:
                self.blocks.pop()
            self.links -= name == "a"

    @property
    def block(self) -> int:
        return self.blocks[-1] if self.blocks else -1


def leaves(page: str, known: Container[str] | None = None) -> list[Leaf]:
    """The leaf blocks of a page in their order; ``known``: the features of ancestors that
    are wanted (None: all)."""
    found: list[Leaf] = []
    open_ = _Open()
    held: list[tuple[str, bool]] = []
    drawn = 0  # open drawings (svg)

    def flush() -> None:
        if not held:
            return
        text = " ".join(references.unescape("".join(t for t, _ in held)).split())
        if text:
            tag = open_.stack[open_.block][0] if open_.blocks else ""
            found.append(Leaf(text, open_.stack[-1][1] if open_.stack else (), tag,
                              sum(len(t) for t, linked in held if linked)))
        held.clear()

    # Behind the last ">" there is no tag, however many "<" there are.
    marked = page.rfind(">") + 1
    rest = page[marked:].split("<!--", 1)[0]
    for m in _PARTS.finditer(page, 0, marked):
        text = m["text"]
        if m["open"] is not None or m["cut"] is not None:
            rest = ""  # a comment or script that goes on to the end
        if text is not None:
            if drawn:
                continue
            held.append((text, open_.links > 0))
            continue
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name, ends = name.lower(), m["end"] or m["end2"]
        attributes = m["more"] if m["name"] else m["more2"]
        if not ends and name in SELF_CLOSED and attributes.endswith("/"):
            continue
        if name == "svg":
            drawn = max(drawn + (-1 if ends else 1), 0)
            continue
        if name in BLOCK:  # ends a drawing that was left open
            drawn = 0
        elif drawn:
            continue
        if name in BLOCK:
            flush()
        elif name == "br":
            held.append((" ", open_.links > 0))
        if ends:
            at = open_.innermost((name,))
            # An inline end tag doesn't close the blocks opened since.
            if at >= 0 and (name in BLOCK or open_.block < at):
                open_.close(at)
            continue
        if name in VOID:
            continue
        if name in BLOCK:
            if open_.blocks and open_.stack[open_.block][0] == "p":
                open_.close(open_.block)
            at = open_.innermost(SIBLINGS.get(name, ()))
            if at >= 0 and at > open_.innermost(LISTS):
                open_.close(at)
        before = open_.stack[-1][1] if open_.stack else ()
        own = [f"in:{name}"]
        if attributes and "=" in attributes:
            for values in _NAMED.findall(attributes):
                own += [f"is:{w}" for w in _WORDS.findall("".join(values).lower())]
        new = [x for x in dict.fromkeys(own) if (known is None or x in known) and x not in before]
        open_.push(name, before + tuple(new) if new else before)
    if not drawn:
        held.append((rest, open_.links > 0))
    flush()
    return found


def features(blocks: list[Leaf]) -> list[list[str]]:
    """Names of the features that hold for each block."""
    out = []
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        share = b.linked / len(b.text)
        own = [f"tag:{b.tag}", f"words:{min(words.bit_length(), 8)}", f"links:{round(min(share, 1) * 4)}",
               f"end:{b.text[-1] in '.!?…:;'}", *b.inside]
        if "©" in b.text or b.text[:9].lower() == "copyright":
            own.append("copyright")
        if i == 0:
            own.append("first")
        if i == len(blocks) - 1:
            own.append("last")
        out.append(own)
    return out


@dataclass
class Field:
    """Weights of a chain with two labels, 1 for main text."""

    number: dict[str, int]
    weights: np.ndarray  # a row per feature, a column per label
    moves: np.ndarray
    start: np.ndarray

    def decode(self, named: list[list[str]]) -> list[int]:
        """The best label sequence, by Viterbi."""
        (m00, m01), (m10, m11) = self.moves.tolist()
        weights, get = self._lists(), self.number.get
        a, b = self.start.tolist()
        back: list[tuple[int, int]] = []
        for t, own in enumerate(named):
            s0 = s1 = 0.0
            for f in own:
                w = weights[get(f, -1)]
                s0 += w[0]
                s1 += w[1]
            if t:
                from0, from1 = int(b + m10 > a + m00), int(b + m11 > a + m01)
                back.append((from0, from1))
                a, b = (b + m10 if from0 else a + m00), (b + m11 if from1 else a + m01)
            a, b = a + s0, b + s1
        if not named:
            return []
        path = [int(b > a)]
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]

    def _lists(self) -> list:
        if not hasattr(self, "_cells"):
            self._cells = [*self.weights.tolist(), [0.0, 0.0]]  # the last: unknown features
        return self._cells

    def text(self, page: str | None) -> str:
        blocks = leaves(page or "", self.number)
        labels = self.decode(features(blocks))
        return "\n".join(b.text for b, label in zip(blocks, labels) if label)


def _chain(scores: np.ndarray, moves: np.ndarray, start: np.ndarray, lengths: np.ndarray):
    """Label and move probabilities and log normalisers of padded pages (page, block, label)."""
    n, longest, _ = scores.shape
    a = np.zeros((n, longest, 2))
    b = np.zeros((n, longest, 2))
    a[:, 0] = scores[:, 0] + start
    for t in range(1, longest):
        a[:, t] = np.logaddexp(a[:, t - 1, :1] + moves[0], a[:, t - 1, 1:] + moves[1]) + scores[:, t]
    last = lengths - 1
    norm = np.logaddexp(*a[np.arange(n), last].T)
    for t in range(longest - 2, -1, -1):
        after = b[:, t + 1] + scores[:, t + 1]
        b[:, t] = np.logaddexp(after[:, :1] + moves[:, 0], after[:, 1:] + moves[:, 1])
        b[last <= t, t] = 0
    inside = np.arange(longest)[None] < lengths[:, None]
    p = np.exp(a + b - norm[:, None, None]) * inside[..., None]
    pair = (a[:, :-1, :, None] + moves + (b + scores)[:, 1:, None, :]) - norm[:, None, None, None]
    pair = np.exp(np.where(inside[:, 1:, None, None], pair, -np.inf)).sum((0, 1))
    return p, pair, norm


def train(pages: list[tuple[list[Leaf], list[int]]], rounds: int = 300, decay: float = 1e-5) -> Field:
    """Maximum likelihood with a quadratic penalty, by gradient steps of adaptive length.

    ``pages``: blocks and labels of each page (pages without blocks are left out).
    """
    pages = [p for p in pages if p[0]]
    named = [features(blocks) for blocks, _ in pages]
    number: dict[str, int] = {}
    for own in named:
        for block in own:
            for f in block:
                number.setdefault(f, len(number))
    lengths = np.array([len(x) for x in named], np.int64)
    n, longest = len(pages), int(lengths.max(initial=1))
    model = Field(number, np.zeros((len(number), 2)), np.zeros((2, 2)), np.zeros(2))
    if not n:
        return model
    row = np.array([i * longest + t for i, own in enumerate(named)
                    for t, block in enumerate(own) for _ in block])
    column = np.array([number[f] for own in named for block in own for f in block])
    truth = np.zeros((n, longest, 2))
    pair = np.zeros((2, 2))
    for i, (_, labels) in enumerate(pages):
        truth[i, np.arange(len(labels)), labels] = 1
        np.add.at(pair, (labels[:-1], labels[1:]), 1)
    parts = [model.weights, model.moves, model.start]
    memory = [np.full_like(x, 1e-8) for x in parts]
    for _ in range(rounds):
        scores = np.stack([np.bincount(row, model.weights[column, k], n * longest)
                           for k in (0, 1)], 1).reshape(n, longest, 2)
        p, moved, _ = _chain(scores, model.moves, model.start, lengths)
        gap = (truth - p).reshape(-1, 2)
        slopes = [np.stack([np.bincount(column, gap[row, k], len(number)) for k in (0, 1)], 1),
                  pair - moved, (truth - p)[:, 0].sum(0)]
        for x, m, slope in zip(parts, memory, slopes):
            slope -= decay * n * x
            m += slope**2
            x += 0.5 * slope / np.sqrt(m)
    return model


def labels_of_marked(blocks: list[Leaf]) -> list[int] | None:
    """Labels of a page that marks its article itself; None if it doesn't."""
    if not any("in:article" in b.inside or "in:main" in b.inside for b in blocks):
        return None
    apart = {"in:nav", "in:header", "in:footer", "in:aside", "in:form", "is:comments", "is:comment",
             "is:ad", "is:advert"}
    return [int(("in:article" in b.inside or "in:main" in b.inside) and apart.isdisjoint(b.inside))
            for b in blocks]


def composed_pages(n: int = 300, seed: int = 11) -> list[tuple[list[Leaf], list[int]]]:
    """Labelled pages put together from parts of common layouts, for what the marked
    pages of a table may lack: sidebars, notices, forms, comments, pages without article."""
    rng = random.Random(seed)

    def said(low: int, high: int, end: str = ".") -> str:
        count = rng.randint(low, high)
        return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9)))
                        for _ in range(count)).capitalize() + end

    def listed(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{said(1, 3, "")}</a></li>' for _ in range(k)) + "</ul>"

    def group(names: str, body: str) -> str:
        tag = rng.choice(["div", "section", "div"])
        return f'<{tag} {rng.choice(["class", "id"])}="{rng.choice(names.split())}">{body}</{tag}>'

    def prose(k: int, tag: str = "p") -> str:
        return "".join(f"<{tag}>{said(3, 60)}</{tag}>" for _ in range(k))

    def wrapped(tag: str, names: str, body: str) -> str:
        return f"<{tag}>{body}</{tag}>" if rng.random() < 0.5 else group(names, body)

    rest = {
        "menu": lambda: wrapped("nav", "nav menu navigation navbar breadcrumb breadcrumbs", listed(rng.randint(2, 8))),
        "header": lambda: wrapped("header", "header site-header masthead top-bar banner",
                                  f"<h1>{said(1, 4, '')}</h1><p>{said(2, 8)}</p>"),
        "footer": lambda: wrapped("footer", "footer site-footer bottom copyright",
                                  rng.choice(["&copy; ", "Copyright ", ""]) + said(2, 20)),
        "sidebar": lambda: wrapped("aside", "sidebar side widget related related-posts recommended "
                                   "trending popular", f"<h3>{said(1, 3, '')}</h3>"
                                   + rng.choice([listed(4), prose(2)])),
        "notice": lambda: group("notice cookie cookie-notice cookie-banner consent gdpr alert "
                                "newsletter subscribe popup modal message", prose(rng.randint(1, 2))),
        "advert": lambda: group("ad ads advert advertisement sponsored promo banner-ad",
                                rng.choice([prose(1), said(2, 20)])),
        "form": lambda: f"<form><label>{said(1, 4, ':')}</label><input><p>{said(1, 12)}</p>"
                        f"<button>{said(1, 2, '')}</button></form>",
        "comments": lambda: group("comments comment-list comment responses replies discussion",
                                  f"<h3>{said(1, 3, '')}</h3>" + "".join(
                                      rng.choice(['<div class="comment">{}</div>', "<li>{}</li>", "{}",
                                                  '<article class="comment">{}</article>']).format(prose(1))
                                      for _ in range(rng.randint(1, 5)))),
        "share": lambda: group("share social tags meta byline-share", listed(3)),
    }

    def main() -> str:
        body = f"<h1>{said(2, 10, '')}</h1>" if rng.random() < 0.8 else ""
        for _ in range(rng.randint(1, 9)):
            body += rng.choice([prose(1), prose(1), prose(1), f"<h2>{said(1, 6, '')}</h2>{prose(1)}",
                                "<ul>" + prose(3, "li") + "</ul>", f"<blockquote>{said(5, 30)}</blockquote>",
                                f'<p>{said(3, 20)} <a href="/y">{said(1, 4, "")}</a> {said(2, 20)}</p>',
                                f"<div>{said(8, 50)}</div>"])
        return body

    pages = []
    for _ in range(n):
        parts = [(rest[k](), 0) for k in ("menu", "header") if rng.random() < 0.8]
        parts += [(rest[k](), 0) for k in ("notice", "advert", "sidebar") if rng.random() < 0.35]
        inner = [(main(), 1)]
        inner += [(rest[k](), 0) for k in ("share", "advert", "form", "sidebar", "comments") if rng.random() < 0.2]
        if rng.random() < 0.2:
            inner.append((prose(2), 1))
        shell = rng.choice(["<article>", "<article>", "<main>", "<main><article>", '<div class="content">',
                            '<div id="main-content">', '<div class="post entry">', '<div class="article-body">',
                            "<div>"])
        ends = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", shell)))
        parts += [(shell, -1), *inner, (ends, -1)]
        parts += [(rest[k](), 0) for k in ("comments", "sidebar", "form", "notice", "advert", "footer")
                  if rng.random() < (0.9 if k == "footer" else 0.3)]
        blocks, labels = [], []
        for at, (markup, label) in enumerate(parts):
            if label >= 0:
                # A part's blocks with the page around it: from the page cut off behind the part.
                upto = leaves("<body>" + "".join(x for x, _ in parts[: at + 1]))
                labels += [label] * (len(upto) - len(labels))
        blocks = leaves("<body>" + "".join(x for x, _ in parts))
        if len(blocks) == len(labels):
            pages.append((blocks, labels))
    return pages


def fitted(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = 200) -> Field:
    """The chain trained on composed pages and on at most ``most`` pages that mark their
    article, those of least hash of the id; the bound holds for the fit alone."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").cast("string").alias("html"))
    ids = rows.where(F.col("html").rlike("(?i)<(article|main)\\b")).select("id").orderBy(
        F.xxhash64("id"), "id").limit(most)
    chosen = rows.join(F.broadcast(ids), "id", "left_semi").select("html").limit(most)
    held = composed_pages()
    for row in sorted(r["html"] or "" for r in chosen.collect()):
        blocks = leaves(row)
        labels = labels_of_marked(blocks)
        if labels is not None:
            held.append((blocks, labels))
    return train(held)


def extracted(pages: DataFrame, model: Field, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """page_id, url, text (empty if none), n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model)  # features of the bounded fit

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [sent.value.text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array([len(x) for x in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                       F.col(f"`{url_col}`").cast("string").alias("url"),
                       F.col(f"`{html_col}`").cast("string").alias("html"))
    return in_arrow(own, lambda: run, "page_id long, url string, text string, n_chars long")

"""Main text of web pages by a recurrent block labeller.

A page is read as a sequence of leaf blocks: runs of text between block-level tags.
Each has the path of its tags with their classes and the words of its text, both hashed
into learned vectors, and a few measures of its shape. A bidirectional LSTM, in numpy,
reads the whole sequence, so every block is labelled with the whole document as context.
Blocks labelled as content, in page order, are the text.

The network is trained here, on pages made by a seeded generator of layouts: menus,
headers, sidebars, notices, adverts, forms, comments and footers, in semantic tags or in
divs with telling classes or ids, around articles in as many forms, with invented words.
Training takes no page of the table, so it does not depend on its size.

Defined results: a null or empty page, and one without any content block, has the empty
text. Broken markup is read as far as it goes; an unclosed comment, script or style ends
the page. Character references are decoded, white space in a block becomes one space,
blocks are joined by a line feed; nothing else is dropped or cut. Other columns stay.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice, takewhile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import slices

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9-]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
LETTERS = re.compile(r"[a-z]+|[A-Z][a-z]*")
WORD = re.compile(r"\w+")

# Elements of HTML by their role in the flow.
RAW = frozenset("script style template noscript svg title textarea iframe object".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mfrac mi mn mo mover mrow ms msqrt mroot msub msubsup msup mtext munder munderover "
    "semantics".split()
)
CLOSES = {  # an opening tag that ends an open element of the same kind
    "p": frozenset("address article aside blockquote details div dl fieldset figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}

MARK = "x-mark"  # bears the labels of generated pages


@dataclass(eq=False, slots=True)
class Element:
    """An element of a path: it knows the one around it, so deep paths are never copied."""

    label: str  # tag and names
    parent: Element | None
    depth: int


@dataclass
class Block:
    element: Element | None  # the innermost one; None outside of all
    text: str
    linked: int  # characters inside links
    marked: bool = False  # inside an element with data-keep (training pages)

    @property
    def depth(self) -> int:
        return self.element.depth if self.element else 0

    @property
    def path(self) -> tuple[str, ...]:
        return tuple(e.label for e in reversed(list(upwards(self.element))))


def upwards(element: Element | None) -> Iterator[Element]:
    while element:
        yield element
        element = element.parent


@dataclass(slots=True)
class Open:
    """An open tag, with what holds for all text inside it."""

    tag: str
    element: Element | None
    marked: bool
    link: bool
    flow: int  # place of the innermost open tag that is not inline, -1 if there is none


def leaf_blocks(page: str | None) -> list[Block]:
    page = page or ""
    stack: list[Open] = []
    count: Counter[str] = Counter()  # of open tags, so an end tag without any looks for none
    outside = Open("", None, False, False, -1)
    blocks: list[Block] = []
    parts: list[str] = []
    linked, at = 0, 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                top = stack[-1] if stack else outside
                blocks.append(Block(top.element, text, linked, top.marked))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if stack and stack[-1].link:
                linked += len(text.strip())

    def end(i: int) -> None:
        count.subtract(x.tag for x in stack[i:])
        del stack[i:]

    while m := TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, ends, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag not in INLINE and tag not in RAW:
            close()
        elif tag == "br":
            parts.append(" ")
        if ends:
            if count[tag] > 0:
                end(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                last = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = last.end() if last else len(page)
            continue
        for open_tag, by in CLOSES.items():
            if tag in by and stack and (i := stack[-1].flow) >= 0 and stack[i].tag == open_tag:
                end(i)
        if tag not in VOID:
            names = " ".join(x for found in NAMES.findall(attributes) for x in found if x)
            top = stack[-1] if stack else outside
            element = top.element
            if tag != MARK:
                depth = element.depth + 1 if element else 1
                element = Element(f"{tag} {names}" if names else tag, element, depth)
            marked = top.marked or "data-keep" in attributes
            flow = top.flow if tag in INLINE else len(stack)
            stack.append(Open(tag, element, marked, top.link or tag == "a", flow))
            count[tag] += 1
    add(page[at:])
    close()
    return blocks


BUCKETS, WORDS, EMBED, HIDDEN, SHAPE = 1024, 2048, 16, 20, 7
INPUT = 3 * EMBED + SHAPE


def _bucket(token: str, n: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % n


@lru_cache(maxsize=50_000)
def _element_ids(label: str) -> tuple[int, ...]:
    """Hashed tokens of an element."""
    tag, _, names = label.partition(" ")
    tokens = ["<" + tag, *(x.lower() for x in LETTERS.findall(names))]
    return tuple(_bucket(t, BUCKETS) for t in tokens)


def _path_ids(element: Element | None, most: int | None = None) -> list[int]:
    """Hashed tokens of the innermost elements of a path, the outermost first."""
    each = [_element_ids(e.label) for e in islice(upwards(element), most)]
    return [x for e in reversed(each) for x in e] or [0]


def _path_sums(elements: list[Element | None], vectors: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Sum and number of the vectors of each element's path, every element added once."""
    known: dict[Element | None, tuple[np.ndarray, int]] = {None: (np.zeros_like(vectors[0]), 0)}
    for element in elements:
        new = list(takewhile(lambda e: e not in known, upwards(element)))
        for e in reversed(new):
            total, n = known[e.parent]
            total = total.copy()
            for x in _element_ids(e.label):
                total += vectors[x]
                n += 1
            known[e] = total, n
        total, n = known[element]
        yield (total, n) if n else (vectors[0], 1)


@lru_cache(maxsize=200_000)
def _word_id(word: str) -> int:
    return _bucket(word, WORDS)


def _shape(block: Block, i: int, n: int) -> list[float]:
    size = len(block.text)
    words = block.text.count(" ") + 1
    marks = sum(block.text.count(c) for c in ".,;:!?")
    return [
        np.log1p(words) / 4,
        min(1.0, block.linked / size),
        min(1.0, 5 * marks / size),
        size / words / 10,
        (i + 1) / n,
        1.0 if block.text[-1] in ".!?…:;\"'»”" else 0.0,
        block.depth / 10,
    ]


class Labeller:
    """Embeddings, two LSTMs and an output layer."""

    def __init__(self, seed: int = 1) -> None:
        r = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (r.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "paths": normal(BUCKETS, EMBED, scale=0.3),
            "words": normal(WORDS, EMBED, scale=0.05),
            "out": normal(2 * HIDDEN, scale=0.2),
            "out_bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.p[f"w{side}"] = normal(INPUT, 4 * HIDDEN, scale=INPUT**-0.5)
            self.p[f"u{side}"] = normal(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.p[f"b{side}"] = bias

    def ids(self, blocks: list[Block]) -> list[tuple]:
        out = []
        for i, b in enumerate(blocks):
            near = np.array(_path_ids(b.element, 4))
            found = WORD.findall(b.text.lower())
            hashed = np.array([_word_id(w) for w in found] or [0])
            out.append((b.element, near, hashed, np.array(_shape(b, i, len(blocks)), np.float32)))
        return out

    def inputs(self, ids: list[tuple]) -> np.ndarray:
        paths, words = self.p["paths"], self.p["words"]
        x = np.empty((len(ids), INPUT), np.float32)
        sums = _path_sums([element for element, *_ in ids], paths)
        for i, ((total, n), (_, near, hashed, shape)) in enumerate(zip(sums, ids)):
            x[i, :EMBED] = total / n
            x[i, EMBED : 2 * EMBED] = paths[near].mean(0)
            x[i, 2 * EMBED : 3 * EMBED] = words[hashed].mean(0)
            x[i, 3 * EMBED :] = shape
        return x

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool):
        """Hidden states (batch, time, HIDDEN); padding passes the state through."""
        n, times, _ = x.shape
        u = self.p[f"u{side}"]
        given = x @ self.p[f"w{side}"] + self.p[f"b{side}"]
        h = np.zeros((n, HIDDEN), np.float32)
        c = np.zeros((n, HIDDEN), np.float32)
        out, tape = np.empty((n, times, HIDDEN), np.float32), []
        order = range(times) if side == "f" else range(times - 1, -1, -1)
        for t in order:
            z = given[:, t] + h @ u
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            c_new = m * (f * c + i * g) + (1 - m) * c
            squashed = np.tanh(c_new)
            h_new = m * (o * squashed) + (1 - m) * h
            if keep:
                tape.append((t, i, f, o, g, c, h, squashed, m))
            h, c = h_new, c_new
            out[:, t] = h
        return out, tape

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = [self._run(x, mask, side, keep=False)[0] for side in "fb"]
        return np.concatenate(states, 2) @ self.p["out"] + self.p["out_bias"]

    def gradients(self, pages: list[list[tuple]], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        p = self.p
        x, mask = _padded([self.inputs(ids) for ids in pages])
        y = np.zeros(mask.shape, np.float32)
        for k, found in enumerate(labels):
            y[k, : len(found)] = found
        runs = {side: self._run(x, mask, side, keep=True) for side in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], 2)
        score = 1 / (1 + np.exp(-(both @ p["out"] + p["out_bias"])))
        error = (score - y) * mask / mask.sum()
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["out_bias"] = np.einsum("nt,nth->h", error, both), error.sum(keepdims=True)[0]
        d_both = error[:, :, None] * p["out"]
        dx = np.zeros_like(x)
        for side, d_out in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[:, :, HIDDEN:])):
            dh = np.zeros((len(x), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, i, f, o, cand, c, h, squashed, m in reversed(runs[side][1]):
                dh = dh + d_out[:, t]
                live = dh * m
                dc_live = dc * m + live * o * (1 - squashed**2)
                dz = np.concatenate(
                    [
                        dc_live * cand * i * (1 - i),
                        dc_live * c * f * (1 - f),
                        live * squashed * o * (1 - o),
                        dc_live * i * (1 - cand**2),
                    ],
                    1,
                )
                g[f"w{side}"] += x[:, t].T @ dz
                g[f"u{side}"] += h.T @ dz
                g[f"b{side}"] += dz.sum(0)
                dx[:, t] += dz @ p[f"w{side}"].T
                dh = dz @ p[f"u{side}"].T + dh * (1 - m)
                dc = dc_live * f + dc * (1 - m)
        for k, ids in enumerate(pages):
            for t, (element, near, hashed, _) in enumerate(ids):
                d, far = dx[k, t], _path_ids(element)
                np.add.at(g["paths"], far, d[:EMBED] / len(far))
                np.add.at(g["paths"], near, d[EMBED : 2 * EMBED] / len(near))
                np.add.at(g["words"], hashed, d[2 * EMBED : 3 * EMBED] / len(hashed))
        return g

    def fit(self, pages: list[str], epochs: int = 6, batch: int = 16, rate: float = 0.01) -> None:
        read = [b for b in map(leaf_blocks, pages) if b]
        ids = [self.ids(b) for b in read]
        labels = [np.array([x.marked for x in b], np.float32) for b in read]
        r = np.random.default_rng(2)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, steps = 0, epochs * -(-len(ids) // batch)
        for _ in range(epochs):
            order = r.permutation(len(ids))
            for a in range(0, len(ids), batch):
                pick = order[a : a + batch]
                g = self.gradients([ids[k] for k in pick], [labels[k] for k in pick])
                step += 1
                now = rate * (1 - step / (steps + 1))
                for k, d in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.99 * v[k] + 0.01 * d * d
                    self.p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)

    def content(self, pages: list[list[Block]], at_once: int = 60_000) -> list[np.ndarray]:
        """For each page, which of its blocks are content."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        group: list[int] = []
        for n, k in enumerate(order):
            group.append(k)
            following = order[n + 1] if n + 1 < len(order) else None
            if following is None or (len(group) + 1) * len(pages[following]) > at_once:
                logits = self.logits(*_padded([self.inputs(self.ids(pages[j])) for j in group]))
                for row, j in zip(logits, group):
                    out[j] = row[: len(pages[j])] > 0
                group = []
        return out


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, rows))
    x = np.zeros((len(rows), longest, INPUT), np.float32)
    mask = np.zeros((len(rows), longest), np.float32)
    for k, row in enumerate(rows):
        x[k, : len(row)] = row
        mask[k, : len(row)] = 1
    return x, mask


_trained: dict[tuple[int, int], Labeller] = {}


def trained_labeller(pages: int = 1200, seed: int = 4) -> Labeller:
    """The labeller, trained once per process on generated pages."""
    from .html_layouts import layouts

    if (pages, seed) not in _trained:
        labeller = Labeller()
        labeller.fit(layouts(pages, seed))
        _trained[pages, seed] = labeller
    return _trained[pages, seed]


def extract_text(
    pages: DataFrame,
    labeller: Labeller | None = None,
    html_column: str = "html",
    text_column: str = "text",
) -> DataFrame:
    """``pages`` without the markup column, with the main text of each."""
    model = labeller or trained_labeller()

    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = [x or "" for x in batch]
            out: list[str] = []
            for part in slices(values, 2_000_000):
                read = [leaf_blocks(x) for x in values[part]]
                for blocks, keep in zip(read, model.content(read)):
                    out.append("\n".join(b.text for b, k in zip(blocks, keep) if k))
            yield pd.Series(out, dtype=object)

    return pages.withColumn(text_column, main_text(F.col(html_column))).drop(
        *([html_column] if html_column != text_column else [])
    )

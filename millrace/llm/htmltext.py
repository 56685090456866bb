"""Main text of web pages: a recurrent block labeller.

A page becomes a sequence of leaf blocks. Each block is described by its tag path (tags, class and id words of its
ancestors), its hashed words, and a few lengths; a bidirectional LSTM reads the sequence in both directions, so every
block is judged with the whole page in view. The labeller is trained here, in numpy, on a bounded sample of pages that
are rebuilt with menus, notices, comments and so on in many mark-ups around their text.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import sampled, small_batches

# Fixed values of HTML: elements whose text is never shown, void elements, and elements that make a block of their own.
HIDDEN = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "html", "label", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "textarea", "tfoot", "th", "thead", "tr", "ul"}
CLOSED_BY_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)[a-zA-Z])")
NAME_END = re.compile(r"[\s/>]")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass(eq=False)
class Element:
    """An open element: what it adds to the words of those around it, so that a path costs no more than its own words."""

    around: Element | None
    fresh: list[str]  # words that no element around it has
    last: str
    words: int  # on the whole path, repeats included


@dataclass
class Block:
    path: Element | None
    text: str
    linked: int = 0


def tag_ends(page: str) -> tuple[list[int], list[int]]:
    """The places of > and quotes, and where a tag ends that comes to each of them outside of quotes (-1: nowhere).

    Found from the page's end backwards, once, so that tags that never end cost no search of their own.
    """
    places = [m.start() for m in re.finditer("[>\"']", page)]
    ends, same = [-1] * (len(places) + 1), {}
    for i in range(len(places) - 1, -1, -1):
        c = page[places[i]]
        if c == ">":
            ends[i] = places[i] + 1
        else:
            ends[i] = ends[same[c] + 1] if c in same else -1
            same[c] = i
    return places, ends


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in page order: character references decoded, white space made one space, trimmed.

    The work grows with the page's length, however broken or deep its mark-up is.
    """
    found: list[Block] = []
    stack: list[tuple[str, Element]] = []
    opened: Counter[str] = Counter()
    seen: set[str] = set()
    parts: list[str] = []
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            if text := " ".join(entities.unescape("".join(parts)).split()):
                found.append(Block(stack[-1][1] if stack else None, text, linked))
            parts.clear()
        linked = 0

    def pop() -> str:
        name, element = stack.pop()
        opened[name] -= 1
        seen.difference_update(element.fresh)
        return name

    page = page or ""
    places, ends = tag_ends(page)
    at = look = name_end = 0
    while True:
        m = OPENING.search(page, look)
        close, name, rest, end = "", "", "", len(page)
        if m and m[1]:
            end = page.find("-->", m.end()) + 3
        elif m and m[2]:
            end = page.find(">", m.end()) + 1
        elif m:
            if name_end < m.end():
                name_end = t.start() if (t := NAME_END.search(page, m.end())) else len(page)
            end = ends[bisect_left(places, name_end)]
            if end < 0:  # no tag: text
                look = m.end()
                continue
            close, name, rest = m[3], page[m.end() - 1 : name_end].lower(), page[name_end : end - 1]
        if m and end < m.end():  # never closed
            end = len(page)
        if chunk := page[at : m.start() if m else len(page)]:
            parts.append(chunk)
            linked += len(chunk) if in_link else 0
        if m is None:
            break
        at = look = end
        if not name:
            continue
        if name in HIDDEN and not close:
            if not rest.endswith("/"):
                shut = re.compile(rf"</{re.escape(name)}\s*>" if name != "head" else r"</head\s*>|(?=<body[\s>])", re.I).search(page, at)
                at = look = shut.end() if shut else len(page)
        elif name == "a":
            in_link = 0 if close else 1
        elif name in VOID:
            parts.append(" ")
        elif name in BLOCKS:
            flush()
            if close:
                if opened[name]:
                    while pop() != name:
                        pass
                    in_link = 0
            else:
                while stack and stack[-1][0] in CLOSED_BY_ITSELF.get(name, ()):
                    pop()
                words = [f"<{name}>", *(w for n in NAMES.findall(rest) for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(n)).lower()))]
                around = stack[-1][1] if stack else None
                fresh = [w for w in dict.fromkeys(words) if w not in seen]
                seen.update(fresh)
                opened[name] += 1
                stack.append((name, Element(around, fresh, words[-1], len(words) + (around.words if around else 0))))
    flush()
    return found


# --- features -------------------------------------------------------------------------------------------------------

PATH_BITS, WORD_BITS = 11, 10
STEPS = 1024  # blocks of a sequence whose inputs are multiplied at a time
CELLS = 30_000  # blocks, with padding, of the pages that are labelled together; a longer page goes alone
NUMBERS = 6


@dataclass
class Sequence:
    """One page: its elements, each after the one around it, with the hashed words that each adds; per block its element,
    the hash of the leaf, the number of distinct words on its path, its hashed words and its numbers."""

    around: list[int]
    added: list[np.ndarray]
    element: np.ndarray
    leaf: np.ndarray
    path_n: np.ndarray
    word: np.ndarray
    word_n: np.ndarray
    number: np.ndarray
    label: np.ndarray = field(default_factory=lambda: np.empty(0))

    def __len__(self) -> int:
        return len(self.path_n)


def _hash(text: str, bits: int) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) >> (32 - bits)


def sequence(page: list[Block]) -> Sequence:
    number_of: dict[Element | None, int] = {None: 0}
    around, added, distinct = [0], [np.empty(0, np.int64)], [0]
    element, leaf, path_n, word, word_n, number = [], [], [], [], [], []
    for b in page:
        new, e = [], b.path
        while e not in number_of:
            new.append(e)
            e = e.around
        for e in reversed(new):
            number_of[e] = len(around)
            around.append(number_of[e.around])
            added.append(np.array([_hash(w, PATH_BITS) for w in e.fresh], np.int64))
            distinct.append(distinct[around[-1]] + len(e.fresh))
        at = number_of[b.path]
        element.append(at)
        leaf.append(_hash("leaf " + b.path.last if b.path else "leaf", PATH_BITS))
        path_n.append(distinct[at] + 1)
        words = b.text.split()
        word += [_hash(w, WORD_BITS) for w in words]
        word_n.append(len(words))
        n = len(b.text)
        number.append((np.log1p(n) / 6, min(1.0, b.linked / n), np.log1p(len(words)) / 5, (b.text[-1] in ".!?") * 1.0, sum(c in ".,;:" for c in b.text) / n * 20, (b.path.words if b.path else 0) / 10))
    whole = lambda x: np.array(x, np.int64)
    return Sequence(around, added, whole(element), whole(leaf), whole(path_n), whole(word), whole(word_n), np.array(number, np.float64).reshape(-1, NUMBERS))


# --- the network ----------------------------------------------------------------------------------------------------


def _mean_rows(table: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = np.zeros((len(n), table.shape[1]))
    if len(at):
        np.add.at(total, np.repeat(np.arange(len(n)), n), table[at]) if len(at) < 64 else total.__iadd__(np.stack([np.bincount(np.repeat(np.arange(len(n)), n), table[at, j], len(n)) for j in range(table.shape[1])], axis=1))
    return total / np.maximum(n, 1)[:, None]


def _mean_paths(table: np.ndarray, s: Sequence) -> np.ndarray:
    """Per block the mean row of the distinct words on its path and of its leaf; sums pass from each element to those within."""
    total = np.zeros((len(s.around), table.shape[1]))
    for k in range(1, len(total)):
        total[k] = total[s.around[k]]
        for w in s.added[k]:
            total[k] += table[w]
    return (total[s.element] + table[s.leaf]) / s.path_n[:, None]


def _path_gradient(grad: np.ndarray, s: Sequence, d: np.ndarray) -> None:
    """Add to grad what _mean_paths passes back, given the gradient of its result."""
    d = d / s.path_n[:, None]
    np.add.at(grad, s.leaf, d)
    total = np.zeros((len(s.around), d.shape[1]))
    np.add.at(total, s.element, d)
    for k in range(len(total) - 1, 0, -1):
        np.add.at(grad, s.added[k], total[k])
        total[s.around[k]] += total[k]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Labeller:
    """Embeddings, one LSTM cell per direction, and a logistic layer; all weights in one dict."""

    weights: dict[str, np.ndarray]
    hidden: int

    @classmethod
    def new(cls, hidden: int = 20, path_size: int = 12, word_size: int = 6, seed: int = 5) -> Labeller:
        random = np.random.default_rng(seed)
        size = path_size + word_size + NUMBERS
        w = {"path": random.normal(0, 0.3, (1 << PATH_BITS, path_size)), "word": random.normal(0, 0.1, (1 << WORD_BITS, word_size)), "out": random.normal(0, 0.2, 2 * hidden + size), "bias": np.zeros(1)}
        for d in ("ahead", "back"):
            w[d] = random.normal(0, 1 / np.sqrt(size + hidden), (size + hidden + 1, 4 * hidden))
            w[d][-1, hidden : 2 * hidden] = 1.0  # forget gates start open
        return cls(w, hidden)

    def inputs(self, pages: list[Sequence]) -> tuple[np.ndarray, np.ndarray]:
        """Padded inputs (time, page, size) and the mask of real blocks."""
        longest = max(map(len, pages))
        size = self.weights["out"].shape[0] - 2 * self.hidden
        x, mask = np.zeros((longest, len(pages), size)), np.zeros((longest, len(pages)))
        for i, p in enumerate(pages):
            x[: len(p), i] = np.hstack([_mean_paths(self.weights["path"], p), _mean_rows(self.weights["word"], p.word, p.word_n), p.number])
            mask[: len(p), i] = 1
        return x, mask

    def run(self, x: np.ndarray, mask: np.ndarray, name: str, keep: bool = False) -> tuple[np.ndarray, list]:
        """Hidden states of one direction; the backward one starts at each page's last real block."""
        steps = range(len(x)) if name == "ahead" else range(len(x) - 1, -1, -1)
        n, h = x.shape[1], self.hidden
        state, cell = np.zeros((n, h)), np.zeros((n, h))
        out, tape, w = np.zeros((len(x), n, h)), [], self.weights[name]
        for k, t in enumerate(steps):
            if k % STEPS == 0:  # what the inputs drive, for the next steps
                lo = t if name == "ahead" else max(0, t - STEPS + 1)
                drive = x[lo : lo + STEPS] @ w[: x.shape[2]] + w[-1]
            z = drive[t - lo] + state @ w[x.shape[2] : -1]
            i, f, o, g = _sigmoid(z[:, :h]), _sigmoid(z[:, h : 2 * h]), _sigmoid(z[:, 2 * h : 3 * h]), np.tanh(z[:, 3 * h :])
            m = mask[t][:, None]
            new = f * cell + i * g
            if keep:
                tape.append((t, state, cell, i, f, o, g, new))
            cell = m * new + (1 - m) * cell
            state = m * (o * np.tanh(new)) + (1 - m) * state
            out[t] = state
        return out, tape

    def chance(self, pages: list[Sequence]) -> list[np.ndarray]:
        """Per page, the chance of every block to be main text."""
        x, mask = self.inputs(pages)
        both = np.concatenate([self.run(x, mask, "ahead")[0], self.run(x, mask, "back")[0], x], axis=2)
        p = _sigmoid(both @ self.weights["out"] + self.weights["bias"])
        return [p[: len(s), i] for i, s in enumerate(pages)]

    def gradients(self, pages: list[Sequence]) -> dict[str, np.ndarray]:
        x, mask = self.inputs(pages)
        h, size = self.hidden, x.shape[2]
        (ahead, tape_a), (back, tape_b) = self.run(x, mask, "ahead", True), self.run(x, mask, "back", True)
        both = np.concatenate([ahead, back, x], axis=2)
        y = np.zeros(mask.shape)
        for i, s in enumerate(pages):
            y[: len(s), i] = s.label
        d = (_sigmoid(both @ self.weights["out"] + self.weights["bias"]) - y) * mask / mask.sum()
        grad = {"out": np.einsum("tn,tnk->k", d, both), "bias": d.sum().reshape(1)}
        d_both = d[:, :, None] * self.weights["out"]
        d_x = d_both[:, :, 2 * h :].copy()
        for name, tape, at in (("ahead", tape_a, 0), ("back", tape_b, h)):
            w, g_w = self.weights[name], np.zeros_like(self.weights[name])
            d_state, d_cell = np.zeros((x.shape[1], h)), np.zeros((x.shape[1], h))
            for t, state, cell, i, f, o, g, new in reversed(tape):
                m = mask[t][:, None]
                d_state = d_state + d_both[t][:, at : at + h]
                top, squashed = d_state * m, np.tanh(new)
                d_new = d_cell * m + top * o * (1 - squashed**2)
                z = np.concatenate([d_new * g * i * (1 - i), d_new * cell * f * (1 - f), top * squashed * o * (1 - o), d_new * i * (1 - g**2)], axis=1)
                g_w[:size] += x[t].T @ z
                g_w[size:-1] += state.T @ z
                g_w[-1] += z.sum(axis=0)
                d_x[t] += z @ w[:size].T
                d_state = z @ w[size:-1].T + d_state * (1 - m)
                d_cell = d_new * f + d_cell * (1 - m)
            grad[name] = g_w
        lo = self.weights["path"].shape[1]
        hi = lo + self.weights["word"].shape[1]
        grad["path"], grad["word"] = np.zeros_like(self.weights["path"]), np.zeros_like(self.weights["word"])
        for i, s in enumerate(pages):
            _path_gradient(grad["path"], s, d_x[: len(s), i, :lo])
            np.add.at(grad["word"], s.word, np.repeat(d_x[: len(s), i, lo:hi] / np.maximum(s.word_n, 1)[:, None], s.word_n, axis=0))
        return grad

    def fit(self, pages: list[Sequence], *, rounds: int = 6, batch: int = 24, rate: float = 0.02, seed: int = 3) -> Labeller:
        """Adam over shuffled batches of pages of like length."""
        random = np.random.default_rng(seed)
        first, second, step = ({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2)), None, 0
        first, second = first
        by_length = sorted((p for p in pages if len(p)), key=len)
        groups = [by_length[i : i + batch] for i in range(0, len(by_length), batch)]
        for _ in range(rounds):
            for k in random.permutation(len(groups)):
                step += 1
                for name, g in self.gradients(groups[k]).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g**2
                    self.weights[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
        return self


# --- training pages -------------------------------------------------------------------------------------------------

# How pages commonly name their main text and what stands around it. {} takes the text.
MAIN = ["<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "<div id='main-content'>{}</div>", "<section class='post-body'>{}</section>", "<div class='entry-content'>{}</div>", "<article class='post'><div class='article-body'>{}</div></article>", "<main role='main'><article>{}</article></main>", "<div class='story'>{}</div>", "<div id='article'>{}</div>", "<div>{}</div>", "<td class='text'>{}</td>"]
AROUND = {
    "menu": ["<nav><ul>{li}</ul></nav>", "<div class='menu'>{li}</div>", "<ul class='nav navbar'>{li}</ul>", "<div id='navigation' role='navigation'>{li}</div>", "<div class='breadcrumbs'>{li}</div>", "<nav class='pagination'>{li}</nav>", "<div class='toc'>{li}</div>", "<div class='tags'>{li}</div>"],
    "header": ["<header><h1>{s}</h1><p>{s}</p></header>", "<header>{s}</header>", "<div class='site-header'><p>{s}</p></div>", "<div id='header'><h2>{s}</h2></div>", "<div id='masthead' role='banner'>{s}</div>", "<div class='topbar'>{s}</div>"],
    "footer": ["<footer>&copy; {s}</footer>", "<footer><p>{p}</p></footer>", "<div class='footer'><p>{p}</p></div>", "<div id='footer'>{s}</div>", "<div class='copyright'>{s}</div>", "<div class='site-footer'><ul>{li}</ul></div>", "<div role='contentinfo'>{p}</div>"],
    "sidebar": ["<aside><h3>{s}</h3><p>{p}</p></aside>", "<aside>{p}</aside>", "<aside class='sidebar'><ul>{li}</ul></aside>", "<div class='sidebar'><p>{p}</p></div>", "<div id='sidebar'><h4>{s}</h4><ul>{li}</ul></div>", "<div class='widget'>{p}</div>", "<div class='related-posts'><h3>{s}</h3><ul>{li}</ul></div>", "<section class='recommended'>{li}</section>", "<div role='complementary'>{p}</div>"],
    "notice": ["<div class='cookie-notice'><p>{p}</p></div>", "<div class='cookie-banner'>{p}<button>{s}</button></div>", "<div id='consent'>{p}</div>", "<div class='notice'><p>{p}</p></div>", "<div class='alert'>{p}</div>", "<div class='popup modal'><p>{p}</p></div>", "<div class='gdpr'>{s}</div>", "<div class='newsletter'><p>{s}</p></div>", "<div role='alert'>{p}</div>", "<dialog><p>{p}</p></dialog>", "<p class='disclaimer'>{p}</p>"],
    "advert": ["<div class='ad'>{p}</div>", "<div class='ads'><p>{p}</p></div>", "<div class='advert'><p>{p}</p></div>", "<div class='advertisement'>{s}</div>", "<div id='sponsor'>{p}</div>", "<div class='sponsored'><p>{p}</p></div>", "<section class='promo'><h3>{s}</h3><p>{p}</p></section>", "<div class='banner'>{p}</div>", "<p class='ad'>{p}</p>"],
    "form": ["<form><label>{s}</label><input name='q'><button>{s}</button></form>", "<form class='search'>{s}<input></form>", "<form id='login'><p>{s}</p><select><option>{s}</option><option>{s}</option></select></form>", "<div class='subscribe'><form><p>{p}</p><button>{s}</button></form></div>", "<fieldset><legend>{s}</legend><textarea>{s}</textarea></fieldset>"],
    "comments": ["<div class='comments'><h3>{s}</h3><p>{p}</p><p>{p}</p></div>", "<section id='comments'><article class='comment'><p>{p}</p></article><article class='comment'><p>{p}</p></article></section>", "<ol class='comment-list'><li class='comment'>{p}</li><li class='comment'>{p}</li></ol>", "<div class='comment'><div class='comment-body'><p>{p}</p></div></div>", "<ul class='replies'><li class='reply'>{p}</li></ul>", "<div id='disqus'><p>{p}</p></div>", "<section class='reader-comments'><div class='comment'>{p}</div><p>{p}</p></section>", "<div class='reviews'><p>{p}</p></div>"],
    "share": ["<div class='share'><a href='#'>{s}</a> <a href='#'>{s}</a></div>", "<div class='social'>{s}</div>", "<div class='byline author'>{s}</div>", "<div class='meta'>{s}</div>"],
}
LINKS = ["<li><a href='#'>{}</a></li>", "<div><a href='#'>{}</a></div>", "<p><a href='#'>{}</a></p>", "<a href='#'>{}</a> ", "<span><a href='#'>{}</a></span> "]
DIGITS = str.maketrans("0123456789", "ghijklmnop")  # names of letters
MARK = "\ue000"  # stands before every main text of a rebuilt page


def rebuilt(texts: list[str], random: np.random.Generator) -> str:
    """A page of the given texts in random mark-up: main text, each block behind MARK, and what stands around it."""
    pick = lambda xs: xs[random.integers(len(xs))]

    def phrase(lo: int, hi: int) -> str:
        words = pick(texts).split() or ["x"]
        at, n = random.integers(len(words)), random.integers(lo, hi)
        return entities.escape(" ".join(words[at : at + n]))

    def around() -> str:
        shape = pick(AROUND[pick(list(AROUND))])
        while "{" in shape:
            link = pick(LINKS) if "<ul" not in shape and "<ol" not in shape else LINKS[0]
            shape = shape.replace("{li}", "".join(link.format(phrase(1, 4)) for _ in range(random.integers(2, 8))), 1)
            shape = shape.replace("{s}", phrase(1, 9), 1).replace("{p}", phrase(3, 60), 1)
        return renamed(shape)

    def renamed(shape: str) -> str:  # some pages have names of their own: tags, links and words must do
        return re.sub(r"(class|id)='[^']*'", lambda m: f"{m[1]}='{random.integers(1 << 30):x}'".translate(DIGITS), shape) if random.random() < 0.25 else shape

    inner = []
    for i in range(random.integers(1, 12)):
        kind = random.random()
        text = MARK + phrase(1, 90 if kind < 0.8 else 6)
        shape = "<h1>{}</h1>" if i == 0 and kind < 0.7 else "<h2>{}</h2>" if kind < 0.08 else "<ul><li>{}</li></ul>" if kind < 0.14 else "<blockquote><p>{}</p></blockquote>" if kind < 0.18 else "<div>{}</div>" if kind < 0.22 else "<p><b>{}</b></p>" if kind < 0.3 else "<p>{}</p>"
        inner.append(shape.format(text))
        if random.random() < 0.08:
            inner.append(around())
    before, after = ("".join(around() for _ in range(random.integers(0, 4))) for _ in range(2))
    wrap = random.random()
    main = renamed(pick(MAIN)).format("".join(inner))
    body = before + main + after
    if random.random() < 0.12:  # laid out in a table
        body = "<table><tr>" + "".join(f"<td>{x}</td>" for x in (before, main, after) if x) + "</tr></table>"
    body = f"<div class='container'>{body}</div>" if wrap < 0.2 else f"<div id='page'><div class='row'>{body}</div></div>" if wrap < 0.3 else body
    return f"<html><body>{body}</body></html>"


def training_sequences(pages: list[str], rounds: int = 3, seed: int = 11) -> list[Sequence]:
    random, out = np.random.default_rng(seed), []
    own = [[b.text for b in blocks(p)] for p in pages]
    own = [t for t in own if t] or [["a text of a few words", "home"]]  # pages without any text
    for _ in range(rounds):
        for texts in own:
            page = blocks(rebuilt([t.replace(MARK, "") or "x" for t in texts], random))
            label = np.array([b.text.startswith(MARK) for b in page], float)
            for b in page:
                b.text = b.text.replace(MARK, "").strip() or "x"
            s = sequence(page)
            s.label = label
            out.append(s)
    return out


# --- Spark ----------------------------------------------------------------------------------------------------------


def fit(pages: DataFrame, *, key: str = "page_id", html: str = "html", bound: int = 300, longest: int = 50_000, rounds: int = 4) -> Labeller:
    """Train on pages rebuilt from about `bound` of the given ones, chosen by a hash of key; pages of over `longest`
    characters are not trained on. Both bound the sample alone: extraction takes every page whole."""
    rows = pages.where(F.col(html).isNotNull() & (F.length(html) <= longest))
    picked = sampled(rows.select(F.col(key).alias("k"), F.col(html).alias("h")), F.col("k"), rows.count(), bound)
    got = sorted((r["k"] if r["k"] is not None else -1, r["h"]) for r in picked.collect())
    return Labeller.new().fit(training_sequences([h for _, h in got] * max(1, 150 // max(1, len(got)))), rounds=rounds)


def main_texts(model: Labeller, pages: list[str | None], cells: int = CELLS, least: float = 0.5) -> list[str]:
    """The main text of every page: its blocks of a chance over `least`, in page order."""
    found = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, b in enumerate(found) if b), key=lambda i: len(found[i]))
    while order:
        n = max(1, cells // max(1, len(found[order[-1]])))  # the longest that are left
        order, part = order[:-n], order[-n:]
        for i, p in zip(part, model.chance([sequence(found[i]) for i in part])):
            out[i] = "\n".join(b.text for b, x in zip(found[i], p) if x > least)
    return out


def extract(pages: DataFrame, model: Labeller, *, html: str = "html", out: str = "text") -> DataFrame:
    """pages with the main text as column `out` (replaced if there). Null or blank html gives an empty text."""
    small_batches(pages.sparkSession)
    shipped = pages.sparkSession.sparkContext.broadcast(model)  # fixed size, under 1 MB

    @F.pandas_udf("string")
    def answer(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([t for k in range(0, len(part), 512) for t in main_texts(shipped.value, part.iloc[k : k + 512].tolist())], dtype=object)

    return pages.drop(out).withColumn(out, answer(F.col(html)))

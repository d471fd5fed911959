"""Main-text extraction by a recurrent block labeller.

A page becomes its sequence of leaf blocks: runs of text between block-level
tags, each with its tag path (names, classes and ids of the open elements) and
its words. A bidirectional LSTM in numpy reads the hashed path and word
vectors of the whole sequence and labels every block, so what stands before
and after a block counts. The text of the blocks labelled main is the result.

Training. The network is trained on the driver from a bounded sample of pages:
their blocks, silver-labelled by structural elements (article and main against
navigation, headers, footers, asides, forms and the like), and the same texts
set into generated page skeletons with menus, sidebars, notices, adverts,
forms and reader comments under many names, so that it does not lean on the
markup of one site. Everything else covers all pages; there is no shuffle.
"""

from __future__ import annotations

import functools
import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.llm.common import read_table, register


@dataclass(frozen=True)
class Params:
    """``pages`` of at most ``page_chars`` characters are trained on, in order
    of a hash of the id, and on ``skeletons`` generated ones of their texts.
    Of the pages, those of more than ``page_blocks`` blocks give their texts to
    the skeletons alone; all pages are labelled, whatever their blocks. ``paths``
    and ``words`` are hash sizes, ``width`` that of a hashed vector, ``hidden``
    of each direction."""

    pages: int = 300
    page_chars: int = 100_000
    page_blocks: int = 400
    skeletons: int = 900
    paths: int = 1024
    words: int = 1024
    width: int = 16
    hidden: int = 24
    epochs: int = 8
    rate: float = 0.01
    seed: int = 11


BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li link main menu meta nav noscript object ol
optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul video audio canvas svg template""".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template svg".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# an opening tag closes these, if they are the innermost open block
CLOSES = {"p": ("p",), "li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BREAKS_P = BLOCK_TAGS - frozenset("body button caption head html iframe link meta object option optgroup td th tr tbody thead tfoot title".split())

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NAME = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Block:
    """A leaf block: its text, the names on its path from the outermost in,
    and the share of its characters that stand in links."""

    text: str
    path: tuple[str, ...]
    linked: float


def blocks(page: str, size: int = Params.paths) -> list[Block]:
    """Leaf blocks of a page in order; raw elements (scripts, styles, titles
    and so on) and comments have none. Character references are decoded, white
    space in a block is one space. A path has the names of all open elements:
    the innermost 64 as they stand, of those further out each once. Of outer
    names with the same hash (to ``size``) the labeller needs one; those that
    labels by structure know all stay."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], dict]] = [("", (), {})]  # tag, inner names, outer names by key
    text: list[str] = []
    linked, links = 0, 0

    def close() -> None:
        nonlocal linked
        said = " ".join(html.unescape("".join(text)).split())
        if said:
            _, inner, outer = stack[-1]
            path = tuple(x for x in outer.values() if x not in inner) + inner if outer else inner
            out.append(Block(said, path, min(1.0, linked / len(said))))
        text.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text.append(raw)
        if links:
            linked += len(raw.strip())

    at = 0
    while True:
        m = _MARKUP.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if m[1] is not None:
            say(m[1].replace("&", "&amp;"))
            continue
        if m[3] is None:
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if m[5] == "" and m.end() == len(page):
            break  # the page ends inside a tag
        if not closing and tag in RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            if tag in BLOCK_TAGS:
                close()
            at = end.end() if end else len(page)
            continue
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        elif tag in ("br", "wbr", "hr") or tag not in BLOCK_TAGS:
            if tag == "hr":
                close()
            elif tag == "br":
                text.append(" ")
            continue
        if tag not in BLOCK_TAGS:
            continue
        close()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    links = 0 if tag not in ("li", "p", "span") else links
                    break
        elif tag not in VOID_TAGS:
            while len(stack) > 1 and (stack[-1][0] in CLOSES.get(tag, ()) or stack[-1][0] == "p" and tag in BREAKS_P):
                stack.pop()
            names = [tag]
            for name, value in _NAMED.findall(m[4]):
                names += [f"{tag}.{x}" for x in _NAME.findall(value.lower())] + [f".{x}" for x in _NAME.findall(value.lower())]
            _, inner, outer = stack[-1]
            inner += tuple(names)
            more = {x if x in LABEL_NAMES else _slot(x, size): x for x in inner[:-64]}
            if more.keys() - outer.keys():
                outer = outer | {k: x for k, x in more.items() if k not in outer}
            stack.append((tag, inner[-64:], outer))
    close()
    return out


@functools.lru_cache(200_000)
def _slot(name: str, size: int) -> int:
    return 1 + zlib.crc32(name.encode()) % (size - 1)


class Features:
    """Hashed features of block sequences."""

    def __init__(self, p: Params):
        self.p = p
        self.kept: dict[str, int] = {}

    def slots(self, names, size: int, mark: str) -> list[int]:
        out = []
        for x in names:
            key = mark + x
            s = self.kept.get(key)
            if s is None:
                if len(self.kept) > 200_000:
                    self.kept.clear()
                s = self.kept[key] = _slot(key, size)
            out.append(s)
        return out

    def of(self, page: list[Block]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Path slots and word slots of each block, and its numbers."""
        n = len(page)
        paths = [self.slots(b.path, self.p.paths, "") + self.slots([f"last:{b.path[-1] if b.path else ''}"], self.p.paths, "") for b in page]
        words = [self.slots(b.text.lower().split(), self.p.words, "w:") for b in page]
        numbers = np.array([(b.linked, np.log1p(len(b.text)) / 8, min(64, len(b.path)) / 32, k / n, (n - k) / n, b.text[-1] in ".!?…:\"") for k, b in enumerate(page)], np.float32).reshape(n, 6)
        return paths, words, numbers


NUMBERS = 6


def _bag(rows: list[list[int]], table: np.ndarray) -> np.ndarray:
    """Mean of the table's rows for each list of slots."""
    if not rows:
        return np.zeros((0, table.shape[1]), table.dtype)
    if len(rows) > 256:  # memory for the vectors of some blocks at a time
        return np.concatenate([_bag(rows[k:k + 256], table) for k in range(0, len(rows), 256)])
    lengths = np.array([max(1, len(r)) for r in rows])
    flat = np.fromiter((s for r in rows for s in (r or [0])), np.int64, int(lengths.sum()))
    return np.add.reduceat(table[flat], np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0) / lengths[:, None].astype(table.dtype)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors, one output a block."""

    def __init__(self, p: Params):
        rng = np.random.default_rng(p.seed)
        d, h = 2 * p.width + NUMBERS, p.hidden
        small = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = p
        self.w = {"path": small(p.paths, p.width) * np.float32(np.sqrt(p.paths) * 0.3), "word": small(p.words, p.width) * np.float32(np.sqrt(p.words) * 0.1),
                  "out": small(2 * h + d, 1), "bias": np.zeros(1, np.float32)}
        for k in ("f", "b"):
            self.w |= {"x" + k: small(d, 4 * h), "h" + k: small(h, 4 * h), "c" + k: np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32)}

    def inputs(self, paths, words, numbers: np.ndarray) -> np.ndarray:
        return np.concatenate([_bag(paths, self.w["path"]), _bag(words, self.w["word"]), numbers], axis=1).astype(np.float32)

    def run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool = False):
        """Hidden states of sequences x (time, batch, d); masked steps carry
        the state on."""
        t, n, h = x.shape[0], x.shape[1], self.p.hidden
        hs, cs = np.zeros((t + 1, n, h), np.float32), np.zeros((2 if not keep else t + 1, n, h), np.float32)
        pre = x @ self.w["x" + side] + self.w["c" + side]
        gates = np.zeros((t, n, 4 * h), np.float32) if keep else None
        for k in range(t):
            z = pre[k] + hs[k] @ self.w["h" + side]
            i, f, o = _sigmoid(z[:, :h]), _sigmoid(z[:, h:2 * h]), _sigmoid(z[:, 2 * h:3 * h])
            g = np.tanh(z[:, 3 * h:])
            old = cs[k if keep else 0]
            c = f * old + i * g
            m = mask[k][:, None]
            new = np.where(m, c, old)
            hs[k + 1] = np.where(m, o * np.tanh(c), hs[k])
            cs[k + 1 if keep else 0] = new
            if keep:
                gates[k] = np.concatenate([i, f, o, g], axis=1)
        return hs, cs, gates

    def back(self, x, mask, side, hs, cs, gates, dh_out):
        """Gradients of one direction; dh_out (time, batch, h)."""
        t, n, h = x.shape[0], x.shape[1], self.p.hidden
        dz = np.zeros_like(gates)
        dh, dc = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for k in range(t - 1, -1, -1):
            m = mask[k][:, None]
            i, f, o, g = (gates[k][:, j * h:(j + 1) * h] for j in range(4))
            up = dh + dh_out[k]
            tc = np.tanh(cs[k + 1])
            dck = dc + up * o * (1 - tc * tc)
            dz[k] = np.where(m, np.concatenate([dck * g * i * (1 - i), dck * cs[k] * f * (1 - f), up * tc * o * (1 - o), dck * i * (1 - g * g)], axis=1), 0)
            dh = np.where(m, dz[k] @ self.w["h" + side].T, up)
            dc = np.where(m, dck * f, dc)
        flat = dz.reshape(-1, 4 * h)
        return ({"x" + side: x.reshape(t * n, -1).T @ flat, "h" + side: hs[:-1].reshape(t * n, h).T @ flat, "c" + side: flat.sum(0)},
                dz @ self.w["x" + side].T)

    def probabilities(self, pages: list[list[Block]], features: Features) -> list[np.ndarray]:
        """Probability of main text for the blocks of each page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            # pages of like length together, 16,384 steps at most unless one page has more
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= 16_384:
                end += 1
            part = order[at:end]
            xs = [self.inputs(*features.of(pages[k])) for k in part]
            x, mask = _padded(xs)
            fore, _, _ = self.run(x, mask, "f")
            back, _, _ = self.run(x[::-1], mask[::-1], "b")
            z = np.concatenate([fore[1:], back[1:][::-1], x], axis=2) @ self.w["out"] + self.w["bias"]
            prob = _sigmoid(z[:, :, 0])
            for j, k in enumerate(part):
                out[k] = prob[:len(pages[k]), j]
            at = end
        return out

    def fit(self, pages: list[list[Block]], labels: list[np.ndarray], features: Features) -> None:
        """Adam over batches of pages of like length."""
        rng = np.random.default_rng(self.p.seed + 1)
        data = [(features.of(b), y.astype(np.float32)) for b, y in zip(pages, labels) if b]
        data.sort(key=lambda x: len(x[1]))
        groups = [data[k:k + 16] for k in range(0, len(data), 16)]
        mean, square, step = {k: np.zeros_like(v) for k, v in self.w.items()}, {k: np.zeros_like(v) for k, v in self.w.items()}, 0
        for epoch in range(self.p.epochs):
            rate = self.p.rate * (1 - epoch / self.p.epochs)
            for g in rng.permutation(len(groups)):
                step += 1
                for k, v in self.gradients(groups[g]).items():
                    mean[k] = 0.9 * mean[k] + 0.1 * v
                    square[k] = 0.999 * square[k] + 0.001 * v * v
                    self.w[k] -= (rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)

    def gradients(self, group) -> dict[str, np.ndarray]:
        xs = [self.inputs(*f) for f, _ in group]
        x, mask = _padded(xs)
        y = np.zeros(mask.shape, np.float32)
        for j, (_, own) in enumerate(group):
            y[:len(own), j] = own
        fore = self.run(x, mask, "f", True)
        back = self.run(x[::-1], mask[::-1], "b", True)
        hidden = np.concatenate([fore[0][1:], back[0][1:][::-1], x], axis=2)
        dz = np.where(mask, _sigmoid((hidden @ self.w["out"])[:, :, 0] + self.w["bias"]) - y, 0)[:, :, None] / max(1, mask.sum())
        dz = dz.astype(np.float32)
        h = self.p.hidden
        grads = {"out": hidden.reshape(-1, hidden.shape[2]).T @ dz.reshape(-1, 1), "bias": dz.sum((0, 1))}
        dhidden = dz @ self.w["out"].T
        gf, dxf = self.back(x, mask, "f", *fore, dhidden[:, :, :h])
        gb, dxb = self.back(x[::-1], mask[::-1], "b", *back, dhidden[::-1, :, h:2 * h])
        grads |= gf | gb
        dx = dhidden[:, :, 2 * h:] + dxf + dxb[::-1]
        for key, lists, lo in (("path", 0, 0), ("word", 1, self.p.width)):
            table = np.zeros_like(self.w[key])
            for j, (f, own) in enumerate(group):
                for k, slots in enumerate(f[lists]):
                    if slots:
                        np.add.at(table, slots, dx[k, j, lo:lo + self.p.width] / len(slots))
            grads[key] = table
        return grads


def _padded(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(x) for x in xs)
    out, mask = np.zeros((t, len(xs), xs[0].shape[1]), np.float32), np.zeros((t, len(xs)), bool)
    for j, x in enumerate(xs):
        out[:len(x), j], mask[:len(x), j] = x, True
    return out, mask


# Names of containers, for silver labels and generated pages.
MAIN_NAMES = ("article", "main", ".article", ".post", ".entry", ".story", ".content", ".main", ".body", ".text")
SIDE_NAMES = ("nav", "header", "footer", "aside", "form", "button", "select", "menu", ".ad", ".ads", ".advert", ".advertisement", ".banner", ".sponsor", ".sponsored",
              ".promo", ".nav", ".menu", ".navbar", ".breadcrumb", ".breadcrumbs", ".sidebar", ".widget", ".related", ".footer", ".header", ".masthead", ".cookie",
              ".consent", ".notice", ".alert", ".popup", ".modal", ".newsletter", ".subscribe", ".signup", ".login", ".search", ".share", ".social", ".comment",
              ".comments", ".reply", ".replies", ".disqus", ".pagination", ".pager", ".copyright", ".tags", ".meta", ".toolbar", ".navigation", ".complementary", ".contentinfo")
LABEL_NAMES = frozenset(MAIN_NAMES + SIDE_NAMES)


def silver(page: list[Block]) -> np.ndarray | None:
    """Labels by structure: inside a main container and no side container.
    None if the page has no article or main element."""
    side = frozenset(SIDE_NAMES)
    if not any("article" in b.path or "main" in b.path for b in page):
        return None
    return np.array([("article" in b.path or "main" in b.path) and not side & set(b.path) for b in page])


def skeleton(main: list[str], texts: list[str], rng: np.random.Generator) -> tuple[str, list[str]]:
    """A generated page around ``main`` paragraphs, and the texts of its main
    blocks. ``texts`` are said in its other parts."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    esc = html.escape

    def words(lo: int, hi: int) -> str:
        w = pick(texts).split()
        n = int(rng.integers(lo, hi + 1))
        k = int(rng.integers(max(1, len(w) - n)))
        return esc(" ".join(w[k:k + n]))

    def named(tag: str, *names: str) -> str:
        name = pick(names)
        name = pick((name, f"{name} {pick(('box', 'block', 'wrap', 'inner', 'x1'))}", f"{pick(('site', 'page', 'top', 'block'))}-{name}"))
        return f'<{tag} {pick(("class", "id"))}="{name}">'

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{words(1, 4)}</a></li>' for k in range(n)) + "</ul>"

    def menu() -> str:
        tag, end = pick((("<nav>", "</nav>"), (named("div", "nav", "menu", "navbar", "navigation", "breadcrumb"), "</div>"), ("<header>", "</header>"), ('<div role="navigation">', "</div>")))
        return tag + pick((links(int(rng.integers(2, 9))), "".join(f'<a href="/{k}">{words(1, 3)}</a> ' for k in range(int(rng.integers(2, 8)))))) + end

    def header() -> str:
        return pick(("<header>", named("div", "header", "masthead"))) .replace("<header>", "<header>") + f"<{(t := pick(('h1', 'h2', 'p', 'div')))}>{words(1, 6)}</{t}>"

    def closed(start: str, body: str) -> str:
        return start + body + "</" + re.match(r"<(\w+)", start)[1] + ">"

    def paragraphs(lo: int, hi: int, tags=("p", "div")) -> str:
        t = pick(tags)
        return "".join(f"<{t}>{words(4, 40)}.</{t}>" for _ in range(int(rng.integers(lo, hi + 1))))

    def advert() -> str:
        return closed(named("div", "ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo"), pick((words(4, 25), paragraphs(1, 2))))

    def notice() -> str:
        return closed(named(pick(("div", "section")), "cookie", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe"), paragraphs(1, 2) + f"<button>{words(1, 2)}</button>" * int(rng.integers(2)))

    def side() -> str:
        start = pick(("<aside>", named("div", "sidebar", "widget", "related"), named("aside", "sidebar", "related"), named("section", "related", "sidebar")))
        return closed(start, f"<h3>{words(1, 4)}</h3>" + pick((links(int(rng.integers(2, 6))), paragraphs(1, 3))))

    def form() -> str:
        return closed(pick(("<form>", named("form", "search", "login", "signup", "subscribe"))), f"<label>{words(1, 4)}</label><input name=q><p>{words(2, 12)}</p><button>{words(1, 2)}</button>")

    def comments() -> str:
        item = lambda: closed(named(pick(("div", "li", "article")), "comment", "reply"), f"<p>{words(1, 3)}</p>" * int(rng.integers(2)) + paragraphs(1, 2))
        return closed(named(pick(("section", "div", "ol")), "comments", "comment", "replies", "disqus"), f"<h2>{words(1, 3)}</h2>" * int(rng.integers(2)) + "".join(item() for _ in range(int(rng.integers(1, 6)))))

    def footer() -> str:
        return closed(pick(("<footer>", named("div", "footer", "copyright"), '<div role="contentinfo">')), pick(("&copy; ", "")) + words(3, 20) + pick(("", links(3))))

    said = [" ".join(x.split()) for x in main]
    body = "".join(f"<{(t := 'h1' if k == 0 and rng.random() < 0.8 else pick(('p', 'p', 'p', 'p', 'p', 'h2', 'blockquote', 'li', 'div')))}>{esc(x)}</{t}>" for k, x in enumerate(said))
    inner = pick((advert, side, notice, form)) if rng.random() < 0.35 else None
    if inner and len(said) > 2:  # something foreign inside the article
        cut = body.find("</p>", len(body) // 2)
        body = body[:cut + 4] + inner() + body[cut + 4:] if cut > 0 else body
    start = pick(("<article>", "<article>", "<main>", named("div", "content", "article", "post", "entry", "story", "text", "main"), named("section", "content", "article", "story", "main"), named("article", "post", "story", "entry"), named("main", "content", "main")))
    article = closed(start, body + (comments() if rng.random() < 0.15 else ""))
    if rng.random() < 0.3:
        article = closed(pick(("<main>", '<div id="main">', '<div class="container">', '<div id="wrap">')), article + (side() if rng.random() < 0.4 else ""))
    before = [f() for f in (menu, lambda: closed(header(), ""), notice, advert, form, side) if rng.random() < 0.45]
    after = [f() for f in (comments, side, advert, notice, form, menu) if rng.random() < 0.4] + [footer()] * int(rng.random() < 0.85)
    rng.shuffle(before)
    return f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title></head><body>" + "".join(before) + article + "".join(after) + "</body></html>", said


def training_set(pages: list[str], p: Params) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Block sequences with labels: the pages as they are, where structure
    labels them, and their texts in generated skeletons."""
    rng = np.random.default_rng(p.seed)
    xs, ys, mains, texts = [], [], [], []
    for page in pages:
        own = blocks(page, p.paths)
        y = silver(own)
        if y is not None and len(own) <= p.page_blocks:
            xs.append(own)
            ys.append(y)
            mains.append([b.text for b, k in zip(own, y) if k])
        texts += [b.text for b in own]
    texts = [t for t in texts if t] or ["lorem ipsum"]
    mains = [m for m in mains if m] or [[t] for t in texts[:50]]
    for turn in range(p.skeletons):
        main = mains[turn % len(mains)]
        k = int(rng.integers(1, min(len(main), 12) + 1))
        page, said = skeleton(main[:k], texts, rng)
        own, at = blocks(page, p.paths), 0
        y = np.zeros(len(own), bool)
        for j, b in enumerate(own):  # the main texts come in order inside their container
            if at < len(said) and b.text == said[at] and not frozenset(SIDE_NAMES) & set(b.path):
                y[j], at = True, at + 1
        if at == len(said):
            xs.append(own)
            ys.append(y)
    return xs, ys


def train(pages: DataFrame, p: Params = Params(), id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """The labeller of a bounded sample of ``pages``."""
    fit = (pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html"))
           .filter((F.length("html") > 0) & (F.length("html") <= p.page_chars)))
    # chosen by narrow rows: what tasks send to the driver does not grow with their number times a page
    chosen = fit.select("id").filter("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(p.pages)
    rows = fit.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id", "html").limit(p.pages).collect()
    labeller = Labeller(p)
    labeller.fit(*training_set([r["html"] for r in rows], p), Features(p))
    return labeller


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = shared.value
        features = Features(labeller.p)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pages = [blocks(x.as_py() or "", labeller.p.paths) for x in part.column(2)]
                said = [" ".join(b.text for b, q in zip(own, prob) if q >= 0.5) for own, prob in zip(pages, labeller.probabilities(pages, features))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(said, pa.string()), pa.array([len(x) for x in said], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def main_text(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each row of ``pages``.

    A null or empty html, and a page without a block labelled main, have an
    empty text; null ids and urls stay null. A page that ends inside a tag ends
    before it. Other columns are not read. An empty table gives an empty
    result.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(train(rows, p))  # fixed by Params: under 1 MB
    return rows.mapInArrow(_extract(shared), "page_id long, url string, text string, n_chars long")


@register("op4_html_extraction")
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))

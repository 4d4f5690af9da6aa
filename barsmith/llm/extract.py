"""Operator 5, HTML extraction: a recurrent block labeller.

A page is a sequence of leaf blocks. Each block is a vector: the mean of the
hashed embeddings of its tag path (tags, and words of class, id and role), the
mean of the hashed embeddings of all its words, and a few sizes. A
bidirectional LSTM in numpy reads the whole sequence both ways and a logistic
layer labels every block as main text or not, so a decision sees the whole
page. The network is trained on the driver, by backpropagation through time,
on pages made by a small grammar of layouts (``made_page``), whose labels are
known; its size and the number of pages are fixed parameters, not data.

Extraction is one pass over the pages, where they lie.

Defined results: a null or empty page, or one without main text, gives an empty
text; unclosed markup is closed at the end; repeated pages give equal rows; an
empty table gives no rows; other columns pass through inside ``row``.
"""

from __future__ import annotations

import functools
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barsmith.llm.htmlblocks import Block, blocks_of
from barsmith.llm.staging import arrow_map
from barsmith.llm.words import ALNUM, per_doc, text_slices, words_of

PATH_ROWS, WORD_ROWS = 2048, 2048
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(b".,;:!?")] = True
DIGITS = np.zeros(256, bool)
DIGITS[0x30:0x3A] = True
SIZES = 8


@functools.lru_cache(maxsize=100_000)
def _path_row(part: str) -> int:
    return zlib.crc32(part.encode("utf-8", "replace")) % PATH_ROWS


def _ragged(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.fromiter((x for r in rows for x in r), np.int64)
    return flat, np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)


class Features:
    """Hashed rows and sizes of the blocks of several pages."""

    def __init__(self, pages: list[list[Block]]):
        blocks = [b for p in pages for b in p]
        self.page_first = np.concatenate([[0], np.cumsum([len(p) for p in pages])]).astype(np.int64)
        self.path, self.path_first = _ragged([
            [_path_row(x) for x in b.path] + [_path_row(">" + ">".join(b.path[-2:]))] for b in blocks])
        words = words_of(pa.array([b.text for b in blocks], pa.large_string()), ALNUM)
        self.word = (words.hashes() >> np.uint64(40)).astype(np.int64) % WORD_ROWS
        self.word_first = words.first
        size = np.array([len(b.text.encode("utf-8", "replace")) for b in blocks], np.int64)
        edge = np.concatenate([[0], np.cumsum(size)])
        chars = np.array([len(b.text) for b in blocks], np.float64)
        linked = np.array([b.linked for b in blocks], np.float64)
        n = np.diff(self.page_first)
        place = np.arange(len(blocks)) - np.repeat(self.page_first[:-1], n)
        share = lambda table: per_doc(table[words.data], edge) / np.maximum(size, 1)
        self.sizes = np.column_stack([
            np.log1p(chars) / 5, np.log1p(words.counts) / 4, linked / np.maximum(chars, 1),
            share(PUNCTUATION) * 5, share(DIGITS) * 2, place / np.maximum(np.repeat(n, n), 1),
            np.array([len(b.path) for b in blocks]) / 10, np.ones(len(blocks))]).astype(np.float32) \
            if blocks else np.zeros((0, SIZES), np.float32)


def _means(table: np.ndarray, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros((len(first) - 1, table.shape[1]), np.float32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(table[rows], first[full], axis=0)
        out[full] /= np.diff(first)[full, None]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Embeddings, one LSTM per direction and a logistic layer, as arrays by name."""

    def __init__(self, hidden: int = 20, path_dim: int = 12, word_dim: int = 6, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        width = path_dim + word_dim + SIZES
        make = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.w = {"path": make(PATH_ROWS, path_dim, scale=0.3), "word": make(WORD_ROWS, word_dim, scale=0.1),
                  "out": make(2 * hidden + width, scale=0.1), "out_bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.w["in_" + d] = make(width, 4 * hidden, scale=width ** -0.5)
            self.w["rec_" + d] = make(hidden, 4 * hidden, scale=hidden ** -0.5)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1
            self.w["bias_" + d] = bias

    def inputs(self, f: Features) -> np.ndarray:
        return np.concatenate([_means(self.w["path"], f.path, f.path_first),
                               _means(self.w["word"], f.word, f.word_first), f.sizes], 1)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, learn: bool = True) -> tuple[np.ndarray, list]:
        """One direction over padded pages, x[time, page]; padding keeps the state.
        What backpropagation needs of every step is kept only to ``learn``."""
        n, h = x.shape[1], self.hidden
        state, cell, memory = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
        out = np.empty((len(x), n, h), np.result_type(x, self.w["rec_" + d]))
        ahead = x @ self.w["in_" + d] + self.w["bias_" + d]
        for t in range(len(x)):
            g = ahead[t] + state @ self.w["rec_" + d]
            i, f, o = sigmoid(g[:, :h]), sigmoid(g[:, h:2 * h]), sigmoid(g[:, 2 * h:3 * h])
            c = np.tanh(g[:, 3 * h:])
            new = f * cell + i * c
            m = mask[t][:, None]
            top = np.tanh(new)
            if learn:
                memory.append((state, cell, i, f, o, c, top, m))
            cell = np.where(m, new, cell)
            state = np.where(m, o * top, state)
            out[t] = state
        return out, memory

    def _back(self, x: np.ndarray, dout: np.ndarray, memory: list, d: str, grads: dict) -> np.ndarray:
        h, w = self.hidden, self.w["rec_" + d]
        ds = dc = np.zeros(dout.shape[1:], np.float32)
        dgate = np.empty((*x.shape[:2], 4 * h), np.float32)
        drec = np.zeros_like(w)
        for t in range(len(x) - 1, -1, -1):
            state, cell, i, f, o, c, top, m = memory[t]
            ds = ds + dout[t]
            live = ds * m
            dnew = (live * o * (1 - top * top) + dc) * m
            dg = np.concatenate([dnew * c * i * (1 - i), dnew * cell * f * (1 - f),
                                 live * top * o * (1 - o), dnew * i * (1 - c * c)], 1)
            dgate[t] = dg
            drec += state.T @ dg
            ds = dg @ w.T + ds * ~m
            dc = dnew * f + dc * ~m
        flat = dgate.reshape(-1, 4 * h)
        grads["rec_" + d], grads["bias_" + d] = drec, flat.sum(0)
        grads["in_" + d] = x.reshape(-1, x.shape[2]).T @ flat
        return dgate @ self.w["in_" + d].T

    @staticmethod
    def _padded(f: Features, pages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block number by (time, page), and which of them are blocks."""
        n = np.diff(f.page_first)[pages]
        t = np.arange(n.max())[:, None]
        return np.minimum(f.page_first[pages] + t, f.page_first[-1] - 1), t < n

    def scores(self, f: Features, pages: int = 128, cells: int = 1 << 14) -> np.ndarray:
        """Probability of main text for every block. Pages of like length are
        read together, at most ``pages`` and ``cells`` blocks with padding (or one page)."""
        x = self.inputs(f)
        out = np.zeros(len(x), np.float32)
        n = np.diff(f.page_first)
        order = np.argsort(n, kind="stable")
        order = order[n[order] > 0]
        k = 0
        while k < len(order):
            size = 1
            while size < pages and k + size < len(order) and (size + 1) * n[order[k + size]] <= cells:
                size += 1
            at, mask = self._padded(f, order[k:k + size])
            z = self._logits(x[at], mask, learn=False)[0]
            out[at[mask]] = sigmoid(z[mask])
            k += size
        return out

    def _logits(self, x: np.ndarray, mask: np.ndarray, learn: bool = True):
        ahead, mem_f = self._run(x, mask, "f", learn)
        back, mem_b = self._run(x[::-1], mask[::-1], "b", learn)
        top = np.concatenate([ahead, back[::-1], x], 2)
        return top @ self.w["out"] + self.w["out_bias"], top, mem_f, mem_b

    def step(self, f: Features, y: np.ndarray, pages: np.ndarray, state: dict, rate: float) -> None:
        """One Adam step on some pages."""
        x_all = self.inputs(f)
        at, mask = self._padded(f, pages)
        x = x_all[at]
        z, top, mem_f, mem_b = self._logits(x, mask)
        dz = np.where(mask, sigmoid(z) - y[at], 0).astype(np.float32) / mask.sum()
        grads = {"out": np.einsum("tn,tnk->k", dz, top), "out_bias": dz.sum(keepdims=True).reshape(1)}
        dtop = dz[..., None] * self.w["out"]
        h = self.hidden
        dx = self._back(x, dtop[..., :h], mem_f, "f", grads) + dtop[..., 2 * h:]
        dx += self._back(x[::-1], dtop[::-1, :, h:2 * h], mem_b, "b", grads)[::-1]
        dblock = np.zeros_like(x_all)
        dblock[at[mask]] = dx[mask]
        p = self.w["path"].shape[1]
        for name, rows, first, cols in (("path", f.path, f.path_first, slice(0, p)),
                                        ("word", f.word, f.word_first, slice(p, -SIZES))):
            n = np.diff(first)
            each = np.repeat(dblock[:, cols] / np.maximum(n, 1)[:, None], n, axis=0)
            grads[name] = np.zeros_like(self.w[name])
            np.add.at(grads[name], rows, each)
        state["t"] = state.get("t", 0) + 1
        for name, g in grads.items():
            m, v = state.get(name, (0, 0))
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            state[name] = (m, v)
            fix = rate * np.sqrt(1 - 0.99 ** state["t"]) / (1 - 0.9 ** state["t"])
            self.w[name] = (self.w[name] - fix * m / (np.sqrt(v) + 1e-6)).astype(np.float32)


#: Names that page parts commonly carry, for the made pages.
PARTS = {
    "content": ["content", "post", "entry", "article", "main", "body", "story", "text", "page"],
    "menu": ["nav", "menu", "navbar", "breadcrumb", "links", "toolbar", "tabs"],
    "header": ["header", "masthead", "top", "banner", "logo", "brand", "site"],
    "footer": ["footer", "bottom", "copyright", "legal", "colophon", "foot"],
    "sidebar": ["sidebar", "side", "related", "widget", "recommended", "popular", "rail"],
    "notice": ["cookie", "notice", "alert", "consent", "gdpr", "popup", "message", "modal"],
    "ad": ["ad", "ads", "advert", "sponsored", "promo", "banner", "sponsor"],
    "comments": ["comments", "comment", "reply", "replies", "discussion", "respond", "thread"],
    "form": ["form", "newsletter", "subscribe", "search", "login", "signup", "contact"],
    "share": ["share", "social", "tools", "actions", "meta", "byline", "tags"],
}
PHRASES = {
    "menu": "home about contact news sports login register help more".split(),
    "footer": "copyright all rights reserved privacy policy terms of use © 2024".split(),
    "sidebar": "related most read popular recommended you may also like".split(),
    "notice": "we use cookies to improve accept settings this site privacy notice".split(),
    "ad": "advertisement sponsored buy now offer sale click here".split(),
    "comments": "comments reply posted by says ago report like user wrote".split(),
    "form": "email name subscribe search password submit your message send".split(),
    "share": "share tweet print email facebook tags posted by author".split(),
    "header": "site logo search skip to menu".split(),
}
TAGS = {"menu": ["nav", "ul", "div", "menu"], "header": ["header", "div"], "footer": ["footer", "div"],
        "sidebar": ["aside", "div", "section"], "notice": ["div", "aside", "section", "dialog"],
        "ad": ["div", "aside", "section", "ins"], "comments": ["section", "div", "ol"],
        "form": ["form", "div"], "share": ["div", "ul", "p"]}


def made_page(rnd: random.Random) -> tuple[str, list[int]]:
    """A page of some layout, and whether each of its blocks is main text."""
    alphabet = ["".join(rnd.choice("aeioubcdfghlmnprstvwz") for _ in range(rnd.randint(1, 3)))
                for _ in range(40)]
    out: list[str] = []
    labels: list[int] = []
    word = lambda: "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 4)))

    def prose(lo: int, hi: int) -> str:
        n = rnd.randint(lo, hi)
        text = " ".join(word() + rnd.choice(["", "", "", "", ",", "."]) for _ in range(n))
        return (text.capitalize() + rnd.choice([".", ".", "", "&amp;"])) or word()

    def said(kind: str, lo: int, hi: int) -> str:
        n = rnd.randint(lo, hi)
        own = PHRASES[kind] if rnd.random() < 0.6 else None
        return " ".join(rnd.choice(own) if own and rnd.random() < 0.7 else word() for _ in range(n))

    def named(kind: str) -> str:
        if rnd.random() < 0.12:
            return ""
        name = rnd.choice(PARTS[kind])
        if rnd.random() < 0.4:
            name = rnd.choice([f"{name}-{word()}", f"{word()}_{name}", f"{name} {word()}",
                               f"{name}{rnd.randint(1, 9)}"])
        return f' {rnd.choice(["class", "class", "id"])}="{name}"'

    def add(markup: str, label: int) -> None:
        out.append(markup)
        labels.append(label)

    def part(kind: str) -> None:
        tag = rnd.choice(TAGS[kind])
        attrs = named(kind) if tag in ("div", "section", "ul", "p", "ol", "ins") or rnd.random() < 0.4 else ""
        out.append(f"<{tag}{attrs}>")
        if kind in ("menu", "share") or kind in ("footer", "sidebar", "header") and rnd.random() < 0.5:
            wrap = "" if tag in ("ul", "ol") else "ul"
            if tag == "p":
                add(f'<a href="#">{said(kind, 1, 4)}</a> {said(kind, 0, 4)}', 0)
            else:
                out.append(f"<{wrap}>" if wrap else "")
                for _ in range(rnd.randint(1, 8)):
                    add(f'<li><a href="/{word()}">{said(kind, 1, 4)}</a></li>', 0)
                out.append(f"</{wrap}>" if wrap else "")
        elif kind == "comments":
            add(f"<h3>{said(kind, 1, 4)}</h3>", 0)
            for _ in range(rnd.randint(1, 6)):
                box = rnd.choice(["div", "li", "article"])
                out.append(f"<{box}{named(kind)}>")
                add(f"<b>{word()}</b> {said(kind, 1, 4)}", 0)
                add(f"<p>{prose(3, 60)}</p>", 0)
                out.append(f"</{box}>")
        elif kind == "form":
            for _ in range(rnd.randint(1, 4)):
                add(f"<p>{said(kind, 1, 8)}<input></p>" if rnd.random() < 0.5
                    else f"<div><label>{said(kind, 1, 3)}</label><input></div>", 0)
        elif tag != "p" and rnd.random() < 0.02:
            grid(0, lambda: said(kind, 1, 4))
        elif rnd.random() < 0.5 or tag == "p":
            add(prose(3, 30) if rnd.random() < 0.6 else said(kind, 2, 12), 0)
        else:
            for _ in range(rnd.randint(1, 4)):
                add(f"<{rnd.choice(['p', 'div', 'h4'])}>{prose(2, 25) if rnd.random() < 0.5 else said(kind, 1, 9)}", 0)
                out.append(rnd.choice(["</p>", ""]) if out[-1].startswith("<p>") else
                           "</" + out[-1][1:].split(">")[0] + ">")
        out.append(f"</{tag}>")

    def grid(label: int, text) -> None:
        cell = rnd.choice(["td", "td", "th"])
        out.append("<table>" + rnd.choice(["", "<tbody>"]))
        if rnd.random() < 0.2:
            add(f"<caption>{text()}</caption>", label)
        width = rnd.randint(1, 4)
        for row in range(rnd.randint(1, 6)):
            out.append("<tr>")
            for _ in range(width):
                own = cell if row == 0 else "td"
                add(f"<{own}>{rnd.choice([text, lambda: str(rnd.randint(0, 9999))])()}</{own}>", label)
            out.append("</tr>")
        out.append("</table>")

    def paragraphs(hi: int) -> None:
        for _ in range(rnd.randint(1, hi)):
            add(f"<p>{prose(2, 80)}</p>", 1)

    def article() -> None:
        shape = rnd.random()
        tags = [("article", "")] if shape < 0.4 else [("main", "")] if shape < 0.5 else \
            [("div", named("content"))] if shape < 0.75 else [("div", "")] if shape < 0.9 else \
            [("main", ""), ("article", named("content"))]
        if rnd.random() < 0.3:
            tags.append(("div", named("content")))
        out.extend(f"<{t}{a}>" for t, a in tags)
        if rnd.random() < 0.8:
            add(f"<{rnd.choice(['h1', 'h1', 'h2'])}>{prose(1, 12)}</h2>".replace("</h2>", ""), 1)
            out.append("</" + out[-1][1:3] + ">")
        if rnd.random() < 0.15:
            part("share")
        n = rnd.choice([rnd.randint(0, 4), rnd.randint(1, 12), rnd.randint(5, 40)])
        for k in range(n):
            roll = rnd.random()
            if roll < 0.62:
                text = prose(1, 3) if rnd.random() < 0.3 else prose(4, 120)
                if rnd.random() < 0.12:
                    text = said(rnd.choice(list(PHRASES)), 1, 12).capitalize() + "."
                if rnd.random() < 0.2:
                    text = rnd.choice(["<b>{}</b>", "<b>{}", "{} <a href='x'>" + word() + "</a>.",
                                       "<i>" + word() + "</i> {}"]).format(text)
                add(f"<p>{text}" + rnd.choice(["</p>", "</p>", "</p>", "", "<br>"]), 1)
            elif roll < 0.69:
                add(f"<h2>{prose(1, 8)}</h2>", 1)
            elif roll < 0.76:
                out.append("<ul>")
                for _ in range(rnd.randint(1, 5)):
                    add(f"<li>{prose(1, 20)}</li>", 1)
                out.append("</ul>")
            elif roll < 0.8:
                add(f"<blockquote>{prose(5, 40)}</blockquote>", 1)
            elif roll < 0.82:
                add(f"<pre>{prose(3, 20)}</pre>", 1)
            elif roll < 0.86:
                grid(1, lambda: prose(1, 6))
            elif roll < 0.88:
                out.append("<dl>")
                for _ in range(rnd.randint(1, 4)):
                    add(f"<dt>{prose(1, 4)}</dt>", 1)
                    add(f"<dd>{prose(2, 30)}</dd>", 1)
                out.append("</dl>")
            elif roll < 0.91:
                out.append("<figure><img src=x>")
                add(f"<figcaption>{prose(1, 25)}</figcaption>", 1)
                out.append("</figure>")
            elif roll < 0.94:
                box = rnd.choice(["div", "section", "div"])
                out.append(f"<{box}>")
                paragraphs(4)
                out.append(f"</{box}>")
            elif roll < 0.97:
                part("ad")
            else:
                part(rnd.choice(["sidebar", "form", "share", "notice"]))
        if rnd.random() < 0.15:
            part(rnd.choice(["share", "comments", "sidebar", "footer"]))
        out.extend(f"</{t}>" for t, _ in reversed(tags))

    wrap = rnd.random() < 0.3
    out.append("<html><body>" + ('<div id="wrapper">' if wrap else ""))
    before = [k for k, p in (("notice", 0.3), ("header", 0.5), ("menu", 0.9), ("ad", 0.5), ("form", 0.15),
                             ("sidebar", 0.2)) if rnd.random() < p]
    rnd.shuffle(before)
    after = [k for k, p in (("share", 0.3), ("comments", 0.35), ("sidebar", 0.4), ("ad", 0.3), ("form", 0.25),
                            ("menu", 0.15)) if rnd.random() < p]
    rnd.shuffle(after)
    for k in before:
        part(k)
    article()
    for k in after + ["footer"] * (rnd.random() < 0.9) + ["notice"] * (rnd.random() < 0.1):
        part(k)
    out.append(("</div>" if wrap else "") + "</body></html>")
    return "".join(out), labels


def labelled_pages(n: int, seed: int) -> tuple[list[list[Block]], list[list[int]]]:
    """Made pages whose blocks and labels correspond one to one."""
    rnd, pages, labels = random.Random(seed), [], []
    while len(pages) < n:
        page, y = made_page(rnd)
        blocks = blocks_of(page)
        if len(blocks) == len(y) > 0:
            pages.append(blocks)
            labels.append(y)
    return pages, labels


@functools.lru_cache(maxsize=4)
def train(pages: int = 900, epochs: int = 8, seed: int = 0, batch: int = 32, rate: float = 0.01) -> BlockLabeller:
    """The labeller, trained on made pages (the same for the same arguments)."""
    blocks, labels = labelled_pages(pages, seed)
    rng, net, state = np.random.default_rng(seed), BlockLabeller(seed=seed), {}
    order = np.argsort([len(b) for b in blocks], kind="stable")
    groups = [order[i:i + batch] for i in range(0, pages, batch)]
    data = [(Features([blocks[i] for i in g]), np.concatenate([labels[i] for i in g]).astype(np.float32))
            for g in groups]
    for epoch in range(epochs):
        for k in rng.permutation(len(data)):
            f, y = data[k]
            net.step(f, y, np.arange(len(f.page_first) - 1), state, rate / (1 + 0.4 * epoch))
    return net


def main_texts(net: BlockLabeller, pages: list[str | None]) -> list[str]:
    """The main text of every page: its main blocks joined by an empty line."""
    parsed = [blocks_of(p) for p in pages]
    f = Features(parsed)
    own = net.scores(f) >= 0.5
    return ["\n\n".join(b.text for b, keep in zip(blocks, own[f.page_first[i]:f.page_first[i + 1]]) if keep)
            for i, blocks in enumerate(parsed)]


def extract(pages: DataFrame, net: BlockLabeller | None = None, html: str = "html") -> DataFrame:
    """``row`` (the page's columns but the html) and ``text``."""
    sent = pages.sparkSession.sparkContext.broadcast(train() if net is None else net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html", 1 << 20):
            found = main_texts(sent.value, batch.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.string())],
                                             names=["row", "text"])

    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html]).alias("row"),
                        F.col(html).cast("string").alias("html"))
    kind = rows.schema["row"].dataType.simpleString()
    return arrow_map(rows, run, f"row {kind}, text string")

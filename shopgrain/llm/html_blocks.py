"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags. Each block
becomes a vector of its tag path (tags and the words of class, id and role, hashed),
of its words (hashed) and of a few measures. A bidirectional LSTM in numpy reads the
blocks of a page in both directions, so every block is judged in the context of the
whole page, and a logistic unit labels it as main text or not.

The model is trained here, on pages that ``sample_page`` generates in many layouts with
known main text; training takes seconds, is seeded and the same everywhere.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import map_rows

#: Sizes: hashed tag path (own element, whole path), hashed words, measures, LSTM state.
OWN, PATH, WORDS, MEASURES, STATE = 64, 128, 24, 8, 24
INPUT = OWN + PATH + WORDS + MEASURES
#: Generated pages, passes over them, pages per step of training.
PAGES, EPOCHS, BATCH = 1200, 6, 40
#: Blocks times pages that the LSTM holds at once; elements that may nest.
CELLS, DEPTH = 1 << 14, 256
SEED = 3

NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
REST = re.compile(r"(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>")
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Fixed values of HTML: elements whose content is no text of the page, block elements.
RAW = frozenset(
    "script style template textarea title iframe noembed noframes".split()
)
BLOCKS = frozenset(
    "html head body address article aside blockquote button caption center dd details dialog "
    "div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr label "
    "legend li main menu nav noscript ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
#: What an opening tag closes, up to the element that holds both.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
VOID = frozenset({"hr"})


class Beyond:
    """Open elements deeper than paths go, with the places of each name."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}

    def __contains__(self, name: str) -> bool:
        return bool(self.places.get(name))

    def last(self, name: str) -> int:
        return self.places[name][-1] if name in self else -1

    def open(self, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)

    def close(self, place: int) -> None:
        """Close the element at ``place`` and all within it."""
        while len(self.names) > place:
            self.places[self.names.pop()].pop()


class Block(NamedTuple):
    path: tuple[tuple[str, ...], ...]
    text: str
    linked: int


@lru_cache(100_000)
def element(tag: str, attributes: str) -> tuple[str, ...]:
    """A tag and the words of its class, id and role."""
    words = [f"<{tag}"]
    for m in ATTRIBUTE.finditer(attributes):
        words += [w.lower() for w in PART.findall(m[2] or m[3] or m[4] or "")]
    return tuple(dict.fromkeys(words))


#: The next tag of a link, of which there is one search per tag.
LINK = re.compile(r"<(/?)a[\s/>]", re.I)


def behind(page: str, token: str, start: int) -> int:
    found = page.find(token, start)
    return len(page) if found < 0 else found + len(token)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, as far as they have text.

    Character references are decoded, runs of white space become one space. Markup
    that breaks off, tags that are never closed and elements nested deeper than
    ``DEPTH`` (which count as part of their ancestors) are read as they stand.
    """
    out: list[Block] = []
    tags: list[str] = []
    path: tuple[tuple[str, ...], ...] = ()
    parts: list[str] = []
    linked = 0
    beyond = Beyond()
    in_link = open_ended = False
    at = 0

    def flush() -> None:
        nonlocal linked, in_link
        # A link that is never closed ends with its block.
        in_link = in_link and not open_ended
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(path, text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = html.unescape(text)
        parts.append(text)
        if in_link:
            linked += len(text)

    while (begin := page.find("<", at)) >= 0:
        if begin > at:
            add(page[at:begin])
        m = NAME.match(page, begin)
        if not m:
            if page.startswith("<!--", begin):
                at = behind(page, "-->", begin + 4)
            elif page[begin + 1 : begin + 2] in ("!", "?", "/"):
                at = behind(page, ">", begin)
            else:
                add("<")
                at = begin + 1
            continue
        # A quote that is never closed does not hide the end of its tag.
        rest = REST.match(page, m.end())
        at = rest.end() if rest else behind(page, ">", m.end())
        if page[at - 1] != ">":  # the page ends inside a tag
            break
        name, closing, inside = m[2].lower(), bool(m[1]), page[m.end() : at - 1]
        if name in RAW:
            if not closing and not inside.rstrip().endswith("/"):
                end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
                at = behind(page, ">", end.start()) if end else len(page)
            parts.append(" ")
        elif name == "xmp" and not closing:  # shown as it is written
            flush()
            end = re.compile(r"</xmp[\s/>]", re.I).search(page, at)
            stop = end.start() if end else len(page)
            parts.append(page[at:stop])
            linked += in_link * (stop - at)
            at = behind(page, ">", stop) if end else stop
            flush()
        elif name in BLOCKS:
            flush()
            if closing:
                if name in beyond:
                    beyond.close(beyond.last(name))
                elif name in tags:
                    beyond.close(0)
                    keep = len(tags) - 1 - tags[::-1].index(name)
                    del tags[keep:]
                    path = path[:keep]
            else:
                shut, within = CLOSES.get(name, ({"p"}, {"button", "td", "th", "table"}))
                low, high = (max(map(beyond.last, names)) for names in (within, shut))
                if high > low:
                    beyond.close(high)
                elif low < 0:
                    for i in range(len(tags) - 1, -1, -1):
                        if tags[i] in within:
                            break
                        if tags[i] in shut:
                            beyond.close(0)
                            del tags[i:]
                            path = path[:i]
                            break
                if name in VOID:
                    continue
                if len(tags) < DEPTH:
                    tags.append(name)
                    path = (*path, element(name, inside))
                else:
                    beyond.open(name)
        elif name == "a":
            in_link = not closing
            end = LINK.search(page, at)
            open_ended = not end or not end[1]
        elif name in ("br", "img", "input"):
            parts.append(" ")
    add(page[at:])
    flush()
    return out


# -- vectors ----------------------------------------------------------------------------


def slot(word: str, size: int, turn: int = 0) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"), turn)
    return (h >> 8) % size, 1.0 if h & 1 else -1.0


def add_slots(vector: np.ndarray, word: str) -> None:
    """Two slots per word tell more words apart than one."""
    for turn in (1, 2):
        i, sign = slot(word, len(vector), turn)
        vector[i] = min(2.0, max(-2.0, vector[i] + sign))


class Vectors:
    """Block vectors; remembers those of tag paths and the slots of words."""

    def __init__(self) -> None:
        self.paths: dict[tuple, np.ndarray] = {}
        self.words: dict[str, tuple[int, float]] = {}

    def path(self, path: tuple[tuple[str, ...], ...]) -> np.ndarray:
        found = self.paths.get(path)
        if found is None:
            found = np.zeros(OWN + PATH, dtype=np.float32)
            for word in path[-1] if path else ("none",):
                add_slots(found[:OWN], word)
            for word in dict.fromkeys(w for words in path for w in words):
                add_slots(found[OWN:], word)
            if len(self.paths) > 50_000:
                self.paths.clear()
            self.paths[path] = found
        return found

    def hashed(self, words: list[str]) -> np.ndarray:
        known = self.words
        if len(known) > 500_000:
            known.clear()
        slots = [known.get(w) or known.setdefault(w, slot(w, WORDS)) for w in set(words)]
        at, sign = np.array(slots).T if slots else (np.zeros(0), np.zeros(0))
        out = np.bincount(at.astype(np.int64), weights=sign, minlength=WORDS)
        return 0.5 * out / (len(slots) ** 0.5 + 1.5)

    def page(self, found: list[Block]) -> np.ndarray:
        out = np.zeros((len(found), INPUT), dtype=np.float32)
        for i, block in enumerate(found):
            words = block.text.lower().split()
            n = len(block.text)
            out[i, : OWN + PATH] = self.path(block.path)
            out[i, OWN + PATH : -MEASURES] = np.clip(self.hashed(words), -1, 1)
            out[i, -MEASURES:] = (
                np.log1p(n) / 6,
                np.log1p(len(words)) / 4,
                block.linked / n,
                min(1.0, 20 * sum(map(block.text.count, ".,;:!?")) / n),
                n < 40,
                block.text[-1] in ".!?",
                i / max(1, len(found) - 1),
                min(len(found), 100) / 100,
            )
        return out


# -- the model ----------------------------------------------------------------------------


class Model(NamedTuple):
    """Weights of both directions (input, state, bias) and of the logistic unit."""

    fx: np.ndarray
    fh: np.ndarray
    fb: np.ndarray
    bx: np.ndarray
    bh: np.ndarray
    bb: np.ndarray
    o: np.ndarray
    ob: np.ndarray


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gates(z: np.ndarray, c: np.ndarray):
    i, f, o = (sigmoid(z[..., k * STATE : (k + 1) * STATE]) for k in range(3))
    g = np.tanh(z[..., 3 * STATE :])
    c = f * c + i * g
    return i, f, o, g, c, np.tanh(c)


def states(pages: list[np.ndarray], wx, wh, b, backward: bool) -> list[np.ndarray]:
    """Hidden states of each page's blocks; ``pages`` by falling length."""
    lengths = np.array([len(p) for p in pages])
    out = [np.empty((n, STATE), dtype=np.float32) for n in lengths]
    h = np.zeros((len(pages), STATE), dtype=np.float32)
    c = h.copy()
    step = max(1, CELLS // len(pages))
    for start in range(0, int(lengths.max(initial=0)), step):
        live = int((lengths > start).sum())
        width = min(step, int(lengths[0]) - start)
        x = np.zeros((width, live, INPUT), dtype=np.float32)
        for k in range(live):
            page = pages[k][::-1] if backward else pages[k]
            part = page[start : start + width]
            x[: len(part), k] = part
        z = x @ wx + b
        for t in range(width):
            n = int((lengths[:live] > start + t).sum())
            *_, o, g, cell, squashed = gates(z[t, :n] + h[:n] @ wh, c[:n])
            c[:n] = cell
            h[:n] = o * squashed
            for k in range(n):
                out[k][start + t] = h[k]
    return [s[::-1] for s in out] if backward else out


def scores(pages: list[np.ndarray], model: Model) -> list[np.ndarray]:
    """The log odds of each block of each page to be main text."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.float32)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: -len(pages[i]))
    at = 0
    while at < len(order):
        # As many pages of similar length as the bound on cells allows.
        many = max(1, min(64, CELLS // len(pages[order[at]])))
        part = order[at : at + many]
        batch = [pages[i] for i in part]
        ahead = states(batch, model.fx, model.fh, model.fb, False)
        behind = states(batch, model.bx, model.bh, model.bb, True)
        for i, x, f, b in zip(part, batch, ahead, behind, strict=True):
            out[i] = f @ model.o[:STATE] + b @ model.o[STATE : 2 * STATE] + x @ model.o[2 * STATE :]
            out[i] += model.ob
        at += many
    return out


def trained(seed: int = SEED) -> Model:
    """Fit the model on generated pages by Adam over whole pages."""
    writer, rng = random.Random(seed), np.random.default_rng(seed)
    vectors = Vectors()
    data = []
    for _ in range(PAGES):
        found = blocks(sample_page(writer))
        label = np.array([MARK in b.text for b in found], dtype=np.float32)
        found = [b._replace(text=" ".join(b.text.replace(MARK, "").split()) or "-") for b in found]
        data.append((vectors.page(found), label))
    data.sort(key=lambda page: len(page[1]))
    scale = lambda *s: (rng.standard_normal(s) / np.sqrt(s[-2])).astype(np.float32)
    # Both directions side by side, so that they run in the same steps.
    weights = [
        scale(2, INPUT, 4 * STATE),
        scale(2, STATE, 4 * STATE),
        np.zeros((2, 1, 4 * STATE), dtype=np.float32),
        scale(2 * STATE + INPUT, 1)[:, 0] * np.float32(0.1),
        np.zeros(1, dtype=np.float32),
    ]
    weights[2][..., STATE : 2 * STATE] = 1
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    batches = [data[at : at + BATCH] for at in range(0, PAGES, BATCH)]
    turn, turns = 0, EPOCHS * len(batches)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(batches)).tolist():
            turn += 1
            rate = 0.012 * (1 - turn / turns) + 0.0005
            grads = gradients(batches[k], weights, rng)
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-7)
                w -= 0.002 * rate * w
    wx, wh, b, o, ob = weights
    return Model(wx[0], wh[0], b[0, 0], wx[1], wh[1], b[1, 0], o, ob)


def gradients(
    batch: list[tuple[np.ndarray, np.ndarray]], weights: list[np.ndarray], rng: np.random.Generator
) -> list[np.ndarray]:
    """Gradients of the mean log loss, through both directions.

    The words of half of the blocks are hidden, lest the model learns them by heart.
    """
    wx, wh, b, o, ob = weights
    width, n = max(len(x) for x, _ in batch), len(batch)
    x = np.zeros((width, n, INPUT), dtype=np.float32)
    y = np.zeros((width, n), dtype=np.float32)
    mask = np.zeros((width, n), dtype=np.float32)
    back = np.zeros((width, n), dtype=np.int64)
    for k, (page, label) in enumerate(batch):
        m = len(page)
        x[:m, k], y[:m, k], mask[:m, k] = page, label, 1
        back[:, k] = np.r_[np.arange(m)[::-1], np.arange(m, width)]
    x[..., OWN + PATH : -MEASURES] *= rng.random((width, n, 1)) > 0.5
    columns = np.arange(n)
    both = np.stack((x, x[back, columns]), axis=1)  # step, direction, page, input
    z = np.matmul(both, wx) + b
    hidden = np.zeros((width + 1, 2, n, STATE), dtype=np.float32)
    cells = np.zeros_like(hidden)
    saved = []
    for t in range(width):
        step = gates(z[t] + np.matmul(hidden[t], wh), cells[t])
        live = live_at(mask, t)
        cells[t + 1] = np.where(live, step[4], cells[t])
        hidden[t + 1] = np.where(live, step[2] * step[5], hidden[t])
        saved.append(step)
    behind = hidden[1:, 1][back, columns]
    features = np.concatenate((hidden[1:, 0], behind, x), axis=2)
    error = (sigmoid(features @ o + ob) - y) * mask / mask.sum()
    d_features = error[..., None] * o[: 2 * STATE]
    d_hidden = np.stack(
        (d_features[..., :STATE], d_features[..., STATE:][back, columns]), axis=1
    )
    dz = np.zeros_like(z)
    dh = np.zeros((2, n, STATE), dtype=np.float32)
    dc = dh.copy()
    for t in range(width - 1, -1, -1):
        i, f, out, g, _, squashed = saved[t]
        live = live_at(mask, t)
        d = (dh + d_hidden[t]) * live
        d_cell = dc * live + d * out * (1 - squashed**2)
        dz[t] = np.concatenate(
            (
                d_cell * g * i * (1 - i),
                d_cell * cells[t] * f * (1 - f),
                d * squashed * out * (1 - out),
                d_cell * i * (1 - g**2),
            ),
            axis=2,
        )
        dh = np.matmul(dz[t], wh.transpose(0, 2, 1)) + dh * ~live
        dc = d_cell * f + dc * ~live
    side = lambda a: a.transpose(1, 0, 2, 3).reshape(2, width * n, -1)
    dz_side = side(dz)
    return [
        np.matmul(side(both).transpose(0, 2, 1), dz_side),
        np.matmul(side(hidden[:-1]).transpose(0, 2, 1), dz_side),
        dz_side.sum(axis=1, keepdims=True),
        features.reshape(-1, 2 * STATE + INPUT).T @ error.ravel(),
        np.array([error.sum()], dtype=np.float32),
    ]


def live_at(mask: np.ndarray, t: int) -> np.ndarray:
    return (mask[t] > 0)[None, :, None]


# -- generated pages ------------------------------------------------------------------------

#: Marks main text in generated pages.
MARK = "\x01"
SYLLABLES = "the an in er on re ed nd ha at en es of nt ea ti to it st io le is ou ar as de rt ve é ü ción ß ch ung".split()
MENUS = ("nav", "menu", "navbar", "navigation", "main-menu", "topbar", "breadcrumb", "breadcrumbs", "tabs", "toolbar")
HEADS = ("header", "site-header", "masthead", "page-header", "top", "branding", "logo")
ADS = ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "ad-slot", "adbox", "sponsor")
NOTICES = ("notice", "cookie", "cookie-banner", "alert", "gdpr", "consent", "banner", "message", "popup", "modal", "paywall", "announcement")
SIDES = ("sidebar", "widget", "related", "recommended", "popular", "trending", "side", "rail", "aside", "tags", "archive", "read-more")
TALKS = ("comments", "comment-list", "responses", "discussion", "replies", "comment", "disqus", "reader-comments", "user-comments", "reviews")
SHARES = ("share", "social", "sharing", "share-buttons", "follow", "author-bio", "newsletter", "subscribe")
FEET = ("footer", "site-footer", "page-footer", "copyright", "legal", "colophon", "bottom")
MAINS = ("content", "post", "entry", "entry-content", "article", "article-body", "story", "text", "post-content", "main", "body-text", "main-content", "blog-post")
NEUTRAL = ("wrapper", "container", "row", "col", "page", "inner", "box", "grid", "layout", "block", "region", "outer", "site", "root", "app")


@lru_cache(1)
def vocabulary() -> list[str]:
    rng = random.Random(SEED)
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(6000)]


def prose(rng: random.Random, low: int, high: int) -> str:
    words = rng.choices(vocabulary(), k=rng.randint(low, high))
    if rng.random() < 0.05:  # pages of any kind may repeat themselves
        words = (words[: rng.randint(1, 3)] * len(words))[: len(words)]
    for i in range(len(words)):
        if rng.random() < 0.3:
            words[i] += rng.choice(",.")
    text = " ".join(words)
    return text[:1].upper() + text[1:] + rng.choice([".", ".", ".", "", "!", "?"])


def named(rng, names: tuple[str, ...], tags: tuple[str, ...], inner: str) -> str:
    """An element that a class or id names, or only its own tag if that says enough."""
    tag, name = rng.choice(tags), rng.choice(names)
    plain = tag in ("nav", "header", "footer", "aside", "article", "main", "form")
    if plain and rng.random() < 0.4:
        return f"<{tag}>{inner}</{tag}>"
    extra = f" {rng.choice(NEUTRAL)}" if rng.random() < 0.3 else ""
    if rng.random() < 0.2:
        name = name.replace("-", "_") if rng.random() < 0.5 else name.title().replace("-", "")
    kind = "id" if rng.random() < 0.25 else "class"
    return f'<{tag} {kind}="{name}{extra}">{inner}</{tag}>'


def links(rng, low: int, high: int) -> str:
    items = [f'<a href="/{i}">{prose(rng, 1, 4)}</a>' for i in range(rng.randint(low, high))]
    if rng.random() < 0.75:
        return "<ul>" + "".join(f"<li>{a}</li>" for a in items) + "</ul>"
    return rng.choice([" | ", " ", "<br>", " &middot; "]).join(items)


def small(rng) -> str:
    """Short texts of any part that is not the article."""
    kind = rng.random()
    if kind < 0.4:
        return prose(rng, 3, 25)
    if kind < 0.7:
        return f"<p>{prose(rng, 4, 40)}</p>"
    return f"<h3>{prose(rng, 1, 4)}</h3>" + (links(rng, 2, 6) if rng.random() < 0.6 else f"<p>{prose(rng, 5, 30)}</p>")


def form(rng) -> str:
    inner = f"<label>{prose(rng, 1, 3)}</label><input><button>{rng.choice(['Send', 'Subscribe', 'Search', 'Sign up', 'Post'])}</button>"
    if rng.random() < 0.4:
        inner = f"<p>{prose(rng, 3, 15)}</p><select><option>{prose(rng, 1, 2)}<option>{prose(rng, 1, 2)}</select>" + inner
    return f"<form>{inner}</form>" if rng.random() < 0.7 else named(rng, SHARES, ("form", "div"), inner)


def talk(rng) -> str:
    """Reader comments, as long as paragraphs of an article."""
    each = "".join(
        named(rng, ("comment", "reply", "comment-body", "response"), ("div", "li", "article"),
              f"<p>{prose(rng, 5, 60)}</p>" + (f"<span>{prose(rng, 1, 3)}</span>" if rng.random() < 0.5 else ""))
        if rng.random() < 0.7 else f"<p>{prose(rng, 5, 60)}</p>"
        for _ in range(rng.randint(1, 5))
    )
    head = f"<h3>{rng.choice(['Comments', '3 comments', 'Discussion', 'Leave a reply', 'Responses'])}</h3>"
    return named(rng, TALKS, ("div", "section", "ol", "aside"), head * (rng.random() < 0.7) + each + (form(rng) if rng.random() < 0.3 else ""))


def passage(rng) -> str:
    """One part of an article."""
    kind, words = rng.random(), lambda a, b: MARK + prose(rng, a, b).replace(". ", f". {MARK}")
    if kind < 0.62:
        text = words(1, 110)
        if rng.random() < 0.3:
            text = f"<b>{text}<br>" if rng.random() < 0.6 else f'{text} <a href="/x">{prose(rng, 1, 3)}</a> {prose(rng, 1, 20)}'
        return f"<p>{text}" + ("</p>" if rng.random() < 0.85 else "")
    if kind < 0.72:
        return f"<h2>{words(1, 7)}</h2>"
    if kind < 0.8:
        return "<ul>" + "".join(f"<li>{words(1, 20)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
    if kind < 0.86:
        return f"<blockquote>{words(4, 40)}</blockquote>"
    if kind < 0.9:
        return f"<pre>{words(2, 20)}</pre>"
    if kind < 0.94:
        return "<table><tr><td>" + "</td><td>".join(words(1, 4) for _ in range(3)) + "</td></tr></table>"
    if kind < 0.97:
        return f"<div>{words(5, 60)}</div>"
    return f"<figure><figcaption>{words(3, 15)}</figcaption></figure>"


def other(rng) -> str:
    """One part of a page that is not its article."""
    kind = rng.random()
    if kind < 0.25:
        return named(rng, ADS, ("div", "aside", "section", "div"), small(rng))
    if kind < 0.45:
        return named(rng, NOTICES, ("div", "section", "aside", "p", "dialog"), prose(rng, 3, 30))
    if kind < 0.7:
        return named(rng, SIDES, ("aside", "div", "section"), "".join(small(rng) for _ in range(rng.randint(1, 3))))
    if kind < 0.85:
        return form(rng)
    return named(rng, SHARES, ("div", "section", "ul"), links(rng, 2, 5))


def sample_page(rng: random.Random) -> str:
    """A page whose main text is marked sentence by sentence."""
    some = lambda p, make: make() if rng.random() < p else ""
    if rng.random() < 0.05:  # nothing but text
        if rng.random() < 0.5:
            return MARK + prose(rng, 1, 150)
        return "".join(passage(rng) for _ in range(rng.randint(1, 8)))
    article = some(0.75, lambda: f"<h1>{MARK}{prose(rng, 2, 12)}</h1>")
    for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 14])):
        article += passage(rng) + some(0.1, lambda: other(rng))
    plain = rng.random() < 0.08
    if not plain:
        article = named(rng, MAINS, ("article", "main", "div", "section", "article", "div"), article)
        article = some(0.3, lambda: f"<main>{article}</main>") or article
    head = some(0.55, lambda: named(rng, HEADS, ("header", "div"), prose(rng, 1, 8) + some(0.4, lambda: links(rng, 2, 5))))
    menu = some(0.75, lambda: named(rng, MENUS, ("nav", "div", "nav", "ul"), links(rng, 3, 9)))
    before = "".join(other(rng) for _ in range(rng.choice([0, 1, 1, 2])))
    after = "".join(other(rng) for _ in range(rng.choice([0, 0, 1, 2])))
    comments = some(0.4, lambda: talk(rng))
    inside = some(0.3, lambda: comments)
    if inside and article.endswith("</article>"):
        article, comments = article[: -len("</article>")] + comments + "</article>", ""
    note = some(0.7, lambda: f"&copy; {prose(rng, 2, 25)}") or prose(rng, 3, 40)
    foot = some(0.8, lambda: named(rng, FEET, ("footer", "div", "footer"), note + some(0.4, lambda: links(rng, 2, 6))))
    body = head + menu + before + article + after + comments + foot
    if rng.random() < 0.06:  # laid out as a table
        cells = [menu, before + article + comments, after]
        kinds = [rng.choice(("", f' class="{rng.choice(names)}"')) for names in (MENUS, MAINS, SIDES)]
        row = "".join(f"<td{kind}>{cell}</td>" for kind, cell in zip(kinds, cells) if cell)
        body = f"{head}<table><tr>{row}</tr></table>{foot}"
    for _ in range(rng.randint(0, 2)):
        body = f'<div class="{rng.choice(NEUTRAL)}">{body}</div>'
    return f"<!DOCTYPE html><html><head><title>{prose(rng, 2, 6)}</title></head><body>{body}" + some(0.85, lambda: "</body></html>")


# -- extraction -----------------------------------------------------------------------------


@lru_cache(1)
def model() -> Model:
    return trained()


def main_texts(pages: Iterable[str | None], fitted: Model, vectors: Vectors) -> list[str]:
    """The main text of each page."""
    found = [blocks(p or "") for p in pages]
    judged = scores([vectors.page(f) for f in found], fitted)
    return [
        " ".join(b.text for b, s in zip(f, j.tolist(), strict=True) if s > 0)
        for f, j in zip(found, judged, strict=True)
    ]


def extract(df: DataFrame, html_column: str, keep: list[str]) -> DataFrame:
    """``keep``, ``text`` (the main text, empty if none) and ``n_chars`` (its code points).

    A null page has no text; repeated rows stay; an empty table gives no rows; pages of
    any length are read whole. Rows are mapped without a shuffle; the weights, a few
    dozen kilobytes, go to the tasks.
    """
    fitted = df.sparkSession.sparkContext.broadcast(tuple(model()))

    def make():
        weights, vectors = Model(*fitted.value), Vectors()

        def rows(pages):
            texts = main_texts(pages, weights, vectors)
            return texts, list(map(len, texts))

        return rows

    return map_rows(df, keep, [html_column], "text string, n_chars bigint", make)

"""HTML extraction by a recurrent block labeller.

A page becomes the sequence of its leaf blocks (text between block-level tags), each with the elements above it. A
bidirectional LSTM in numpy reads hashed tag-path and word vectors and a few numbers for each leaf and labels every
block as main text or not, with the whole page as context; the main blocks are joined by newlines. Names (classes, ids,
roles) on html and body are not read, and elements that hold over half of a page's text have path tokens of their own: a name
on a wrapper says little about what it wraps.

The labeller is trained at the start of the query: on at most `sample` pages (the first by hash of page_id and url, none
over `most_bytes`; parameters), labelled by the meaning of their tags and class names, and on `drawn` page layouts drawn
at random with known labels and the words of these pages: some without any names, some wrapped into forms, most with
names on wrappers that mislead. Training is seeded, so equal samples give equal weights; they are about a MB at any input
size. With `weights`, a folder, they are read from there, or written there if nothing is there yet, so that a labeller
is trained once for many runs. Extraction itself covers every page and every block.

Scripts, styles, closed titles and text areas, and closed SKIPPED elements are no text; formulas and what objects hold are.

Cases: null or empty html gives empty text; unclosed, stray or cut-off markup is read as far as it goes; of elements
nested deeper than DEPTH the innermost DEPTH count (no text is lost); a page without a main block gives empty text; repeated
pages give equal rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import batches, hash_sample

SAMPLE, MOST_BYTES, DRAWN, SEED, DEPTH = 300, 100_000, 1400, 11, 32

# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img math mi mo mn ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mstyle mpadded menclose mtable mtr mtd semantics".split())
#: Left out with what they hold, where they are closed; a self-closed or unclosed one is an empty element.
SKIPPED = frozenset("noscript template svg iframe select canvas audio video title textarea".split())
CLOSES_ITSELF = {"p": "p", "li": "li", "dt": "dt", "dd": "dd", "tr": "tr", "td": "td", "th": "th", "option": "option"}
LIMITS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "p": ("div", "td", "li", "article", "section", "body")}
#: Elements whose names say nothing.
NAMELESS = frozenset(("html", "body"))
# Words in tags, classes and ids that tell what a block is not, and what it is.
BOILER = frozenset("nav menu header footer aside sidebar ad ads advert advertisement banner sponsor sponsored promo cookie consent notice alert popup modal form search newsletter subscribe login share social related breadcrumb pagination pager widget toolbar button input select copyright legal".split())
NEVER_MAIN = frozenset("nav footer aside button select comment comments reply respond disqus".split())
MAIN = frozenset("article main content post entry story blockquote".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)(?=[\s/>])[^<>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-z][a-z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*)>"""
    r"|<(/?)([a-z][a-z0-9:-]*)([^<>]*)>"
    r"|<[!?][^<>]*>"
    r"|</?[a-z][^<>]*\Z",
    re.S | re.I,
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
CLOSE = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in SKIPPED}

Element = tuple[str, tuple[str, ...], bool]  # tag, names, whether it holds over half of the page's text
Leaf = tuple[tuple[Element, ...], str, int]  # the elements above, outermost first; text; characters within links


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    return tuple(w for m in NAMED.finditer(attributes) for w in WORD.findall(HUMP.sub(" ", m[2] or m[3] or m[4] or "").lower()))


def leaves(page: str | None) -> list[Leaf]:
    """The text blocks of a page in order."""
    if not page:
        return []
    stack: list[tuple[str, int]] = []  # tag and number of every open element
    opened: Counter = Counter()
    elements: list[tuple[str, tuple[str, ...]]] = []
    held: list[int] = []  # characters below each element
    out: list[tuple[tuple[int, ...], str, int]] = []
    text: list[str] = []
    linked, links, last = 0, 0, 0
    endless: set[str] = set()  # hidden elements that no tag closes from here on

    def flush():
        nonlocal linked
        if text:
            block = " ".join(entities.unescape("".join(text)).split())
            if block:
                path = tuple(k for tag, k in stack[-DEPTH:] if tag not in INLINE)
                for k in path:
                    held[k] += len(block)
                out.append((path, block, linked))
            text.clear()
        linked = 0

    def shut(tag: str, limits: tuple[str, ...]):
        if not opened[tag]:
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                if tag not in INLINE:
                    flush()
                opened.subtract(t for t, _ in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in limits:
                return

    while m := TOKEN.search(page, last):
        if m.start() > last:
            piece = page[last : m.start()]
            text.append(piece)
            linked += len(piece) if links else 0
        last = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        if m[2] or m[5]:
            if tag == "a":
                links = max(0, links - 1)
            if tag not in INLINE:
                flush()
            shut(tag, ())
            continue
        attributes = m[4] or m[7] or ""
        empty = attributes.endswith("/")
        if tag in SKIPPED:
            end = None if empty or tag in endless else CLOSE[tag].search(page, last)
            if end:
                last = end.end()
            elif not empty:
                endless.add(tag)
            continue
        if tag not in INLINE:
            flush()
        if tag == "object" or tag == "math" and empty:  # what an object holds stands for it and is read as if it stood alone
            continue
        if tag in CLOSES_ITSELF:
            shut(CLOSES_ITSELF[tag], LIMITS[tag])
        if tag in VOID:
            continue
        if tag == "a":
            links += 1
        stack.append((tag, len(elements)))
        opened[tag] += 1
        elements.append((tag, () if tag in NAMELESS else _names(attributes)))
        held.append(0)
    if last < len(page):
        text.append(page[last:])
        linked += len(page) - last if links else 0
    flush()
    half = sum(len(block) for _, block, _ in out) / 2
    whole = [(tag, names, n > half) for (tag, names), n in zip(elements, held, strict=True)]
    return [(tuple(whole[k] for k in path), block, n) for path, block, n in out]


def meant(path: tuple[Element, ...]) -> int:
    """What tag and class names say of a block: 1 main text, 0 not, -1 nothing. Inner elements say more than outer ones."""
    if any(NEVER_MAIN.intersection((tag, *names)) for tag, names, _ in path):
        return 0
    tags = [tag for tag, _, _ in path]
    for k in range(len(path) - 1, -1, -1):
        tag, names, wide = path[k]
        if tag in ("article", "main"):
            return 1
        if tag == "header" and ("article" in tags[:k] or "main" in tags[:k]):
            continue
        main, boiler = MAIN.intersection((tag, *names)), BOILER.intersection((tag, *names))
        if main and not boiler:
            return 1
        if boiler and not wide:
            return 0
    return -1


# --- the network ---------------------------------------------------------------------------------------------------

PATHS, WORDS, PATH_DIM, WORD_DIM, NUMBERS, HIDDEN = 8192, 4096, 20, 8, 10, 20


def _hash(token: str, size: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % size


#: Multipliers of the bytes of a word, and the bytes that don't count.
POWERS = np.cumprod(np.r_[np.uint32(1), np.full(63, 2654435761, np.uint32)], dtype=np.uint32)
STOPS = np.isin(np.arange(256), list(b".,;:!?"))


def hash_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the blank-separated words of non-empty texts, lower-cased and without stops; words in each text."""
    raw = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass").lower(), np.uint8)
    ends_text, gap = raw == 10, (raw == 32) | (raw == 10)
    starts = np.r_[0, np.flatnonzero(gap) + 1]
    sizes = np.diff(np.r_[starts, len(raw) + 1])
    place = np.arange(len(raw)) - np.repeat(starts, sizes)[: len(raw)]
    value = np.where(gap | STOPS[raw], 0, (raw.astype(np.uint32) + 1) * POWERS[place % 64])
    h = np.add.reduceat(value, starts, dtype=np.uint32)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
    counts = np.diff(np.r_[0, np.cumsum(gap)[np.flatnonzero(ends_text)], len(starts)])
    return ((h >> np.uint32(16)) % WORDS).astype(np.int64), counts


class Reader:
    """Leaves to hashed features, remembering paths."""

    def __init__(self):
        self.paths: dict[tuple, np.ndarray] = {}

    def path(self, path: tuple[Element, ...]) -> np.ndarray:
        got = self.paths.get(path)
        if got is None:
            found = {f"leaf {path[-1][0] if path else ''}"}
            for tag, names, wide in path:
                mark = "wide " if wide else ""
                if tag not in NAMELESS:
                    found.add(mark + tag)
                found.update(f"{mark}.{n}" for n in names)
            got = np.array(sorted({_hash(x, PATHS) for x in found}))
            if len(self.paths) < 50_000:
                self.paths[path] = got
        return got

    def page(self, blocks: list[Leaf]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        """Path hashes by block, word hashes of all blocks, words in each block, numbers by block."""
        words, count = hash_words([t for _, t, _ in blocks])
        n = np.array([len(t) for _, t, _ in blocks], np.float32)
        linked = np.array([k for _, _, k in blocks], np.float32)
        stops = np.array([t.count(".") + t.count(",") for _, t, _ in blocks], np.float32)
        at = np.arange(len(blocks), dtype=np.float32) / max(1, len(blocks))
        ends = np.array([t[-1] in ".!?\u3002" for _, t, _ in blocks], np.float32)
        prose = np.maximum(0, n - linked)
        numbers = np.stack([np.log1p(n) / 6, np.log1p(count) / 5, np.minimum(1, linked / n), np.minimum(1, stops / count), at, 1 - at, ends, np.log1p(prose) / np.log1p(max(1, prose.max())), n / max(1, n.sum()), np.full(len(n), np.log1p(len(n)) / 5)], axis=1)
        return [self.path(p) for p, _, _ in blocks], words, count, numbers.astype(np.float32)


def _means(table: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(table[rows], np.r_[0, np.cumsum(sizes)[:-1]], axis=0) / sizes[:, None]


def _scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of values by row."""
    return np.stack([np.bincount(rows, values[:, d], size) for d in range(values.shape[1])], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Embeddings of path and words, one LSTM each way, a logistic output for each block."""

    def __init__(self, seed: int = SEED):
        rng, width = np.random.default_rng(seed), PATH_DIM + WORD_DIM + NUMBERS
        self.w = {"path": rng.normal(0, 0.3, (PATHS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORDS, WORD_DIM)), "out": rng.normal(0, 0.2, (2 * HIDDEN + width, 1)), "bias": np.zeros(1)}
        for way in "fb":
            self.w[f"x{way}"] = rng.normal(0, width**-0.5, (width, 4 * HIDDEN))
            self.w[f"h{way}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            self.w[f"c{way}"] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def inputs(self, pages: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Pages as Reader.page gives them to (time, page, width) and a mask."""
        steps = max(len(p[0]) for p in pages)
        x = np.zeros((steps, len(pages), PATH_DIM + WORD_DIM + NUMBERS), np.float32)
        mask = np.zeros((steps, len(pages), 1), np.float32)
        paths = [r for p in pages for r in p[0]]
        path = _means(self.w["path"], np.concatenate(paths), np.array([len(r) for r in paths]))
        word = _means(self.w["word"], np.concatenate([p[1] for p in pages]), np.concatenate([p[2] for p in pages]))
        at = 0
        for k, (own, _, _, numbers) in enumerate(pages):
            n = len(own)
            x[:n, k] = np.concatenate([path[at : at + n], word[at : at + n], numbers], axis=1)
            mask[:n, k] = 1
            at += n
        return x, mask

    def run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool = False):
        steps, pages, _ = x.shape
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
        pre = x @ self.w[f"x{way}"] + self.w[f"c{way}"]
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = pre[t] + h @ self.w[f"h{way}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            lit = np.tanh(new)
            m = mask[t]
            if keep:
                kept.append((t, h, c, i, f, o, g, lit))
            c, h = m * new + (1 - m) * c, m * o * lit + (1 - m) * h
            out[t] = h
        return out, kept

    def chances(self, pages: list[tuple]) -> np.ndarray:
        x, mask = self.inputs(pages)
        joined = np.concatenate([self.run(x, mask, "f")[0], self.run(x, mask, "b")[0], x], axis=2)
        return _sigmoid(joined @ self.w["out"] + self.w["bias"])[:, :, 0]

    def gradients(self, pages: list[tuple], labels: list[np.ndarray]) -> tuple[dict, float]:
        x, mask = self.inputs(pages)
        (hf, kf), (hb, kb) = self.run(x, mask, "f", True), self.run(x, mask, "b", True)
        joined = np.concatenate([hf, hb, x], axis=2)
        p = _sigmoid(joined @ self.w["out"] + self.w["bias"])
        y = np.zeros_like(p)
        for k, lab in enumerate(labels):
            y[: len(lab), k, 0] = lab
        total = mask.sum()
        loss = float((-(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)) * mask).sum() / total)
        d = (p - y) * mask / total
        grad = {"out": np.einsum("tbi,tbo->io", joined, d), "bias": d.sum(axis=(0, 1))}
        dj = d @ self.w["out"].T
        dx = dj[:, :, 2 * HIDDEN :].copy()
        for way, kept, dh_out in (("f", kf, dj[:, :, :HIDDEN]), ("b", kb, dj[:, :, HIDDEN : 2 * HIDDEN])):
            wh = self.w[f"h{way}"]
            gh, dz_all = np.zeros_like(wh), np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh, dc = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, h0, c0, i, f, o, g, lit in reversed(kept):
                m = mask[t]
                dh = dh + dh_out[t]
                dn, dnew = dh * m, dc * m
                dnew = dnew + dn * o * (1 - lit * lit)
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c0 * f * (1 - f), dn * lit * o * (1 - o), dnew * i * (1 - g * g)], axis=1)
                dz_all[t] = dz
                gh += h0.T @ dz
                dh, dc = dz @ wh.T + dh * (1 - m), dnew * f + dc * (1 - m)
            grad[f"h{way}"], grad[f"c{way}"] = gh, dz_all.sum(axis=(0, 1))
            grad[f"x{way}"] = np.einsum("tbi,tbo->io", x, dz_all)
            dx += dz_all @ self.w[f"x{way}"].T
        paths = [r for p in pages for r in p[0]]
        sizes, counts = np.array([len(r) for r in paths]), np.concatenate([p[2] for p in pages])
        own = np.concatenate([dx[: len(p[0]), k] for k, p in enumerate(pages)])
        gp = _scatter(np.concatenate(paths), np.repeat(own[:, :PATH_DIM] / sizes[:, None], sizes, axis=0), PATHS)
        gw = _scatter(np.concatenate([p[1] for p in pages]), np.repeat(own[:, PATH_DIM : PATH_DIM + WORD_DIM] / counts[:, None], counts, axis=0), WORDS)
        return grad | {"path": gp, "word": gw}, loss

    def fit(self, pages: list[tuple], labels: list[np.ndarray], rounds: int = 10, group: int = 40, rate: float = 0.02, seed: int = SEED) -> float:
        """Adam over shuffled groups of pages of like length; returns the last mean loss. Tokens that no page has get vector 0."""
        rng, loss = np.random.default_rng(seed), 0.0
        m, v, step = {k: np.zeros_like(x) for k, x in self.w.items()}, {k: np.zeros_like(x) for k, x in self.w.items()}, 0
        order = np.argsort([len(p[0]) for p in pages], kind="stable")
        groups = [order[i : i + group] for i in range(0, len(order), group)]
        for turn in range(rounds):
            losses = []
            for k in rng.permutation(len(groups)):
                grad, one = self.gradients([pages[i] for i in groups[k]], [labels[i] for i in groups[k]])
                losses.append(one)
                step += 1
                size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                now = rate * 0.5 ** (turn / 3)
                for name, g in grad.items():
                    g = g.astype(np.float32) * min(1.0, 5 / (size + 1e-9))
                    m[name], v[name] = 0.9 * m[name] + 0.1 * g, 0.99 * v[name] + 0.01 * g * g
                    self.w[name] -= now * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)
            loss = float(np.mean(losses))
        for name in ("path", "word"):
            self.w[name][~v[name].any(axis=1)] = 0
        return loss


# --- training pages ------------------------------------------------------------------------------------------------

# The tags and names that areas of a page go by, and stock phrases.
AREAS = {
    "nav": ("nav nav div ul section", "nav navbar navigation menu topnav breadcrumb breadcrumbs tabs links sitemap menubar submenu dropdown crumbs"),
    "header": ("header header div section", "header masthead topbar banner brand branding logo head top"),
    "footer": ("footer footer div section", "footer foot bottom copyright colophon legal credits contentinfo"),
    "side": ("aside aside div section", "sidebar side aside widget widgets related recommended trending popular rail complementary latest also teaser"),
    "notice": ("div div p section", "cookie cookies consent gdpr notice alert popup modal overlay toast announcement notification paywall privacy"),
    "ad": ("div div aside section p", "ad ads advert advertisement adsbygoogle adsense sponsor sponsored promo promotion promoted adslot adbox"),
    "form": ("form form div", "form search newsletter subscribe signup login register contact searchbox subscription"),
    "comment": ("div section ol ul", "comments comment disqus thread replies reply respond discussion responses commentlist reader"),
    "share": ("div ul div", "share sharing social toolbar pagination pager buttons tools follow"),
}
MAIN_TAGS, MAIN_NAMES = "article article article main main div div section td".split(), "content article post entry story main body text prose single detail hentry copy page".split()
MAIN_LEAF = "p p p p p p p p h2 h3 li blockquote pre td figcaption div dd -".split()
#: Runs of short blocks within the main text: what holds them, what stands round each few of them, and their tags.
RUNS = [("ul", "", ["li"]), ("ol", "", ["li"]), ("ul", "", ["li"]), ("dl", "", ["dt", "dd"]), ("table", "tr", ["th", "td"]), ("table", "tr", ["td", "td", "td"]), ("div", "figure", ["figcaption"]), ("div", "div", ["p"]), ("div", "pre", ["code"])]
RUN_NAMES = "ingredients steps instructions method recipe question answer faq list items specs table data qa notes features timeline details".split()
WRAPPERS = "wrapper container page row col site layout inner outer root app grid section box block clearfix left right center primary column area region module".split()
STATES = "has no with open fixed hide show is js top sticky full wide dark".split()
STOCK = "home about contact login sign in subscribe newsletter accept all cookies privacy policy terms of use copyright all rights reserved menu search comments reply posted by share tweet more related read next previous page top advertisement sponsored we use register password email".split()
PARENT = {"li": "ul", "td": "table><tr", "figcaption": "figure", "dd": "dl"}


def draw_page(rng: np.random.Generator, texts: list[list[str]]) -> tuple[str, np.ndarray]:
    """A page of random layout, with words taken from `texts`, and the label of each of its blocks in order."""

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def words(least: int, most: int) -> str:
        source = pick(texts)
        n = int(rng.integers(least, most + 1))
        at = int(rng.integers(max(1, len(source) - n)))
        return entities.escape(" ".join(source[at : at + n]) or "text", quote=False)

    plain = rng.random() < 0.2  # no names at all, and no tags that tell
    out: list[str] = []
    labels: list[int] = []

    def names(*given: str) -> str:
        if plain or not given:
            return ""
        how = rng.random()
        value = "-".join(given) if how < 0.4 else " ".join(given) if how < 0.7 else "".join([given[0], *(g.title() for g in given[1:])]) if how < 0.85 else "_".join(given)
        return f' {pick(["class", "class", "id", "role" if len(given) == 1 else "class"])}="{value}"'

    def noise() -> list[str]:
        """Names that tell what else a page has, as wrappers bear them."""
        return [pick(STATES), pick(AREAS[pick(list(AREAS))][1].split())][int(rng.integers(2)) :] if rng.random() < 0.35 else []

    def block(tag: str, text: str, label: int, linked: bool):
        inner = f'<a href="/{len(out)}">{text}</a>' if linked else text if rng.random() < 0.9 else f"<b>{text}</b>"
        if tag == "-":
            out.append(f"{inner}<hr>")
        elif tag[0] == "_":  # within its parent already
            out.append(f"<{tag[1:]}>{inner}</{tag[1:]}>")
        elif tag in PARENT:
            out.append(f"<{PARENT[tag]}><{tag}>{inner}</{tag}></{PARENT[tag].split('>')[0]}>")
        else:
            out.append(f"<{tag}>{inner}</{tag}>")
        labels.append(label)

    def area(kind: str):
        tags, known = AREAS[kind]
        tag = "div" if plain else pick(tags.split())
        tells = tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5
        own = [] if tells else [pick(known.split())] + [pick(WRAPPERS + known.split())] * int(rng.integers(2))
        rng.shuffle(own)
        if kind == "comment" and own and not set(own) & {"comments", "comment", "disqus", "commentlist", "respond", "replies"}:
            own = ["comments", *own]
        out.append(f"<{tag}{names(*own)}>")
        short = kind in ("nav", "share")
        if plain and kind in ("nav", "side", "share"):
            short = True
        for _ in range(1 if tag == "p" else int(rng.integers(1, 8 if kind in ("nav", "comment", "side") else 4))):
            stock = rng.random() < (1 if plain and not short else 0.4)
            text = words(1, 4) if short else " ".join(pick(STOCK) for _ in range(int(rng.integers(1, 9)))) if stock else words(2, 40)
            inside = kind == "comment" and rng.random() < 0.4
            if inside:
                out.append(f"<{pick(['article', 'div', 'li'])}{names('comment') if rng.random() < 0.6 else ''}>")
                last = out[-1][1:].split()[0].split(">")[0]
            leaf = "span" if tag == "p" else "li" if short and rng.random() < 0.6 else pick(["p", "p", "div", "h3", "h1" if kind == "header" else "h4", "li"])
            block(leaf, text, 0, short or rng.random() < 0.2)
            if inside:
                out.append(f"</{last}>")
        if tag == "form" and rng.random() < 0.5:
            out.append("<input type=text>")
        out.append(f"</{tag}>")

    def run():
        """A list, a table or the like in the main text, its items short and without links."""
        holder, group, tags = pick(RUNS)
        out.append(f"<{holder}{names(pick(RUN_NAMES)) if rng.random() < 0.35 else ''}>")
        most = int(pick([4, 8, 25]))
        for _ in range(int(rng.integers(2, 9))):
            out.append(f"<{group}{names(pick(RUN_NAMES)) if group == 'div' and rng.random() < 0.7 else ''}>" if group else "")
            for tag in tags:
                block(f"_{tag}", words(1, most), 1, False)
            out.append(f"</{group}>" if group else "")
        out.append(f"</{holder}>")

    def main():
        ends = []
        for level in range(1 + int(rng.integers(3))):
            tag = "div" if plain else pick(MAIN_TAGS) if not level else pick(["div", "section", "article", "header" if rng.random() < 0.1 else "div"])
            own = ([pick(MAIN_NAMES)] if tag in ("div", "section", "td") and not level or rng.random() < 0.4 else []) + ([pick(WRAPPERS)] if rng.random() < 0.2 else []) + noise()
            out.append((f"<table><tr><td{names(*own)}>" if tag == "td" else f"<{tag}{names(*own)}>"))
            ends.append("</td></tr></table>" if tag == "td" else f"</{tag}>")
        if rng.random() < 0.6:
            block("h1", words(1, 10), 1, False)
        for _ in range(int(rng.integers(1, 16))):
            if rng.random() < 0.14:
                run()
            block(pick(MAIN_LEAF), words(1, 4) if rng.random() < 0.15 and not plain else words(4, 90), 1, rng.random() < 0.05)
            if rng.random() < 0.06 and not plain:
                area(pick(["ad", "share", "side", "form", "notice"]))
        if rng.random() < 0.15:
            area("comment" if not plain else "share")
        out.extend(reversed(ends))

    ends = []
    for _ in range(int(rng.integers(4))):
        tag = "form" if rng.random() < 0.12 else "div"
        out.append(f"<{tag}{names(*([pick(WRAPPERS)] + noise()))}>")
        ends.append(f"</{tag}>")
    first = rng.random() < 0.1
    if first:
        main()
    for kind, chance in (("header", 0.5), ("nav", 0.8), ("notice", 0.4), ("ad", 0.5), ("side", 0.25)):
        if rng.random() < chance and not (plain and kind == "ad"):
            area(kind)
    if not first:
        main()
    for kind, chance in (("comment", 0.45), ("ad", 0.3), ("side", 0.4), ("form", 0.4), ("share", 0.2), ("notice", 0.15), ("footer", 0.8)):
        if rng.random() < chance and not (plain and kind in ("ad", "comment")):
            area(kind)
    return f"<html><body>{''.join(out)}{''.join(reversed(ends))}</body></html>", np.array(labels, np.float32)


@lru_cache(maxsize=4)
def train(pages: tuple[str, ...], drawn: int = DRAWN, seed: int = SEED, rounds: int = 10) -> Labeller:
    """The labeller of a bounded list of pages; nothing in it depends on the rest of the table."""
    rng, reader, net = np.random.default_rng(seed), Reader(), Labeller(seed)
    seqs, labels, texts = [], [], []
    for page in pages:
        blocks = leaves(page)
        told = [meant(p) for p, _, _ in blocks]
        main = 1 if 1 not in told else 0  # without any main area, what is not named otherwise is main text
        for part in range(0, len(blocks), 150):
            seqs.append(reader.page(blocks[part : part + 150]))
            labels.append(np.array([main if y < 0 else y for y in told[part : part + 150]], np.float32))
        texts += [t.split(" ") for (_, t, _), y in zip(blocks, told, strict=True) if y]
    texts = texts or [STOCK]
    for _ in range(drawn):
        page, y = draw_page(rng, texts)
        blocks = leaves(page)
        if len(blocks) == len(y):
            seqs.append(reader.page(blocks))
            labels.append(y)
    net.fit(seqs, labels, rounds)
    return net


def kept_labeller(spark, folder: str | None, make) -> Labeller:
    """The labeller stored in a folder; if there is none, or no folder is given, the one that make() trains."""
    if not folder:
        return make()
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        net = make()
        spark.createDataFrame([(name, list(x.shape), bytearray(np.ascontiguousarray(x, np.float32).tobytes())) for name, x in net.w.items()], "name string, shape array<int>, data binary").coalesce(1).write.parquet(folder)
        return net
    net = Labeller()
    net.w = {r.name: np.frombuffer(bytes(r.data), np.float32).reshape(r["shape"]) for r in spark.read.parquet(folder).collect()}
    return net


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("blocks", pa.int64()), ("kept", pa.int64())])


def extract_pages(net: Labeller, rows: list[tuple], reader: Reader, cells: int = 30_000) -> Iterator[tuple]:
    """(page_id, url, html) rows to results; pages of like length are read together, about `cells` blocks at a time."""
    blocks = [leaves(page) for _, _, page in rows]
    order = sorted((i for i in range(len(rows)) if blocks[i]), key=lambda i: len(blocks[i]))
    kept: dict[int, list[str]] = {}
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(blocks[order[end]]) <= cells:
            end += 1
        some = order[at:end]
        chance = net.chances([reader.page(blocks[i]) for i in some])
        for k, i in enumerate(some):
            kept[i] = [t for (_, t, _), c in zip(blocks[i], chance[:, k], strict=False) if c >= 0.5]
        at = end
    for i, (page_id, url, _) in enumerate(rows):
        text = "\n".join(kept.get(i, []))
        yield page_id, url, text, len(text), len(blocks[i]), len(kept.get(i, []))


def extract(table: DataFrame, sample: int = SAMPLE, drawn: int = DRAWN, seed: int = SEED, most_bytes: int = MOST_BYTES, weights: str | None = None) -> DataFrame:
    """table (page_id, url, html) -> page_id, url, text, n_chars, blocks, kept."""

    def make() -> Labeller:
        fit = table.where(F.octet_length("html") <= most_bytes).select("page_id", "url", "html")
        return train(tuple(r.html for r in hash_sample(fit, ["page_id", "url"], sample, seed)), drawn, seed)

    net = kept_labeller(table.sparkSession, weights, make)

    def rows(stream):
        reader = Reader()
        for b in stream:
            for part in range(0, b.num_rows, 500):
                yield from extract_pages(net, list(zip(*(c.to_pylist() for c in b.slice(part, 500).columns), strict=True)), reader)

    ddl = "page_id long, url string, text string, n_chars long, blocks long, kept long"
    return table.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(lambda it: batches(rows(it), RESULT, 2000), ddl)


def op6_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("blocks", "kept")

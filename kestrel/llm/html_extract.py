"""Main text of web pages: a bidirectional LSTM labels every block of a page as article or not."""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import prepare_python
from kestrel.llm.html_blocks import Block, blocks

SAMPLE_BYTES = 1 << 18  # of a page of the sample
SAMPLE_PAGES = 256  # real pages that the training pages take their words and layouts from
MADE_PAGES = 900
PATH, WORDS, SCALARS = 40, 24, 6  # widths of the three parts of a block's vector
HIDDEN = 20
EPOCHS, BATCH, RATE = 14, 32, 0.01
SEED = 7
PADDED = 1 << 15  # blocks of a padded inference batch

# fixed values: names that web authors give to parts of a page
ARTICLE = ("content", "article body", "post content", "entry content", "story", "main", "article", "post", "text", "page content")
NOT_ARTICLE = {
    "menu": ("nav", "menu", "navbar", "navigation", "breadcrumb", "tabs", "topbar", "toc"),
    "head": ("header", "masthead", "site header", "branding", "logo", "banner"),
    "foot": ("footer", "site footer", "copyright", "legal", "colophon", "bottom"),
    "side": ("sidebar", "aside", "widget", "related", "recommended", "trending", "more stories", "tags", "author box"),
    "note": ("notice", "cookie", "cookie consent", "alert", "gdpr banner", "popup", "modal", "message", "disclaimer"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad slot", "banner ad"),
    "form": ("form", "newsletter", "subscribe", "search", "login", "signup", "contact form"),
    "talk": ("comments", "comment", "comment list", "replies", "discussion", "responses", "disqus thread", "reader comments"),
    "share": ("share", "social", "byline", "meta", "post meta", "pagination", "print"),
}
PHRASES = (
    "Home", "About us", "Contact", "Read more", "Subscribe", "Sign up for our newsletter", "Log in", "Search", "Share", "Tweet",
    "We use cookies to improve this site.", "Accept", "All rights reserved.", "Terms of use", "Privacy policy", "Sponsored",
    "Advertisement", "Related articles", "Most read", "Comments", "Leave a reply", "Reply", "Your email address", "Submit",
    "Next", "Previous", "Follow us", "Posted by", "Tags", "Menu", "Skip to content", "Back to top",
)
SEMANTIC_NOT = ("nav", "footer", "aside", "form", "header", "title", "button", "select", "textarea", "menu", "dialog")

_WORD = re.compile(r"\w+")


@lru_cache(maxsize=50_000)
def _token_vector(token: str) -> np.ndarray:
    return np.random.default_rng(zlib.crc32(token.encode())).standard_normal(PATH).astype(np.float32)


@lru_cache(maxsize=20_000)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Sum of fixed random vectors of the path's tags and names; the block's own tag counts twice."""
    v = np.zeros(PATH, np.float32)
    for t in sorted(set(path)):
        v += _token_vector(t)
    own = next((t for t in reversed(path) if t[0] != "."), "")
    return (v + _token_vector("own " + own)) / 2


@lru_cache(maxsize=200_000)
def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % WORDS


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block: tag-path part, hashed-word part, and size, links, punctuation, place."""
    out = np.zeros((len(page), PATH + WORDS + SCALARS), np.float32)
    for i, b in enumerate(page):
        out[i, :PATH] = _path_vector(b.path)
        words = _WORD.findall(b.text.lower())
        counts = np.bincount([_bucket(w) for w in words], minlength=WORDS) if words else np.zeros(WORDS)
        out[i, PATH : PATH + WORDS] = np.log1p(counts)
        n = len(b.text)
        marks = sum(b.text.count(c) for c in ".,;:!?")
        out[i, PATH + WORDS :] = (np.log1p(n) / 3, b.linked, 10 * marks / n, np.log1p(len(words)) / 2, i / len(page), float(b.text[-1] in ".!?"))
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over the blocks of a page, with a logistic output per block."""

    def __init__(self, width: int = PATH + WORDS + SCALARS, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.hidden = hidden
        self.w = {}
        for d in "fb":  # forward, backward
            self.w |= {f"x{d}": init(width, 4 * hidden), f"h{d}": init(hidden, 4 * hidden), f"c{d}": np.zeros(4 * hidden, np.float32)}
            self.w[f"c{d}"][hidden : 2 * hidden] = 1
        self.w |= {"o": init(2 * hidden, 1), "s": 0.1 * init(width, 1), "b": np.zeros(1, np.float32)}

    def _run(self, x, mask, d, keep):
        """States (time, page, hidden) of one direction; ``keep`` collects what the gradient needs."""
        hd = self.hidden
        z0 = x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        h = c = np.zeros((x.shape[1], hd), np.float32)
        out = np.zeros((*x.shape[:2], hd), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            z = z0[t] + h @ self.w[f"h{d}"]
            gates, g = _sigmoid(z[:, : 3 * hd]), np.tanh(z[:, 3 * hd :])
            i, f, o = gates[:, :hd], gates[:, hd : 2 * hd], gates[:, 2 * hd :]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc))
            h, c = np.where(m, o * tc, h), np.where(m, c2, c)
            out[t] = h
        return out

    def logits(self, x, mask, keep=None):
        kept = ([], []) if keep is not None else (None, None)
        hs = np.concatenate([self._run(x, mask, d, k) for d, k in zip("fb", kept, strict=True)], axis=2)
        if keep is not None:
            keep += [hs, *kept]
        return (hs @ self.w["o"] + x @ self.w["s"])[..., 0] + self.w["b"][0]

    def gradient(self, x, mask, y):
        keep: list = []
        p = _sigmoid(self.logits(x, mask, keep))
        hs, hd = keep[0], self.hidden
        e = (np.where(mask, p - y, 0) / mask.sum()).astype(np.float32)[..., None]
        grad = {"o": np.einsum("tbh,tbo->ho", hs, e), "s": np.einsum("tbh,tbo->ho", x, e), "b": e.sum(axis=(0, 1))}
        dhs = e @ self.w["o"].T
        for d, steps, part in (("f", keep[1], dhs[..., :hd]), ("b", keep[2], dhs[..., hd:])):
            gx, gh, gc = (np.zeros_like(self.w[f"{n}{d}"]) for n in "xhc")
            dh = dc = np.zeros((x.shape[1], hd), np.float32)
            for t, h0, c0, i, f, o, g, tc in reversed(steps):
                m = mask[t][:, None]
                dh_in = dh + part[t]
                dn = np.where(m, dh_in, 0)
                dcn = np.where(m, dc, 0) + dn * o * (1 - tc**2)
                dz = np.concatenate([dcn * g * i * (1 - i), dcn * c0 * f * (1 - f), dn * tc * o * (1 - o), dcn * i * (1 - g**2)], axis=1)
                gx += x[t].T @ dz
                gh += h0.T @ dz
                gc += dz.sum(axis=0)
                dh = np.where(m, 0, dh_in) + dz @ self.w[f"h{d}"].T
                dc = np.where(m, dcn * f, dc)
            grad |= {f"x{d}": gx, f"h{d}": gh, f"c{d}": gc}
        return grad

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
        """Adam on batches of pages of similar length."""
        rng = np.random.default_rng(seed)
        m1, m2 = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        order, step = sorted(range(len(pages)), key=lambda i: len(pages[i])), 0
        parts = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for epoch in range(epochs):
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for k in rng.permutation(len(parts)):
                x, mask, y = _padded([pages[i] for i in parts[k]], [labels[i] for i in parts[k]])
                step += 1
                for n, g in self.gradient(x, mask, y).items():
                    m1[n] = 0.9 * m1[n] + 0.1 * g
                    m2[n] = 0.99 * m2[n] + 0.01 * g * g
                    self.w[n] -= rate * (m1[n] / (1 - 0.9**step)) / (np.sqrt(m2[n] / (1 - 0.99**step)) + 1e-6)
        return self

    def predict(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page, whether each block is article text; pages of similar length share a padded batch."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        part: list[int] = []
        for i in sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i])):
            if part and (len(part) + 1) * len(pages[i]) > PADDED:
                self._predict(pages, part, out)
                part = []
            part.append(i)
        if part:
            self._predict(pages, part, out)
        return out

    def _predict(self, pages, part, out):
        x, mask, _ = _padded([pages[i] for i in part])
        z = self.logits(x, mask)
        for k, i in enumerate(part):
            out[i] = z[: len(pages[i]), k] > 0


def _padded(pages, labels=None):
    n, width = max(map(len, pages)), pages[0].shape[1]
    x, mask, y = np.zeros((n, len(pages), width), np.float32), np.zeros((n, len(pages)), bool), np.zeros((n, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, True
        if labels is not None:
            y[: len(p), k] = labels[k]
    return x, mask, y


def weak_labels(page: list[Block]) -> np.ndarray | None:
    """Labels of a page whose markup names its article: blocks of ``article`` or ``main`` outside parts that are not text.

    None where the page has neither element.
    """
    if not any({"article", "main"} & set(b.path) for b in page):
        return None
    names = {f".{w}" for group in NOT_ARTICLE.values() for name in group for w in name.split()} - {".banner", ".main", ".post", ".text", ".message", ".more", ".page"}
    return np.array([bool({"article", "main"} & set(b.path)) and not ({*SEMANTIC_NOT} | names) & set(b.path) for b in page], np.float32)


class _Maker:
    """Pages with known labels: article paragraphs and page furniture in many layouts."""

    def __init__(self, texts: list[str], seed: int):
        self.rng = np.random.default_rng(seed)
        self.texts = texts

    def _one(self, xs):
        return xs[self.rng.integers(len(xs))]

    def _words(self, low: int, high: int) -> str:
        words = self._one(self.texts).split()
        n = int(self.rng.integers(low, high + 1))
        at = int(self.rng.integers(max(1, len(words) - n + 1)))
        return " ".join(words[at : at + n])

    def _open(self, kind: str) -> tuple[str, str]:
        """An element for a part of the page: by tag, or a neutral tag with a telling name."""
        tag = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}.get(kind)
        if tag and self.rng.random() < 0.4:
            return f"<{tag}>", f"</{tag}>"
        name = self._one(NOT_ARTICLE[kind])
        name = name.replace(" ", self._one((" ", "-", "_")))
        tag = tag if tag and self.rng.random() < 0.4 else self._one(("div", "section", "div", "ul" if kind in ("menu", "share") else "div"))
        return f'<{tag} {self._one(("class", "id"))}="{name}">', f"</{tag}>"

    def _part(self, kind: str) -> str:
        a, z = self._open(kind)
        short = lambda: self._one(PHRASES) if self.rng.random() < 0.5 else self._words(1, 4)
        link = lambda: f'<a href="/x">{short()}</a>'
        n = int(self.rng.integers(1, 6))
        if kind in ("menu", "share"):
            body = "".join(f"<li>{link()}</li>" for _ in range(n + 1))
            body = body if a.startswith("<ul") else f"<ul>{body}</ul>"
        elif kind == "head":
            body = f"<div>{link()}</div><p>{self._words(2, 8)}</p>" if n % 2 else f"<h1>{short()}</h1>"
        elif kind == "foot":
            body = f"<p>&copy; {self._words(1, 3)} &middot; {self._words(3, 14)}</p>" if n % 2 else f"&copy; {short()} {link()} {self._words(2, 12)}"
        elif kind == "side":
            body = f"<h3>{short()}</h3><ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>" + f"<p>{self._words(5, 30)}</p>" * (n % 2)
        elif kind == "form":
            body = f"<label>{short()}</label><input><p>{short()}</p><button>{short()}</button>"
        elif kind == "talk":
            item = lambda: f'<div class="{self._one(("comment", "comment-body", "reply", "item"))}"><b>{self._words(1, 2)}</b><p>{self._words(4, 50)}</p></div>'
            body = f"<h3>{short()}</h3>" + "".join(item() for _ in range(n))
        else:
            body = f"<p>{self._words(3, 25)}</p>" if n % 2 else self._words(3, 20)
        return a + body + z

    def _article(self) -> str:
        rng, x = self.rng, []
        r = rng.random()
        name = self._one(ARTICLE).replace(" ", self._one((" ", "-")))
        a, z = ("<article>", "</article>") if r < 0.35 else ("<main>", "</main>") if r < 0.5 else (f'<div {self._one(("class", "id"))}="{name}">', "</div>")
        x.append(f"<h1>{self._words(3, 10)}</h1>")
        for _ in range(int(rng.integers(1, 9))):
            r = rng.random()
            if r < 0.75:
                x.append(f"<p>{self._words(6, 120)}</p>")
            elif r < 0.82:
                x.append("<ul>" + "".join(f"<li>{self._words(3, 20)}</li>" for _ in range(3)) + "</ul>")
            elif r < 0.88:
                x.append(f"<h2>{self._words(2, 7)}</h2><p>{self._words(10, 60)}</p>")
            elif r < 0.92:
                x.append(f"<blockquote>{self._words(8, 40)}</blockquote>")
            elif r < 0.96:
                x.append(f"<p>{self._words(2, 8)} <a href='/y'>{self._words(1, 4)}</a> {self._words(2, 20)}<br>{self._words(2, 9)}</p>")
            else:
                x.append(f"<pre>{self._words(5, 20)}</pre>")
        marked = [f"\x00{p}\x01" for p in x]
        for kind in ("ad", "share", "side", "talk", "form", "note"):
            if rng.random() < 0.15:
                marked.insert(int(rng.integers(1, len(marked) + 1)), self._part(kind))
        return a + "".join(marked) + z

    def page(self) -> tuple[list[Block], np.ndarray]:
        rng = self.rng
        some = lambda kinds, p: [self._part(k) for k in kinds if rng.random() < p]
        body = some(("note", "head", "menu", "ad", "form", "share"), 0.45) + [self._article()] + some(("share", "talk", "side", "ad", "form", "note", "foot"), 0.5)
        if rng.random() < 0.3:
            body.insert(0, self._part("side"))
        page = f"<html><head><title>{self._words(2, 9)}</title></head><body>" + "".join(body) + "</body></html>"
        got = blocks(page.replace("\x00", "<mark0>").replace("\x01", "</mark0>"))
        labels = np.array(["mark0" in b.path for b in got], np.float32)
        return [b._replace(path=tuple(t for t in b.path if t != "mark0")) for b in got], labels


def fit(pages: list[str], made: int = MADE_PAGES, seed: int = SEED) -> Labeller | None:
    """Train on ``made`` generated pages with the sample's words, and on the sample's own pages that name their article.

    None if the sample has no text.
    """
    real = [b for b in map(blocks, pages) if b]
    texts = [x.text for b in real for x in b if len(x.text.split()) >= 8] or [x.text for b in real for x in b]
    if not texts:
        return None
    maker = _Maker(texts, seed)
    train = [maker.page() for _ in range(made)] + [(b, y) for b in real if (y := weak_labels(b)) is not None]
    return Labeller().fit([vectors(b) for b, _ in train], [y for _, y in train])


def sample_model(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", limit: int = SAMPLE_PAGES) -> Labeller | None:
    """Fit on the ``limit`` pages of at most SAMPLE_BYTES that come first in the order of a hash of their id.

    Pages whose hash is beyond what the table's length calls for are left out before any html moves, so that tasks send
    about four times ``limit`` pages in all. A table of long pages only is sampled from all pages.
    """
    n = pages.count()
    h = F.xxhash64(F.col(id_col))
    bound = F.lit(-(2.0**63) + 2.0**64 * min(1.0, 4 * limit / max(n, 1)))
    first = pages.where((h.cast("double") <= bound) & F.col(html_col).isNotNull()).select(h.alias("h"), F.col(html_col).alias("x"))
    few = first.where(F.octet_length("x") <= SAMPLE_BYTES).orderBy("h", "x").limit(limit).collect()
    return fit([r["x"] for r in few or first.orderBy("h", "x").limit(limit).collect()])


def _extract(model: Labeller | None):
    def run(batches):
        for batch in batches:
            pages = [blocks(x.as_py() or "") for x in batch.column("x")]
            keep = model.predict([vectors(p) for p in pages]) if model else [np.zeros(len(p), bool) for p in pages]
            texts = ["\n\n".join(b.text for b, k in zip(p, ks, strict=True) if k) for p, ks in zip(pages, keep, strict=True)]
            cols = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(p) for p in pages], pa.int64()), pa.array([int(k.sum()) for k in keep], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_blocks", "n_kept"])

    return run


def extract(pages: DataFrame, model: Labeller | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_kept`` for every row of ``pages``.

    A page is cut into leaf blocks (``blocks``); each block's tag path and hashed words are read by the
    model over the whole page in both directions, and the blocks it takes for article text are joined in page order by
    an empty line. Null and empty pages have empty text; repeated rows give repeated rows; an empty
    table gives an empty result; other columns are ignored.
    """
    model = model or sample_model(pages, id_col, html_col)
    prepare_python(pages.sparkSession)
    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds[id_col]}, url {kinds[url_col]}, text string, n_blocks long, n_kept long"
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("x"))
    out = rows.mapInArrow(_extract(model), schema)
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")

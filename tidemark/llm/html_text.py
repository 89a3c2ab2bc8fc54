"""Main text of web pages: a recurrent labeller over the page's text blocks.

A page becomes the sequence of its leaf blocks. Each block is read as hashed tag-path
tokens (names, classes, ids and roles of its ancestors), hashed words and a few
proportions; a bidirectional LSTM in numpy judges every block with the whole page as
context. The net is fitted on a bounded sample of pages (``SAMPLE``), labelled by
structure, in which further furniture (notices, comments, forms, ...) is planted so
that it is known by name wherever it stands.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

SAMPLE = 96
PATH_DIM, WORD_DIM, HIDDEN = 256, 32, 16
DIM = PATH_DIM + WORD_DIM + 6

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|iframe|textarea)(?=[\s/>])[^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
#: Raw text up to its end tag or the page's end.
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in ("script", "style", "iframe", "textarea")}
#: Elements whose content is no text of the page; they end where they or an ancestor close.
_SKIPPED = frozenset("svg template select noscript".split())
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt s samp small span strike strong sub sup time tt u var wbr input".split())
#: Tags whose start ends an open one of the listed kind.
_ENDS = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
_SCOPE = frozenset("article aside body div fieldset footer form header html main nav ol section table ul dl blockquote".split())
_SPACE = re.compile(r"\s+")

#: Names by which structure tells furniture and article apart in the labelled sample.
FURNITURE = frozenset("""ad ads adslot advert advertisement advertising aside banner breadcrumb breadcrumbs button byline comment comments consent
cookie cookies copyright dialog disclaimer discussion disqus feedback footer form gdpr head header legal login masthead menu menubar modal nav navbar navigation
newsletter notice notices notification outbrain pager pagination popup promo promoted promotion recommended related replies reply responses rail search share sharing
sidebar signup skip social sponsor sponsored subscribe taboola teaser title toolbar topbar warning widget""".split())
ARTICLE = ("article", "main", "content", "post", "entry", "story", "body")


def blocks(page: str) -> list[tuple[tuple[str, ...], str]]:
    """Leaf blocks in page order: tokens of the tag path, and the text with white space folded."""
    out: list[tuple[tuple[str, ...], str]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    last = 0
    skip = None  # place of the outermost skipped element in the stack

    def close() -> None:
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                out.append((tuple(t for _, tokens in stack for t in tokens), text))

    while m := _PIECE.search(page, last):
        if m.start() > last and skip is None:
            held.append(page[last : m.start()])
        last = m.end()
        if m.group(1):
            # Only in svg may such an element close itself.
            if not (skip is not None and m.group().endswith("/>") and any(t == "svg" for t, _ in stack[skip:])):
                end = _RAW_END[m.group(1).lower()].search(page, last)
                last = end.end() if end else len(page)
            continue
        name = m.group(3)
        if not name:
            continue
        name = name.lower()
        if skip is not None:
            if not m.group(2):
                if name not in _VOID and not (m.group(4) or "").endswith("/"):
                    stack.append((name, ()))
                continue
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is None:
                continue
            if at >= skip:
                del stack[at:]
                skip = None if at == skip else skip
                continue
            del stack[skip:]
            skip = None
        elif name in _SKIPPED and not m.group(2):
            if not (m.group(4) or "").endswith("/"):
                skip = len(stack)
                stack.append((name, ()))
            continue
        elif name in _SKIPPED:
            continue
        if name == "br":
            held.append(" ")
            continue
        if name not in _INLINE:
            close()
        if m.group(2):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if name in _VOID:
            continue
        ends = _ENDS.get(name) or (("p",) if name not in _INLINE else ())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in ends:
                del stack[i:]
                break
            if stack[i][0] in _SCOPE:
                break
        if not (m.group(4) or "").endswith("/"):
            stack.append((name, _tokens(name, m.group(4) or "")))
    if skip is None:
        held.append(page[last:])
    else:
        del stack[skip:]
    close()
    return out


@lru_cache(4096)
def _tokens(name: str, attributes: str) -> tuple[str, ...]:
    said = [t.lower() for groups in _NAMED.findall(attributes) for t in _TOKEN.findall(" ".join(groups))]
    return (f"<{name}>", *said)


def _hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace"))


@lru_cache(4096)
def _path(tokens: tuple[str, ...]) -> np.ndarray:
    """A path's tokens, hashed with signs; a tag and a class of one name share their slot."""
    v = np.zeros(PATH_DIM, np.float32)
    for t in set(x.strip("<>") for x in tokens):
        h = _hash(t)
        v[h % PATH_DIM] += 1.0 if h >> 20 & 1 else -1.0
    return v


def features(page: list[tuple[tuple[str, ...], str]]) -> np.ndarray:
    out = np.zeros((len(page), DIM), np.float32)
    if not page:
        return out
    words = [text.split(" ") for _, text in page]
    n = np.fromiter(map(len, words), np.int64, len(words))
    out[:, :PATH_DIM] = [_path(tokens) for tokens, _ in page]
    at = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for block in words for w in block), np.int64, n.sum()) % WORD_DIM
    counts = np.bincount(np.repeat(np.arange(len(page)) * WORD_DIM, n) + at, minlength=len(page) * WORD_DIM).reshape(len(page), WORD_DIM)
    out[:, PATH_DIM : PATH_DIM + WORD_DIM] = counts / n[:, None]
    out[:, PATH_DIM + WORD_DIM :] = [(min(len(t), 2000) / 1000, min(k, 200) / 100, t[-1] in ".!?", "<a>" in p, len(p) / 10, "<p>" in p) for (p, t), k in zip(page, n)]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a logistic output that also sees the block itself."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w = {}
        for way in "fb":
            self.w[f"x{way}"] = rng.normal(0, 0.1, (DIM, 4 * HIDDEN)).astype(np.float32)
            self.w[f"h{way}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.w[f"c{way}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)
        self.w["o"] = rng.normal(0, 0.1, (2 * HIDDEN + DIM,)).astype(np.float32)
        self.w["d"] = np.zeros(1, np.float32)

    def _run(self, fed: np.ndarray, way: str, keep: bool = False):
        """Hidden states of left-aligned sequences; ``fed[page, block]`` is the input's share of the gates."""
        pages, steps, _ = fed.shape
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        states, trace = np.zeros((pages, steps, HIDDEN), np.float32), []
        for t in range(steps):
            z = fed[:, t] + h @ self.w[f"h{way}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            was, h = h, o * np.tanh(c)
            states[:, t] = h
            if keep:
                trace.append((i, f, o, g, before, c, was))
        return states, trace

    @staticmethod
    def _flip(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        at = np.arange(x.shape[1])[None, :]
        index = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
        return x[np.arange(len(x))[:, None], index]

    def _forward(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        flat = x.reshape(-1, DIM)
        fed = {way: (flat @ self.w[f"x{way}"] + self.w[f"c{way}"]).reshape(*x.shape[:2], -1) for way in "fb"}
        ahead, one = self._run(fed["f"], "f", keep)
        back, two = self._run(self._flip(fed["b"], lengths), "b", keep)
        back = self._flip(back, lengths)
        o = self.w["o"]
        score = ahead @ o[:HIDDEN] + back @ o[HIDDEN : 2 * HIDDEN] + (flat @ o[2 * HIDDEN :]).reshape(x.shape[:2]) + self.w["d"]
        return score, ahead, back, one, two

    def predict(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability that each block is main text. Pages of like length run together; none is cut."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            most = len(pages[order[at]]) + 4
            group = [i for i in order[at : at + 128] if len(pages[i]) <= most * 1.25]
            at += len(group)
            lengths = np.array([len(pages[i]) for i in group])
            score = self._forward(_padded([pages[i] for i in group]), lengths)[0]
            for i, s, n in zip(group, score, lengths):
                out[i] = _sigmoid(s[:n])
        return out

    def _back(self, x: np.ndarray, way: str, trace: list, grad: np.ndarray, into: dict) -> None:
        later_h, later_c = np.zeros_like(grad[:, 0]), np.zeros_like(grad[:, 0])
        deltas = np.zeros((*grad.shape[:2], 4 * HIDDEN), np.float32)
        for t in range(grad.shape[1] - 1, -1, -1):
            i, f, o, g, before, c, was = trace[t]
            dh, squashed = grad[:, t] + later_h, np.tanh(c)
            dc = later_c + dh * o * (1 - squashed**2)
            d = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            deltas[:, t] = d
            into[f"h{way}"] += was.T @ d
            later_h, later_c = d @ self.w[f"h{way}"].T, dc * f
        flat = deltas.reshape(-1, 4 * HIDDEN)
        into[f"x{way}"] += x.reshape(-1, DIM).T @ flat
        into[f"c{way}"] += flat.sum(axis=0)

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], rounds: int = 12, rate: float = 0.01, seed: int = 7) -> None:
        rng, memory, step = np.random.default_rng(seed), {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}, 0
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        batches = [order[i : i + 16] for i in range(0, len(order), 16)]
        for _ in range(rounds):
            for b in rng.permutation(len(batches)):
                group = batches[b]
                lengths = np.array([len(pages[i]) for i in group])
                x, y = _padded([pages[i] for i in group]), _padded([labels[i][:, None] for i in group])[:, :, 0]
                score, ahead, back, one, two = self._forward(x, lengths, True)
                real = np.arange(x.shape[1])[None, :] < lengths[:, None]
                d = ((_sigmoid(score) - y) * real / max(1, real.sum())).astype(np.float32)
                grad = {k: np.zeros_like(v) for k, v in self.w.items()}
                flat = d.reshape(-1)
                grad["o"] = np.concatenate([flat @ v.reshape(len(flat), -1) for v in (ahead, back, x)])
                grad["d"] = d.sum(keepdims=True)[0]
                into = d[:, :, None] * self.w["o"][None, None, :]
                self._back(x, "f", one, into[:, :, :HIDDEN], grad)
                self._back(self._flip(x, lengths), "b", two, self._flip(into[:, :, HIDDEN : 2 * HIDDEN], lengths), grad)
                step += 1
                for k, g in grad.items():
                    m, v = memory[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.w[k] = (self.w[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def _padded(pages: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(pages), max(map(len, pages)), pages[0].shape[1]), np.float32)
    for row, page in zip(out, pages):
        row[: len(page)] = page
    return out


def structural(page: list[tuple[tuple[str, ...], str]]) -> np.ndarray:
    """Labels by structure: inside an article (or, without one, anywhere) and in no furniture."""
    bare = [{t.strip("<>") for t in tokens} for tokens, _ in page]
    home = next((name for name in ARTICLE if any(name in t and not t & FURNITURE for t in bare)), None)
    return np.array([not t & FURNITURE and (home is None or home in t) for t in bare], np.float32)


def planted(page: list[tuple[tuple[str, ...], str]], rng: np.random.Generator, other: list[str]) -> list[tuple[tuple[str, ...], str]]:
    """The page with furniture set between its blocks, and at times its article under another name."""
    names = sorted(FURNITURE)
    swap = (("<article>",), ("<main>",), ("<div>", "content"), ("<div>", "post"), ("<div>", "entry", "content"), ("<section>", "story"), ("<div>", "article", "body"), ())[rng.integers(8)]
    moved = []
    for tokens, text in page:
        inner = tuple(x for t in tokens for x in (swap if t == "<article>" else (t,)))
        if "<p>" in inner and rng.random() < 0.2:
            form = (("<ul>", "<li>"), ("<ol>", "<li>"), ("<blockquote>", "<p>"), ("<div>",), ("<h2>",), ("<h3>",), ("<table>", "<tr>", "<td>"))[rng.integers(7)]
            inner = tuple(x for t in inner for x in (form if t == "<p>" else (t,)))
            text = text if rng.random() < 0.5 else " ".join(text.split(" ")[: rng.integers(1, 8)])
        moved.append((inner, text))
    out = []
    for block in moved + [None]:
        if rng.random() < 0.35:
            base = block[0] if block else ("<html>", "<body>")
            cut = base[: rng.integers(1, len(base) + 1)] if base else ()
            cut = tuple(t for t in cut if t not in ("<p>", "<h>", "<li>"))
            for _ in range(rng.integers(1, 4)):
                tag = ("<div>", "<section>", "<aside>", "<form>", "<ul>", "<header>", "<footer>", "<nav>", "<p>")[rng.integers(9)]
                name = () if tag in ("<aside>", "<form>", "<header>", "<footer>", "<nav>") and rng.random() < 0.5 else (names[rng.integers(len(names))],)
                if rng.random() < 0.3:
                    name = (*name, ("box", "list", "item", "inner", "block", "container", "wrapper", "section")[rng.integers(8)])
                if not name and tag in ("<div>", "<section>", "<ul>", "<p>"):
                    continue
                inner = (("<p>",), ("<li>", "<a>"), (), ("<label>",), ("<h3>",))[rng.integers(5)]
                out.append((cut + (tag, *name) + inner, other[rng.integers(len(other))]))
        if block:
            out.append(block)
    return out


_START = '<html><head><title>A page</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><header><h2>Site</h2></header><article><h1>A headline</h1>' + "<p>A paragraph of the text, which goes on for a while.</p>" * 3 + "<blockquote>Said here.</blockquote><ul><li>One point.</li><li>Another.</li></ul><table><tr><td>1</td></tr></table></article><aside><p>See also this.</p></aside><footer>&copy; A site</footer></body></html>"


def train(pages: list[str], seed: int = 7) -> Labeller:
    """A labeller from a few pages (and one built-in page, so that it also works without any)."""
    rng = np.random.default_rng(seed)
    read = [b for b in map(blocks, [_START] * 8 + pages) if b]
    texts = [text for page in read for _, text in page]
    tasks = []
    for page in read:
        for other in (page, planted(page, rng, texts), planted(page, rng, texts), planted(page, rng, texts)):
            tasks.append((features(other), structural(other)))
    net = Labeller(seed)
    net.fit([x for x, _ in tasks], [y for _, y in tasks], rounds=max(8, min(60, 5000 // len(tasks))))
    return net


def sample(pages: DataFrame, column: str = "html", size: int = SAMPLE) -> list[str]:
    """At most ``size`` pages, the same on every run: those first by hash; overlong pages are no lessons."""
    rows = pages.select(F.col(column).alias("page")).filter(F.length("page").between(1, 50_000))
    return [r.page for r in rows.orderBy(F.xxhash64("page"), "page").limit(size).collect()]


def extract(pages: DataFrame, net: Labeller, column: str = "html") -> DataFrame:
    """``pages`` with ``text``: the main blocks, joined by blank lines, and ``n_chars``.

    A null or empty page, and one without main blocks, has an empty text. Pages are read
    whole, however long. Repeated rows get the same text. Columns of those names are
    replaced; the page column itself stays.
    """
    keep = [c for c in pages.columns if c not in ("text", "n_chars")]
    rows = pages.select(*keep)
    schema = rows.withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema
    at = keep.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [blocks(p.as_py() or "") for p in batch.column(at)]
            said = net.predict([features(b) for b in read])
            texts = ["\n\n".join(t for (_, t), y in zip(b, p) if y > 0.5) for b, p in zip(read, said)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*keep, "text", "n_chars"])

    return rows.mapInArrow(run, schema)


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extract(pages, train(sample(pages))).select("page_id", "url", "text", "n_chars")


def register(queries: dict, oracles: dict) -> None:
    queries["op7_html_text"] = op7_html_text

"""Main-text extraction by a recurrent block labeller.

A page is read as the sequence of its leaf blocks. Each block gives a vector: hashed names along its tag path, hashed
words, and a few figures (length, share of links, marks). A bidirectional LSTM in numpy reads the sequence in both
directions, so every block is classified knowing the whole page; blocks labelled as main text are joined.

The labeller is trained on at most `sample` pages, the first in a hash order of their id (of pages that are longer or have no
id where there are no others, on stretches of at most `stretch` blocks around the beginnings and ends of main text), labelled by what the sites
themselves say (article and main elements, against navigation, footers, adverts, forms, comments and so on). As sites
differ, every training page is also read in altered versions: its containers under other common names, and with
strange blocks (menus, notices, forms, side columns, comments) set around and into it. Weights are of fixed size; all
pages are then labelled on their whole html, in batches on the executors.

Defined results: where no page can train, blocks are labelled as the pages themselves say; a null or empty page, and one without main text, give an empty text; repeated rows are extracted each;
other columns are ignored; an empty table gives an empty result. Ties cannot arise.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log1p, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import ship
from tradeloom.llm.html_blocks import Block, blocks
from tradeloom.llm.tokens import groups

#: Sizes of the hashed vectors and the number of figures beside them.
PATH, WORDS, FIGURES = 64, 24, 8


@dataclass(frozen=True)
class Settings:
    """sample: training pages at most, of at most max_chars characters each, or of stretch blocks of at most
    block_chars characters; versions: altered readings of each; epochs: over all of these, or more of them until there
    were so many steps."""

    sample: int = 160
    max_chars: int = 60_000
    stretch: int = 400
    block_chars: int = 1_000
    versions: int = 3
    hidden: int = 24
    epochs: int = 8
    steps: int = 160
    batch: int = 32
    rate: float = 0.01
    seed: int = 17


#: Names that containers of main text and of everything else commonly have: (tag, class words).
MAIN_NAMES = (
    ("article",), ("main",), ("div", ".content"), ("div", ".article", ".body"), ("div", ".post"), ("section", ".entry"),
    ("div", ".main", ".text"), ("section", ".story"), ("div", ".page", ".body"),
)
OTHER_NAMES = (
    ("nav",), ("header",), ("footer",), ("aside",), ("form",), ("div", ".ad"), ("div", ".ads"), ("div", ".advert"),
    ("div", ".banner"), ("div", ".sponsored"), ("div", ".promo"), ("div", ".sidebar"), ("div", ".menu"), ("ul", ".menu"),
    ("div", ".navbar"), ("div", ".nav"), ("div", ".breadcrumb"), ("div", ".breadcrumbs"), ("div", ".footer"),
    ("div", ".header"), ("div", ".cookie"), ("div", ".cookie", ".notice"), ("div", ".notice"), ("div", ".consent"),
    ("div", ".newsletter"), ("div", ".subscribe"), ("div", ".popup"), ("div", ".share"), ("div", ".social"),
    ("div", ".related"), ("div", ".comments"), ("section", ".comments"), ("div", ".comment"), ("div", ".comment", ".list"),
    ("ol", ".commentlist"), ("div", ".replies"), ("div", ".widget"), ("div", ".login"), ("div", ".search"),
    ("div", ".hidden"), ("div", ".copyright"), ("div", ".legal"), ("div", ".disclaimer"),
)
_MAIN = {n for names in MAIN_NAMES for n in names} - {"div", "section", ".text", ".body", ".page"}
_OTHER = {n for names in OTHER_NAMES for n in names} - {"div", "section", "ul", "ol", ".list"}


def stated_label(block: Block, any_main: bool) -> bool:
    """What a page's own names say of a block; without a container of main text, longer unlinked blocks count as such."""
    label = False
    for names in block.path:
        if _OTHER.intersection(names) and not (label and names[0] == "header"):
            return False
        label |= bool(_MAIN.intersection(names))
    return label if any_main else len(block.text) >= 80 and 3 * block.linked < len(block.text)


def stated_labels(page: list[Block]) -> np.ndarray:
    any_main = any(_MAIN.intersection(names) for b in page for names in b.path)
    return np.array([stated_label(b, any_main) for b in page], np.float64)


def _hashed(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass"))


class _WordPlaces(dict):
    """The place of a word in the hashed word vector, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        place = self[word] = _hashed(word) % WORDS
        return place


_word_places = _WordPlaces()


@lru_cache(maxsize=50_000)
def _path_vector(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
    out = np.zeros(PATH, np.float32)
    for depth, names in enumerate(reversed(path)):
        for name in names:
            h = _hashed(name)
            out[h % PATH] += (1 if h >> 31 else -1) * (1.0 if depth < 3 else 0.5)
    return out.clip(-2, 2)


def vector(block: Block) -> np.ndarray:
    out = np.zeros(FIGURES + PATH + WORDS, np.float32)
    found, size = block.text.split(), len(block.text)
    places = np.fromiter(map(_word_places.__getitem__, found), np.int64, len(found))
    out[:FIGURES] = (
        1.0, log1p(size) / 8, log1p(len(found)) / 6, block.linked / size, block.text[-1] in ".!?\"'”»",
        sum(map(block.text.count, "|»©·")) / (1 + len(found)), len(block.path) / 10, block.text[0].isupper(),
    )
    out[FIGURES : FIGURES + PATH] = _path_vector(block.path)
    out[FIGURES + PATH :] = np.bincount(places, minlength=WORDS) / sqrt(len(found))
    return out


class Labeller:
    """A bidirectional LSTM with one output a block; weights are plain arrays."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.hidden = weights["forward"].shape[1] // 4

    @classmethod
    def fresh(cls, settings: Settings) -> Labeller:
        rng = np.random.default_rng(settings.seed)
        width, h = FIGURES + PATH + WORDS + settings.hidden, settings.hidden
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        weights = {side: draw(width, 4 * h) for side in ("forward", "backward")}
        weights |= {f"{side}_bias": np.repeat(np.float32([0, 1, 0, 0]), h) for side in ("forward", "backward")}
        return cls(weights | {"out": draw(2 * h), "out_bias": np.zeros(1, np.float32)})

    def _read(self, side: str, x: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states over x (steps, pages, width), and what the gradient needs."""
        h = self.hidden
        into, own = self.w[side][: x.shape[2]], self.w[side][x.shape[2] :]
        ready = x @ into + self.w[f"{side}_bias"]
        state, cell = np.zeros((x.shape[1], h), np.float32), np.zeros((x.shape[1], h), np.float32)
        states, kept = np.zeros((len(x), x.shape[1], h), np.float32), []
        for t in range(len(x)):
            raw = ready[t] + state @ own
            gates = 1 / (1 + np.exp(-raw[:, : 3 * h]))
            fresh = np.tanh(raw[:, 3 * h :])
            before, last = cell, state
            cell = gates[:, h : 2 * h] * cell + gates[:, :h] * fresh
            squashed = np.tanh(cell)
            state = gates[:, 2 * h :] * squashed
            states[t] = state
            kept.append((gates, fresh, before, squashed, last))
        return states, kept

    @staticmethod
    def _turned(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Each page's steps in reverse, what lies beyond its end left in place."""
        steps = np.arange(len(x))[:, None]
        at = np.where(steps < sizes, sizes - 1 - steps, steps)
        return x[at, np.arange(x.shape[1])]

    def scores(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ahead, _ = self._read("forward", x)
        back, _ = self._read("backward", self._turned(x, sizes))
        both = np.concatenate([ahead, self._turned(back, sizes)], axis=2)
        return both @ self.w["out"] + self.w["out_bias"]

    def _gradient(self, side: str, x: np.ndarray, kept: list, outer: np.ndarray, into: dict) -> None:
        h, width = self.hidden, x.shape[2]
        own = self.w[side][width:]
        change = np.zeros((len(x), x.shape[1], 4 * h), np.float32)
        ahead, ahead_cell = np.zeros(outer.shape[1:], np.float32), np.zeros(outer.shape[1:], np.float32)
        weights = np.zeros_like(self.w[side])
        for t in range(len(x) - 1, -1, -1):
            gates, fresh, before, squashed, last = kept[t]
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            d = outer[t] + ahead
            d_cell = d * o * (1 - squashed**2) + ahead_cell
            raw = change[t]
            raw[:, :h] = d_cell * fresh * i * (1 - i)
            raw[:, h : 2 * h] = d_cell * before * f * (1 - f)
            raw[:, 2 * h : 3 * h] = d * squashed * o * (1 - o)
            raw[:, 3 * h :] = d_cell * i * (1 - fresh**2)
            ahead, ahead_cell = raw @ own.T, d_cell * f
            weights[width:] += last.T @ raw
        flat = change.reshape(-1, 4 * h)
        weights[:width] = x.reshape(-1, width).T @ flat
        into[side], into[f"{side}_bias"] = weights, flat.sum(axis=0)

    def step(self, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """The gradient of the mean logistic loss over the pages' blocks."""
        ahead, kept_ahead = self._read("forward", x)
        turned = self._turned(x, sizes)
        back, kept_back = self._read("backward", turned)
        both = np.concatenate([ahead, self._turned(back, sizes)], axis=2)
        there = np.arange(len(x))[:, None] < sizes
        wrong = (1 / (1 + np.exp(-(both @ self.w["out"] + self.w["out_bias"]))) - labels) * there / there.sum()
        wrong = wrong.astype(np.float32)
        out: dict[str, np.ndarray] = {"out": np.einsum("tp,tph->h", wrong, both), "out_bias": wrong.sum(keepdims=True)[0]}
        outer = wrong[:, :, None] * self.w["out"]
        self._gradient("forward", x, kept_ahead, outer[:, :, : self.hidden], out)
        self._gradient("backward", turned, kept_back, self._turned(outer[:, :, self.hidden :], sizes), out)
        return out


def padded(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(v) for v in vectors])
    x = np.zeros((int(sizes.max()), len(vectors), vectors[0].shape[1]), np.float32)
    for page, v in enumerate(vectors):
        x[: len(v), page] = v
    return x, sizes


def _renamed(path: tuple, rng: np.random.Generator, main: bool) -> tuple:
    """The path with the containers that tell main text from the rest under other names, or with all names of that kind
    taken away and one set in their place."""
    out = []
    for names in path:
        if _MAIN.intersection(names) and main:
            names = MAIN_NAMES[rng.integers(len(MAIN_NAMES))]
        elif _OTHER.intersection(names):
            names = OTHER_NAMES[rng.integers(len(OTHER_NAMES))]
        out.append(names)
    if rng.random() < 0.5:
        out.insert(min(len(out), 2), ("div", ".wrapper") if rng.random() < 0.5 else ("div",))
    return tuple(out)


def altered(page: list[Block], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The page under other names, with strange blocks around and inside its main text."""
    texts = [b.text for b in page]
    out: list[tuple[Block, float]] = [(Block(_renamed(b.path, rng, bool(y)), b.text, b.linked), y) for b, y in zip(page, labels)]
    root = (("html",), ("body",))
    inside = next((b.path for b, y in out if y), root)[:-1] or root

    def strange(base: tuple) -> list[tuple[Block, float]]:
        names, made = OTHER_NAMES[rng.integers(len(OTHER_NAMES))], []
        for _ in range(int(rng.integers(1, 6))):
            text = texts[rng.integers(len(texts))]
            if rng.random() < 0.6:
                text = " ".join(text.split()[: int(rng.integers(1, 8))])
            linked = len(text) if rng.random() < 0.4 else 0
            leaf = (("ul",), ("li",)) if rng.random() < 0.4 else (("p",),) if rng.random() < 0.6 else (("div",),)
            made.append((Block((*base, names, *leaf, *((("a",),) if linked else ())), text, linked), 0.0))
        return made

    for _ in range(int(rng.integers(0, 4))):
        where = int(rng.integers(0, len(out) + 1))
        among = 0 < where < len(out) and out[where - 1][1] and out[where][1]
        out[where:where] = strange(inside if among else root)
    return [b for b, _ in out], np.array([y for _, y in out])


def train(pages: list[list[Block]], settings: Settings = Settings()) -> Labeller:
    rng = np.random.default_rng(settings.seed)
    labeller = Labeller.fresh(settings)
    examples = []
    for page in pages:
        if page:
            labels = stated_labels(page)
            examples.append((np.stack([vector(b) for b in page]), labels))
            for _ in range(settings.versions):
                other, own = altered(page, labels, rng)
                examples.append((np.stack([vector(b) for b in other]), own))
    mean = {k: np.zeros_like(v) for k, v in labeller.w.items()}
    square = {k: np.zeros_like(v) for k, v in labeller.w.items()}
    count = 0
    by_size = sorted(range(len(examples)), key=lambda i: len(examples[i][1]))
    parts = [by_size[i : i + settings.batch] for i in range(0, len(by_size), settings.batch)]
    for _ in range(max(settings.epochs, -(-settings.steps // len(parts))) if parts else 0):
        for part in rng.permutation(len(parts)):
            chosen = [examples[i] for i in parts[part]]
            x, sizes = padded([v for v, _ in chosen])
            y = np.zeros(x.shape[:2], np.float32)
            for page, (_, labels) in enumerate(chosen):
                y[: len(labels), page] = labels
            count += 1
            for k, g in labeller.step(x, sizes, y).items():
                g = np.clip(g, -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                rate = settings.rate * np.sqrt(1 - 0.99**count) / (1 - 0.9**count)
                labeller.w[k] = (labeller.w[k] - rate * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
    return labeller


def stretch(page: list[Block], settings: Settings) -> list[Block]:
    """At most `stretch` blocks of the page, those nearest to where main text begins or ends, their texts cut."""
    labels = stated_labels(page) > 0
    edges = np.flatnonzero(labels[1:] != labels[:-1]) + 0.5
    at = np.arange(len(page))
    if len(edges):
        right = np.searchsorted(edges, at)
        far = np.minimum(np.abs(at - edges[np.maximum(right - 1, 0)]), np.abs(edges[np.minimum(right, len(edges) - 1)] - at))
    else:
        far = at.astype(float)
    chosen = np.sort(np.argsort(far, kind="stable")[: settings.stretch])
    return [Block(page[i].path[-20:], page[i].text[: settings.block_chars], min(page[i].linked, settings.block_chars)) for i in chosen]


def _stretches(pages: DataFrame, settings: Settings) -> list[list[Block]]:
    """Bounded stretches of at most `sample` pages of any length, cut on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, htmls in groups(batch, "html"):
                cut = [stretch(page, settings) for page in map(blocks, htmls) if page]
                rows = [json.dumps([[b.path, b.text, b.linked] for b in page]) for page in cut]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["page"])

    chosen = pages.where(F.length("html") > 0).select("html").orderBy(F.xxhash64("html"), "html").limit(settings.sample)
    rows = chosen.mapInArrow(run, "page string").collect()  # at most sample * stretch * block_chars characters
    return [[Block(tuple(map(tuple, path)), text, linked) for path, text, linked in json.loads(r["page"])] for r in rows]


def learn(pages: DataFrame, settings: Settings = Settings()) -> Labeller | None:
    """A labeller from a bounded sample of the pages; none if these hold no blocks."""
    usable = pages.where(F.col("page_id").isNotNull() & F.length("html").between(1, settings.max_chars))
    ids = usable.select("page_id").distinct().orderBy(F.xxhash64(F.col("page_id").cast("string")), "page_id").limit(settings.sample)
    chosen = usable.select("page_id", "html").join(F.broadcast(ids), "page_id", "left_semi")
    rows = chosen.orderBy("page_id", "html").limit(settings.sample).collect()  # at most sample * max_chars characters
    examples = [page for r in rows if (page := blocks(r["html"]))] or _stretches(pages, settings)
    return train(examples, settings) if examples else None


def labelled(labeller: Labeller | None, pages: list[list[Block]], per_batch: int = 128) -> list[np.ndarray]:
    """For each page, which blocks are main text. Pages of like length are read together; without a labeller, as stated."""
    if labeller is None:
        return [stated_labels(p) > 0 for p in pages]
    out: list[np.ndarray] = [np.zeros(len(p), bool) for p in pages]
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    for i in range(0, len(order), per_batch):
        part = order[i : i + per_batch]
        x, sizes = padded([np.stack([vector(b) for b in pages[p]]) for p in part])
        scores = labeller.scores(x, sizes)
        for column, p in enumerate(part):
            out[p] = scores[: len(pages[p]), column] > 0
    return out


def extract(pages: DataFrame, labeller: Labeller | None = None, settings: Settings = Settings()) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship(pages.sparkSession)
    labeller = labeller or learn(pages, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, htmls in groups(batch, "html"):
                found = [blocks(h) for h in htmls]
                texts = [
                    "\n".join(b.text for b, keep in zip(page, own) if keep) for page, own in zip(found, labelled(labeller, found))
                ]
                part = batch.slice(first, len(htmls))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return columns.mapInArrow(run, "page_id long, url string, text string, n_chars long")

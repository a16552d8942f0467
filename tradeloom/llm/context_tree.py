"""Context-tree weighting over bytes, on counts of grams.

A gram is a byte with the `depth` bytes before it, as one number: nearest context byte first, the byte itself last. A byte
is eight binary decisions; each decision has a tree of its own over the contexts, from none to the nearest `depth` bytes.
A node holds how often the decision fell to 0 and to 1 in training and estimates by Krichevsky and Trofimov. With
the probability Pe that this estimate gives the node's training bits in a row, the weighted one is
Pw = Pe / 2 + (product of the children's Pw) / 2, and Pe at the full depth. The share of a node's own estimate in
the mixture below it is Pe / (2 Pw). A context that training never met has no say: the mixture ends above it.

Nodes are numbered by (context << 8) | (1, then the bits of the byte so far). The eight decisions never meet, so each is
worked out by itself; all grams of a context must be at hand, which holds for any set that is closed under a shorter context.
"""

from __future__ import annotations

import numpy as np

#: Ends every text and fills the context before its first byte; no byte of UTF-8 text is equal to it.
END = 0xFF
HALF = np.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x >= 0.5, by Stirling's series from x + 8 on."""
    product = np.ones_like(x)
    for i in range(8):
        product = product * (x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log Pe: the estimate's probability of so many zeros and ones in any one order."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def joined(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one run of bytes, each behind `depth` ENDs and followed by its own END, and the places of those."""
    gap = bytes([END]) * depth
    ends = np.cumsum([len(t) + depth for t in texts])
    return np.frombuffer(gap + b"".join(t + gap for t in texts), np.uint8), ends.astype(np.int64)


def grams(run: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and grams of all bytes behind the first `depth` ones that belong to a text, or are its END."""
    keep = run != END
    keep[ends] = True
    keep = np.flatnonzero(keep[depth:])
    keys = np.zeros(len(run) - depth, np.int64)
    for back in range(1, depth + 1):
        keys <<= 8
        keys |= run[depth - back : len(run) - back]
    keys <<= 8
    keys |= run[depth:]
    return keep + depth, keys[keep]


def _node(keys: np.ndarray, level: int) -> np.ndarray:
    symbol = keys & 0xFF
    return (keys & ~0xFF) | (1 << level) | (symbol >> (8 - level))


def parents(nodes: np.ndarray) -> np.ndarray:
    """The nodes of the same decision whose context lacks the farthest byte."""
    return ((nodes >> 16) << 8) | (nodes & 0xFF)


class Level:
    """Nodes of one depth and decision: counts, weighted probability, own estimate for a one, and its share."""

    def __init__(self, nodes, zeros, ones, children=None):
        self.nodes, self.zeros, self.ones = nodes, zeros, ones
        own = log_estimate(zeros, ones)
        self.weighted = own if children is None else np.logaddexp(HALF + own, HALF + children)
        self.share = np.exp(HALF + own - self.weighted) if children is not None else np.ones(len(nodes))
        self.one = (ones + 0.5) / (zeros + ones + 1.0)
        self.seen = zeros + ones > 0

    def above(self) -> tuple[Level, np.ndarray]:
        """The level one context byte shorter, and the place there of each node's parent."""
        nodes, place = np.unique(parents(self.nodes), return_inverse=True)
        add = lambda x: np.bincount(place, x, len(nodes))
        return Level(nodes, add(self.zeros), add(self.ones), add(self.weighted)), place


def climbed(keys: np.ndarray, counts: np.ndarray, level: int, up: int) -> tuple[list[Level], list[np.ndarray]]:
    """Levels of one decision from the full depth upwards, and the place of each gram's node in each. keys are sorted."""
    ids = _node(keys, level)
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    place = np.cumsum(np.concatenate([[False], ids[1:] != ids[:-1]]))
    one = (keys >> (7 - level)) & 1
    levels = [Level(ids[starts], np.add.reduceat(counts * (1 - one), starts).astype(float), np.add.reduceat(counts * one, starts).astype(float))]
    places = [place]
    for _ in range(up):
        higher, parent = levels[-1].above()
        levels.append(higher)
        places.append(parent[places[-1]])
    return levels, places


def mixed(levels: list[Level], places: list[np.ndarray]) -> np.ndarray:
    """For each gram the mixture's probability of a one, as of the highest of these levels."""
    out = levels[0].one[places[0]]
    for below, level, place, under in zip(levels, levels[1:], places[1:], places, strict=False):
        share, own = level.share[place], level.one[place]
        out = np.where(below.seen[under], share * own + (1 - share) * out, own)
    return out

"""Licences that are no unit of their document: over several paragraphs, or within a line."""

from __future__ import annotations

import re

import pytest

from tests.llm.tables import by_id, documents, prose
from tradeloom.llm import licenses
from tradeloom.llm.license_texts import TEXTS


def in_paragraphs(text: str, words: int = 40) -> str:
    found = text.split()
    return "\n\n".join(" ".join(found[i : i + words]) for i in range(0, len(found), words))


def plain_best(text: str, template: str, threshold: float) -> float:
    """The best coefficient over all runs of the text."""
    found = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    pairs, own = list(zip(found, found[1:])), set(tuple(b.split(" ")) for b in licenses.bigrams_of(template))
    best = 0.0
    for i in range(len(pairs)):
        held = set()
        for b in pairs[i:]:
            held.add(b)
            best = max(best, 2 * len(held & own) / (len(held) + len(own)))
    return best if best >= threshold else 0.0


def test_several_paragraphs_inside_long_documents(spark):
    long = [(n, t) for n, t in (*licenses.TEMPLATES, *TEXTS) if len(t) > 250]
    texts = [prose(i, 400) + "\n\n" + in_paragraphs(t) + "\n\n" + prose(i + 99, 400) for i, (_, t) in enumerate(long)]
    got = by_id(licenses.scan(documents(spark, texts)), "license", "n_matches", "licenses")
    assert [got[i] for i in range(len(long))] == [(n, 1, n) for n, _ in long]


def test_wrapped_lines_followed_by_code(spark):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 500)
    text = "\n".join(" * " + line for line in mit.split("\n")) + "\n" + "\n".join(f"int f{i}(int x);" for i in range(300))
    assert by_id(licenses.scan(documents(spark, [text])), "license", "n_matches") == {0: ("MIT", 1)}


def test_notices_within_a_line(spark):
    texts = [
        prose(1, 300) + "\nCopyright 2021 Acme Corp. Released under the MIT License.\n" + prose(2, 300),
        prose(3, 50) + " (this work is licensed under the GNU General Public License, version 2) " + prose(4, 50) + " licensed under cc by 4.0 " + prose(5, 20),
        prose(6, 50) + " released under some License. " + prose(7, 50),
    ]
    got = by_id(licenses.scan(documents(spark, texts)), "license", "dice", "n_matches", "licenses")
    assert got[0] == ("MIT", 1.0, 1, "MIT") and got[2] == (None, 0.0, 0, "")
    assert got[1] == ("GPL-2.0", 1.0, 2, "CC-BY-4.0,GPL-2.0")


@pytest.mark.parametrize("template", ["a b c d e f", "a b a b c d c d e a", "x y z"])
def test_best_runs_against_all_runs(spark, template):
    import random

    rng = random.Random(template)
    texts = []
    for _ in range(60):
        own = [w for w in template.split() if rng.random() > 0.08]
        own.insert(rng.randint(0, len(own)), rng.choice(["a", "q"]))
        texts.append(" ".join(rng.choices("abcdefqr", k=8) + own + rng.choices("abcdefqr", k=8)))
    got = by_id(licenses.scan(documents(spark, texts), templates=(("T", template), ("U", "zz yy xx ww vv uu")), texts=()), "dice")
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(plain_best(text, template, 0.8))

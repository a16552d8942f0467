"""The manifest against plain trees in Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from tests.llm.tables import DOCUMENT, with_strange_columns
from tradeloom.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(digests):
    out = [list(digests)]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    by_lang = {}
    for row in rows:
        doc_id, text, lang = row[:3]
        low = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        other = leaf(row, low) if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 else None
        by_lang.setdefault(lang, []).append((doc_id, leaf(row, text), other))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {lang: levels([r[1] for r in by_lang[lang]]) for lang in langs}
    top, out = levels([trees[lang][-1][0] for lang in langs]), []
    for place, lang in enumerate(langs):
        for i, (doc_id, own, other) in enumerate(by_lang[lang]):
            node, siblings = other or own, []
            for tree, at in ((trees[lang], i), (top, place)):
                for level in tree[:-1]:
                    run = level[at - at % 8 : at - at % 8 + 8]
                    siblings += [d for j, d in enumerate(run) if j != at % 8]
                    run[at % 8] = node
                    node, at = sha("".join(run)), at // 8
            out.append((doc_id, own, trees[lang][-1][0], top[-1][0], sha("".join(siblings)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def run(frame, **settings):
    return sorted((tuple(r) for r in manifest.manifest(frame, **settings).collect()), key=repr)


def row(i, text, lang="en", source="a"):
    return i, text, lang, source, None if text is None else len(text)


@pytest.mark.parametrize("levels_held", [1, 2, 4])
def test_agrees_with_plain_trees(spark, levels_held):
    rows = [row(i * 7 % 1000, f"Text {i} Ä", ("en", "en", "de", None)[i % 4], ("a", None)[i % 2]) for i in range(150)]
    rows += [row(5000, "Alone", "fr"), row(None, "No id"), row(None, None), row(12, ""), row(13, None), (14, "n", None, None, None)]
    frame = with_strange_columns(spark.createDataFrame(rows, DOCUMENT), "key", "leaf", "pos", "root", "tampered", "_tie")
    assert run(frame, levels=levels_held) == brute(rows)


def test_repeated_rows_and_a_hot_language(spark):
    rows = [row(3, "Same Text", "en") for _ in range(100)] + [row(i, f"T {i}", "en") for i in range(150)]
    rows += [row(i, f"T {i}", "de") for i in range(40)]
    assert run(spark.createDataFrame(rows, DOCUMENT).repartition(6), levels=1) == brute(rows)


def test_more_languages_than_a_superblock_holds(spark):
    rows = [row(i, f"Text {i}", f"l{i % 90:02d}") for i in range(200)]
    assert run(spark.createDataFrame(rows, DOCUMENT), levels=1) == brute(rows)


def test_one_row_long_text_and_empty_table(spark):
    rows = [row(1, "Long Text. " * 100_000)]
    found = run(spark.createDataFrame(rows, DOCUMENT))
    assert found == brute(rows) and found[0][1] == found[0][2] == found[0][3] and found[0][4] == sha("")
    assert run(spark.createDataFrame([], DOCUMENT)) == []


def test_tampering_is_found_and_only_it(spark):
    rows = [row(i, "Upper" if i % 2 else "lower") for i in range(60)]
    for doc_id, *_, verified in run(spark.createDataFrame(rows, DOCUMENT), levels=1):
        assert verified == (not (doc_id % 2 and zlib.crc32(str(doc_id).encode()) % 3 == 0))


def test_a_proof_needs_its_own_superblock_and_outer_nodes_only():
    digests = [sha(str(i)) for i in range(100)]
    tree = manifest.reduced(digests, 3)
    for i in (0, 7, 8, 63, 99):
        at, siblings = manifest.path_in(tree, i)
        assert manifest.fold(digests[i], at, siblings) == tree[-1][0]

from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.tables import by_id, documents, with_strange_columns
from tradeloom.llm import languages

SYLLABLES = {"xx": ["ka", "to", "mi", "re"], "yy": ["sch", "ung", "ein", "ver"], "zz": ["ção", "ñe", "ío", "ra"]}


def speak(lang, seed, words=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words)).capitalize() + ". 12,3!"


def training(spark):
    texts, langs = [], []
    for i in range(90):
        lang = ["xx", "yy", "zz"][i % 3]
        texts.append(speak(lang, i))
        langs.append(lang)
    return documents(spark, texts + [None, "", "123", "ka"], langs=langs + ["xx", "xx", "yy", None])


def plain_ngrams(text, longest):
    out, held = [], ""
    for c in " " + text.lower() + " ":
        c = c if c.isalpha() else " "
        if not (c == " " and held.endswith(" ")):
            held += c
    for n in range(1, longest + 1):
        out += [held[i : i + n] for i in range(len(held) - n + 1) if held[i : i + n].strip()]
    return Counter(out)


@pytest.mark.parametrize("text", ["", "a", "Ab, ab!", "ÑÇ ß漢字 x", "  12 a-b  ", "a" * 10, "Straße İx", "퟿𐐀𐐨 z"])
def test_ngrams_are_those_of_the_text(text):
    found, counts = languages.ngrams(text, 3)
    got = {}
    for gram, n in zip(found.tolist(), counts.tolist()):
        chars = []
        while gram:
            chars.append(gram & (2**21 - 1))
            gram >>= 21
        got["".join(chr(c) if c else " " for c in reversed(chars))] = n
    # A leading space is the number 0 before the other characters, so it cannot be told from its absence by value;
    # lengths are kept apart by the padding on both sides.
    want = Counter()
    for gram, n in plain_ngrams(text, 3).items() if text else ():
        want[gram.lstrip(" ")] += n
    assert got == dict(want)


def test_parts_of_long_texts_add_up(monkeypatch):
    text = speak("yy", 1, 500)
    whole = languages.ngrams(text, 3)
    monkeypatch.setattr(languages, "PART", 97)
    parts = languages.ngrams(text, 3)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_predictions_and_defined_cases(spark):
    profiles = languages.learn(training(spark))
    assert profiles.languages == ["xx", "yy", "zz"]
    texts = [speak(lang, 1000 + i) for i in range(10) for lang in SYLLABLES]
    frame = documents(spark, texts + [None, "", " 12 .,", speak("zz", 5, 40_000)], langs=[None] * 34)
    got = by_id(languages.predict(with_strange_columns(frame, "score", "lang_pred"), profiles), "lang_pred", "score")
    assert [got[i][0] for i in range(30)] == list(SYLLABLES) * 10
    assert got[30] == got[31] == got[32] == ("und", 0.0) and got[33][0] == "zz"
    assert all(0 <= s <= 1 for _, s in got.values())


def test_distance_is_the_sum_of_rank_differences():
    settings = languages.Settings(profile=4, top=3, longest=1)
    order = lambda text: [ord(c) for c in text]
    profiles = languages.Profiles({"p": order("abcd"), "q": order("badc")}, 4)
    # Ranks of the text: b, a, x. To p: 1 + 1 + 4, to q: 0 + 0 + 4.
    assert profiles.predict("bbb aa x", settings) == ("q", 1 - 4 / 12)


def test_the_sample_is_bounded_and_ties_go_to_the_first(spark):
    few = languages.learn(training(spark), languages.Settings(sample=2, profile=10))
    assert few.known.size <= 30
    assert languages.Profiles({"b": [97], "a": [97]}, 1).predict("a", languages.Settings(longest=1))[0] == "a"


def test_all_documents_teach(spark, monkeypatch):
    letters = [chr(0x4E00 + i) for i in range(450)]
    frame = documents(spark, letters, langs=["xx"] * 450)
    monkeypatch.setattr(languages, "HELD", 20)
    learned = languages.learn(frame, languages.Settings(profile=500, longest=1))
    assert learned.known.tolist() == [ord(c) for c in letters]


def test_all_documents_tell_the_lowest_scores(spark):
    settings = languages.Settings(stray=0.0)
    texts = [speak("xx", i, 8) for i in range(450)]
    frame = documents(spark, texts, langs=["xx"] * 450)
    profiles = languages.learn(frame, settings)
    low = {}
    for text in texts:
        letters = languages._letters_of(text)
        sizes = [2**k for k in range(languages.SHORTEST, languages.LONGEST + 1) if 2**k < len(letters)]
        for part in [letters, *(letters[:n] for n in sizes), *(letters[-n:] for n in sizes)]:
            size = languages._length_class(len(part))
            low[size] = min(low.get(size, 1.0), profiles.predict(part, settings)[1])
    assert languages.lowest_scores(frame, profiles, settings) == {"xx": low}


def test_keep_known_keeps_columns_and_clean_rows(spark):
    frame = with_strange_columns(training(spark), "gone_id", "score")
    kept = languages.keep_known(frame)
    assert kept.columns == frame.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [*range(90), 93]


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert languages.predict(empty, languages.learn(empty)).count() == 0
    assert languages.keep_known(empty).count() == 0
    nothing = languages.learn(empty)
    assert by_id(languages.predict(documents(spark, ["abc"]), nothing), "lang_pred", "score") == {0: ("und", 0.0)}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out_accuracy(spark):
    from tradeloom.llm import queries

    found = queries.QUERIES["op9_languages"](spark, "/root/testdata/sf0.01").where("held_out")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.join(lang, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98

"""What keep_known drops: languages that the table does not teach, and gibberish of several kinds."""

from __future__ import annotations

import os
import random

import pytest

from tests.llm.tables import documents
from tests.llm.test_languages import speak
from tradeloom.llm import languages

POLISH = """Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i
sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności
zawarte w niniejszej Deklaracji bez względu na różnice rasy, koloru, płci, języka, wyznania, poglądów politycznych."""
FINNISH = """Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja
omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokainen on oikeutettu kaikkiin tässä
julistuksessa esitettyihin oikeuksiin ja vapauksiin ilman minkäänlaista rotuun, väriin tai kieleen perustuvaa erotusta."""


def strange(seed=5, letters=300):
    rng = random.Random(seed)
    return [
        POLISH,
        FINNISH,
        "".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=letters)),
        " ".join("%08x" % rng.getrandbits(32) for _ in range(letters // 8)),
        "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(letters)),
    ]


def test_languages_not_taught_and_gibberish_go(spark):
    texts = [speak(["xx", "yy", "zz"][i % 3], i, words=[12, 60, 400][i % 9 // 3]) for i in range(180)]
    others = strange()
    short = [speak("xx", 999, 8), speak("yy", 998, 8), speak("zz", 997, 8)]
    langs = [["xx", "yy", "zz"][i % 3] for i in range(180)] + [None] * (len(others) + len(short))
    kept = languages.keep_known(documents(spark, texts + others + short, langs=langs))
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert ids == {*range(180), *range(180 + len(others), 180 + len(others) + len(short))}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_given_documents_stay_and_strange_ones_go(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(strange())], given.schema)
    ids = {r[0] for r in languages.keep_known(given.union(odd)).select("doc_id").collect()}
    clean = {r["doc_id"] for r in given.collect() if r["text"] and any(c.isalpha() for c in r["text"])}
    assert ids == clean

"""Quality rules, secret scans and license scans: small cases, and that nothing but DataFrame functions runs."""

from __future__ import annotations

import hashlib
import re

import pytest

from tests.llm.tables import by_id, documents, prose, with_strange_columns
from tradeloom.llm import licenses, quality, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def repeat_words(text: str) -> int:
    w = WORD.findall(text)
    seen: dict[tuple, list[int]] = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    return len({p + o for places in seen.values() if len(places) > 1 for p in places for o in range(3)})


TEXTS = [
    None,
    "",
    " \n\t ",
    "One.",
    "a b c a b c",
    "a a a a a",
    "The same line here.\nThe same line here.\n\n \nAnother one | two | three | four\n" + prose(1, 80) + ".",
    "Ünïcode wörds ß 漢字 x # $ %\x0b& <b>",
    ("For " * 3000).strip(),
    prose(2, 40000) + ".",
]


class TestQuality:
    def test_counts(self, spark):
        got = by_id(quality.judge(documents(spark, TEXTS)), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        for i, text in enumerate(TEXTS):
            t = text or ""
            w = WORD.findall(t)
            lines = [x for x in t.split("\n") if WORD.search(x)]
            n, again = len(w), repeat_words(t)
            assert got[i] == (
                n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), again,
                n < 50 or 100 * again > 50 * n,
            )

    def test_verdicts(self, spark):
        sentences = "\n".join(prose(i, 12) + "." for i in range(8))
        menu = "\n".join("Home | News | Shop | About us." for _ in range(20))
        marks = " ".join(f"w{i}%%%" for i in range(80)) + "."
        stock = "\n".join(f"Please read our privacy policy {i} before you go on with it." for i in range(9))
        unfinished = "\n".join(prose(i, 12) for i in range(8))
        cut_off = "\n".join(prose(i, 12) + ". " + prose(i + 50, 5) for i in range(8))
        texts = [sentences, sentences + "\n" + menu, marks, stock, unfinished, cut_off]
        got = by_id(quality.judge(documents(spark, texts)), "kept")
        assert got == {0: True, 1: False, 2: False, 3: False, 4: False, 5: True}
        clean = by_id(quality.judge(documents(spark, [sentences + "\nHome | News | Shop | Us."])), "clean_text")
        assert clean[0] == sentences

    def test_repeated_rows_strange_columns_and_empty_tables(self, spark):
        frame = with_strange_columns(documents(spark, ["a b", "a b"], ids=[3, 3]), "t", "w", "lines", "n_words", "kept")
        assert [r["n_words"] for r in quality.judge(frame).collect()] == [2, 2]
        assert quality.judge(documents(spark, [])).count() == 0

    def test_is_native_and_does_not_shuffle(self, spark):
        plan = plan_of(quality.judge(documents(spark, TEXTS)))
        assert not re.search("Python|Arrow|Exchange", plan)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    out = []
    for rank, (kind, pattern, group, least) in enumerate(
        [
            ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20),
            ("hex", r"[0-9a-f]+", 0, 24),
        ]
    ):
        for m in re.finditer(pattern, text, re.A):
            if len(m[group]) >= least:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


SECRETS = [
    None,
    "",
    'token = "abcdef" and Password: hunter2x, secret="short" passwd=12345',
    "éé漢 api_key='A+/_.=-x' APIKEY=" + "f" * 30,
    "AKIA" + "B" * 15 + " AKIA" + "B" * 16 + " xAKIA" + "9" * 30,
    'secret="token"=abcdefgh token:token=abcdefgh',
    "0123456789abcdef" * 3 + "G" + "a" * 23 + " " + "a" * 24,
    "nothing here",
    "ghp_" + "A1" * 20 + " -----BEGIN RSA PRIVATE KEY----- " + "x" * 200_000 + " token=abcdef",
    "token=abcdef " * 500,
]


class TestSecrets:
    def test_base_spans(self, spark):
        rows = secrets.scan(documents(spark, SECRETS)).select("document.doc_id", "spans").collect()
        base = {r.key for r in secrets.BASE_RULES}
        for doc_id, spans in rows:
            got = [(s["start"], s["rank"], s["end"], s["rule"].split("@")[0]) for s in spans if s["rule"] in base]
            assert got == base_spans(SECRETS[doc_id] or ""), doc_id
        more = {r[0]: [s["rule"] for s in r[1] if s["rule"] not in base] for r in rows}
        assert more[8] == ["github@1", "pem@1"]

    def test_ledger_scans_only_what_it_lacks(self, spark):
        ledger = secrets.Ledger(spark)
        first, rules = documents(spark, ["token=abcdef", "token=abcdef", "plain"]), secrets.RULES[:2]
        assert secrets.unseen(first, ledger, rules).count() == 2  # equal texts are one blob
        secrets.scan_unseen(first, ledger, rules)
        assert secrets.unseen(first, ledger, rules).count() == 0
        second = documents(spark, ["token=abcdef", "new " + "a" * 24])
        todo = {r["text"]: sorted(r["todo"]) for r in secrets.unseen(second, ledger, secrets.RULES[:3]).collect()}
        assert todo == {"token=abcdef": ["hex@1"], "new " + "a" * 24: ["access@1", "assign@1", "hex@1"]}
        changed = (secrets.Rule("assign", r"plain()", 0, 1, version=2),)
        rows = secrets.scan(first, ledger, changed).select("document.doc_id", "spans").collect()
        assert {r[0]: len(r[1]) for r in rows} == {0: 0, 1: 0, 2: 1}

    def test_redaction_and_strange_columns(self, spark):
        frame = with_strange_columns(documents(spark, ["a token=abcdef b " + "c" * 30 + " d", "none", None]), "spans", "blob", "document", "todo")
        scanned = secrets.scan(frame)
        got = {r[0]: r[1] for r in scanned.select("document.doc_id", secrets.redact(scanned["document.text"], scanned["spans"])).collect()}
        assert got == {0: "a [SECRET] b [SECRET] d", 1: "none", 2: None}
        assert set(frame.columns) == set(scanned.select("document.*").columns)

    def test_empty_table_and_native(self, spark):
        assert secrets.scan(documents(spark, [])).count() == 0
        assert not re.search("Python|Arrow", plan_of(secrets.scan(documents(spark, SECRETS))))

    def test_hash_of_no_spans(self):
        assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


class TestLicenses:
    def test_matches(self, spark):
        mit = next(t for n, t in licenses.TEMPLATES if len(t) > 500)
        texts = [
            None, "", "word", prose(3, 300) + "\nReleased under the MIT License.\n" + prose(4, 100), "Some words\n\n" + mit + "\n\nmore.",
            mit.replace("Software", "Program").replace("persons", "people"), "licensed   UNDER cc-by-nc 4.0!", prose(5, 50_000),
            "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.",
        ]
        got = by_id(licenses.scan(with_strange_columns(documents(spark, texts), "units", "matches", "dice")), "license", "n_matches", "licenses")
        assert got[0] == got[1] == got[2] == got[7] == (None, 0, "")
        assert got[3] == ("MIT", 1, "MIT") and got[4][0] == "MIT" and got[5][0] == "MIT"
        assert got[6] == ("CC-BY-NC-4.0", 1, "CC-BY-NC-4.0")
        assert got[8][1:] == (2, "CC-BY-NC-4.0,MIT")

    def test_bounds_lose_no_pair(self):
        for template in licenses.prepared(threshold=0.8):
            n = len(template.bigrams)
            for size in range(1, 4 * n):
                if 2 * min(n, size) / (n + size) >= 0.8:
                    assert template.low <= size <= template.high

    def test_empty_table_and_native(self, spark):
        assert licenses.scan(documents(spark, [])).count() == 0
        assert not re.search("Python|Arrow|Exchange", plan_of(licenses.scan(documents(spark, ["x"]))))


@pytest.mark.parametrize("judge", [quality.judge, licenses.scan])
def test_repeated_rows_are_judged_each(spark, judge):
    assert judge(documents(spark, ["a b c"] * 3, ids=[1, 1, None])).count() == 3

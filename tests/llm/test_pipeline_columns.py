"""The secrets stage on tables with columns of the names that it uses itself."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.tables import documents, with_strange_columns


def test_secrets_stage_with_clashing_columns(spark):
    texts = ["password = hunter22x and more", "nothing here", None]
    frame = with_strange_columns(documents(spark, texts), "clean", "found", "document", "spans", "blob")
    out = corpus_pipeline.without_secrets(spark, frame, "")
    assert out.columns == frame.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert [rows[i]["text"] for i in range(3)] == ["[SECRET] and more", texts[1], None]
    assert [rows[i]["n_chars"] for i in range(3)] == [17, 12, None]
    assert all(r[c] == "x" for r in rows.values() for c in ("clean", "found", "document", "spans", "blob"))

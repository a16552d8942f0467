"""A ledger that an earlier run has written."""

from __future__ import annotations

from tests.llm.tables import documents
from tradeloom.llm import secrets


def test_a_second_ledger_takes_up_completed_batches(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    frame = documents(spark, ["password = hunter22x", "nothing", None])
    first = secrets.Ledger(spark, path)
    assert first.batches == []
    secrets.scan_unseen(frame, first)
    spark.createDataFrame([], secrets.LEDGER).write.parquet(f"{path}/batch-broken")
    (tmp_path / "ledger" / "batch-broken" / "_SUCCESS").unlink()
    second = secrets.Ledger(spark, path)
    assert len(second.batches) == 1 and "broken" not in second.batches[0]
    assert secrets.unseen(frame, second).isEmpty()
    assert secrets.findings(second).count() == 1
    assert secrets.unseen(documents(spark, ["nothing", "new"]), second).count() == 1

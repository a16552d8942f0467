"""Run registered queries against DuckDB: python tests/check_all.py FOLDER [NAME ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import compare, connect  # noqa: E402
from tradeloom.checks import registry  # noqa: E402
from tradeloom.session import build_session  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failures = 0
    for name in names or list(registry.QUERIES):
        started = time.time()
        try:
            frame = registry.QUERIES[name](spark, folder)
            sql = registry.ORACLES.get(name)
            problem = compare(frame, con, sql) if sql else f"(no SQL) {frame.count()} rows"
        except Exception as error:  # report every query, then fail
            problem, sql = f"{type(error).__name__}: {str(error)[:1500]}", "error"
        failures += bool(problem and sql)
        print(f"{'ok ' if not problem else '-- '} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures of {len(names or registry.QUERIES)}")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))

"""Python workers give back the memory of their tasks."""

from __future__ import annotations

import os
import re
import subprocess
import sys

import pytest

from tradeloom.llm import common

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Grams of 8 MB of random letters, then how many MB more than at first the process holds.
HELD = """
import re, numpy as np, pandas, pyarrow
from tradeloom.llm import model_scores
def held():
    return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
text = lambda i: np.random.default_rng(i).integers(97, 123, 1 << 20).astype(np.uint8).tobytes()
before = held()
chunks = ((i, ([i], [True], [1 << 20], text(i))) for i in range(8))
for message in model_scores._asked_grams(0, chunks, 5, 3, 8):
    pass
del message
print(held() - before)
"""


def test_a_generator_gives_back_memory_when_it_ends_or_is_closed(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    numbers = common.frugal(lambda n: iter(range(n)))
    assert list(numbers(3)) == [0, 1, 2] and calls == [1]
    opened = numbers(3)
    next(opened)
    opened.close()
    assert calls == [1, 1]


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="needs Linux")
def test_grams_leave_little_memory_behind():
    out = subprocess.run([sys.executable, "-c", HELD], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    assert float(re.findall(r"[-\d.]+", out)[-1]) < 40

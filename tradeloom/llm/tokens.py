"""Words of whole texts as 64-bit numbers, for the operators that work on word sequences in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Texts are worked on in groups of about so many characters, whatever the size of the Arrow batch.
GROUP_CHARS = 1_000_000
#: Multipliers of 64-bit mixing (odd, otherwise arbitrary).
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits; one to one."""
    values = (values ^ (values >> _SHIFT)) * _MIX_1
    values = (values ^ (values >> _SHIFT)) * _MIX_2
    return values ^ (values >> _SHIFT)


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and \\t..\\r, as UTF-8; bytes.split() cuts at just these six."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def groups(batch: pa.RecordBatch, column: str = "text", chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of a batch in consecutive groups of bounded size: (row of the first, texts)."""
    first, held, size = 0, [], 0
    for row, text in enumerate(batch.column(column).to_pylist() if batch.num_rows < 64 else _texts(batch.column(column))):
        held.append(text)
        size += len(text or "")
        if size >= chars:
            yield first, held
            first, held, size = row + 1, [], 0
    if held:
        yield first, held


def _texts(column: pa.Array) -> Iterator[str | None]:
    for start in range(0, len(column), 64):
        yield from column.slice(start, 64).to_pylist()


def numbered(documents: list[list[bytes]], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The documents' words as 64-bit hashes in one array, and where each document starts (with the end last)."""
    bounds = np.zeros(len(documents) + 1, np.int64)
    np.cumsum([len(d) for d in documents], out=bounds[1:])
    flat = [w for d in documents for w in d]
    known = {w: xxhash.xxh3_64_intdigest(w, seed) for w in set(flat)}
    return np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat)), bounds

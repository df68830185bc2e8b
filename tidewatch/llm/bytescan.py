"""Runs of whole texts as NumPy views of Arrow buffers, shared by the operators that count or hash bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of texts that are scanned at once; one longer text is a run of its own.
RUN_BYTES = 2 << 20


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; a null text is an empty one.

    Text ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``; the offsets start at 0.
    """
    import pyarrow as pa

    wide = column.cast(pa.large_string()).fill_null("")
    n = len(wide)
    _, ends, data = wide.buffers()
    at = np.frombuffer(ends, np.int64)[wide.offset : wide.offset + n + 1] if n else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together (or one text)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def packed(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of texts that are already bytes."""
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return np.frombuffer(b"".join(parts), np.uint8), offsets

"""Content-defined chunks of UTF-8 bytes by a gear rolling hash."""

import numpy as np

from claimloom.llm.common import salted

_GEAR = (salted(57, 256) >> np.uint64(29)).astype(np.uint32)
#: A cut depends on this many bytes before it, so it moves with them.
WINDOW = 16


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of gear[byte i] << distance over the last WINDOW bytes, by doubling the width."""
    value, width = _GEAR[data], 1
    while width < WINDOW:
        wider = value.copy()
        wider[width:] += value[:-width] << np.uint32(width)
        value, width = wider, 2 * width
    return value


def chunk_cuts(data: np.ndarray, offsets: np.ndarray, least: int, bits: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of all documents in order: starts, ends, document numbers.

    A chunk ends where `bits` bits of the gear hash are zero, after `least` bytes at the earliest and `most` bytes at
    the latest; the last chunk of a document may be shorter. `least` >= WINDOW keeps other documents out of the hash.
    """
    assert WINDOW <= least <= most
    marks = np.flatnonzero((gear_hashes(data) >> np.uint32(WINDOW)) & np.uint32((1 << bits) - 1) == 0) + 1
    marks = np.append(marks, len(data))
    doc = np.flatnonzero(offsets[1:] > offsets[:-1])
    start, end = offsets[doc], offsets[doc + 1]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(doc):
        cut = marks[np.minimum(np.searchsorted(marks, start + least), len(marks) - 1)]
        cut = np.minimum(np.minimum(np.maximum(cut, start + least), start + most), end)
        found.append((start, cut, doc))
        go = cut < end
        start, end, doc = cut[go], end[go], doc[go]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    starts, ends, docs = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order], docs[order]

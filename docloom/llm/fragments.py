"""Cut texts where byte-level vocabularies of the GPT-2 kind never join, and treat each distinct part once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from docloom.llm import blocks as B

#: Fixed value: the split pattern for which the cuts are proven.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Lead bytes of characters of which some are white space.
_LEADS = np.zeros(256, dtype=bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Bytes that aren't ASCII white space or control characters.
_INK = np.ones(256, dtype=bool)
_INK[:0x21] = False
_INK[0x7F] = False
#: Longer parts aren't remembered.
LONG = 256


@dataclass
class Fragments:
    """distinct: the distinct parts; part: the number of each part in order; first: the first part of each text, and the end."""

    distinct: list[bytes]
    part: np.ndarray
    first: np.ndarray


def cuts_of(buf: np.ndarray, offsets: np.ndarray, cut: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the parts, and the first part of each text and the end.

    A text is cut before each single space that stands between two characters of which
    neither may be white space. No match of PATTERN spans the left edge of such a space,
    and a match that starts there doesn't depend on what was before; so the tokens of a
    text are those of its parts. Without cut each text is one part.
    """
    heads = offsets[:-1][offsets[1:] > offsets[:-1]]
    at = np.flatnonzero(buf == 0x20) if cut else heads[:0]
    if len(at):
        inner = np.ones(len(buf) + 1, dtype=bool)
        inner[offsets[:-1]] = False
        at = at[inner[at] & inner[at + 1] & (at + 1 < len(buf))]
        left, right = buf[at - 1], buf[at + 1]
        ok = _INK[left] & _INK[right] & ~_LEADS[right]
        wide = np.flatnonzero(ok & (left >= 0x80))
        before = at[wide]
        ok[wide] = ~(_LEADS[buf[np.maximum(before - 2, 0)]] | _LEADS[buf[np.maximum(before - 3, 0)]])
        at = np.sort(np.concatenate([heads, at[ok]]), kind="stable")
    else:
        at = heads
    return at, np.searchsorted(at, offsets)


def fragments_of(column: pa.Array | pa.ChunkedArray, cut: bool = True) -> Fragments:
    """The parts of a string column's texts; null and empty texts have none."""
    buf, offsets = B.utf8(column)
    starts, first = cuts_of(buf, offsets, cut)
    if not len(starts):
        return Fragments([], starts, first)
    edges = np.append(starts, len(buf)).astype(np.int64)
    parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(buf))])
    found = parts.dictionary_encode()
    return Fragments(found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64), first)


def spread(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + sizes[i]] for each i, one after another."""
    ends = np.cumsum(sizes)
    where = np.arange(int(ends[-1]) if len(ends) else 0)
    where += np.repeat(starts - (ends - sizes), sizes)
    return values[where]

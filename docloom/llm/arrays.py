"""Vectorised text primitives on UTF-8 buffers: word spans, hashes, packed sorted keys."""

from __future__ import annotations

import threading
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard

U = np.uint64
#: Multipliers of the word and gram hashes; any odd 64-bit numbers do.
_R = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
#: Keep the first n bytes of eight.
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=U)
#: Words of more bytes are hashed one by one.
LONG = 256

#: [\x20\x09-\x0D] parts words in the white-space sense.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: [\x00-\x2F\x3A-\x60\x7B-\x7F] parts words of lower-cased letters and digits.
PUNCT = np.zeros(256, dtype=bool)
PUNCT[0x00:0x30] = True
PUNCT[0x3A:0x61] = True
PUNCT[0x7B:0x80] = True
#: A-Z to a-z, all other bytes kept.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mapped(buf: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table[buf] for bytes, by the translation of byte strings, which is faster."""
    return np.frombuffer(buf.tobytes().translate(table.tobytes()), dtype=table.dtype)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public MurmurHash3 constants)."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def word_spans(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words of all documents, and the first word of each document.

    offsets has one entry more than there are documents; words never cross documents.
    The third array has len(offsets) entries: words of document d are first[d]:first[d + 1].
    """
    n = len(buf)
    if n == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    word = ~mapped(buf, separators)
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    cuts = offsets[:-1]
    before[cuts[cuts < n]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    cuts = offsets[1:] - 1
    after[cuts[(cuts >= 0) & (offsets[1:] > offsets[:-1])]] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of buf[starts[i]:ends[i]], equal for equal bytes wherever they stand.

    Words are read eight bytes at a time; the state is mixed after each, so that no sum
    over positions cancels. Words of more than LONG bytes go through xxh3. Different seeds
    give independent hashes.
    """
    state, lanes = _lanes(buf, starts, ends, LONG)
    out = mix(state + U((_R[3] * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF))
    for live, x in lanes:
        if live is None:
            out = mix(out ^ (x * U(_R[0])))
        else:
            out[live] = mix(out[live] ^ (x * U(_R[0])))
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].tobytes(), seed=seed)
    return out


def _lanes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, Iterator[tuple[np.ndarray | None, np.ndarray]]]:
    """Lengths, and the words' bytes by eight: which words still go on (None: all) and the next eight bytes of each.

    Bytes beyond a word's end are 0. Words of more than most bytes stop after the first eight.
    """
    left = ends - starts

    def run(at: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray | None, np.ndarray]]:
        padded = np.zeros(len(buf) + 8, dtype=np.uint8)
        padded[: len(buf)] = buf
        view = np.ndarray((len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        live = None
        while len(at):
            yield live, view[at] & _MASKS[np.minimum(left, 8)]
            go = np.flatnonzero((left > 8) & (left <= most)) if live is None else np.flatnonzero(left > 8)
            live, at, left = (go if live is None else live[go]), at[go] + 8, left[go] - 8

    return left.astype(U), run(starts, left)


def dense_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers that are equal for words of equal bytes, and for no others: hashes that were compared by their bytes."""
    hashes, first, number = np.unique(hash_spans(buf, starts, ends), return_index=True, return_inverse=True)
    size, lanes = _lanes(buf, starts, ends, 1 << 62)
    same = size == size[first][number]
    if same.all():
        other = first[number]
        for (live, x), (_, y) in zip(lanes, _lanes(buf, starts[other], ends[other], 1 << 62)[1]):
            if not np.array_equal(x, y):
                same[0] = False
                break
    if same.all():
        return number
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(buf[a:b].tobytes(), len(seen)) for a, b in zip(starts, ends)], dtype=np.int64)


def dense_grams(words: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the runs of k numbered words: equal for equal runs, and for no others."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    keys = grams(words.astype(U), k)
    _, first, number = np.unique(keys, return_index=True, return_inverse=True)
    other = first[number]
    if all(np.array_equal(words[j : j + n], words[other + j]) for j in range(k)):
        return number
    return np.unique(np.lib.stride_tricks.sliding_window_view(words, k), axis=0, return_inverse=True)[1].reshape(-1)


def join2(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of the ordered pair."""
    return mix(a * U(_R[0]) + mix(b * U(_R[1]) + U((_R[2] * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)))


def grams(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of k words; those that cross documents are to be masked by the caller."""
    if len(words) < k:
        return np.zeros(0, dtype=U)
    n, done, acc = len(words) - k + 1, 0, None
    level, size = words, 1
    rest = k
    while rest:
        if rest & 1:
            piece = level[done : done + n]
            acc = piece if acc is None else join2(acc, piece, salt + size)
            done += size
        rest >>= 1
        if rest:
            level = join2(level[: len(level) - size], level[size:], salt + size)
            size *= 2
    return mix(acc + U(k))


def gram_docs(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and documents of the runs of k words that stay in one document."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    docs = np.repeat(np.arange(len(counts)), counts)
    where = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[:-1], counts)
    return where, docs


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w entries, in log2(w) passes."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[w - size : w - size + n])


_ZSTD = threading.local()


def _compress(raw: bytes) -> bytes:
    """By the thread's own compressor: making one costs more than compressing a short array."""
    if not hasattr(_ZSTD, "compressor"):
        _ZSTD.compressor = zstandard.ZstdCompressor(level=1)
    return _ZSTD.compressor.compress(raw)


def _decompress(b: memoryview, size: int) -> bytes:
    if not hasattr(_ZSTD, "decompressor"):
        _ZSTD.decompressor = zstandard.ZstdDecompressor()
    return _ZSTD.decompressor.decompress(b, max_output_size=size)


def _planes(a: np.ndarray) -> tuple[bytes, bytes]:
    """Length, least entry and width of integers of at most 8 bytes, and the byte planes over the least."""
    a = np.ascontiguousarray(a).astype(U, copy=False)
    low, high = (int(a.min()), int(a.max())) if len(a) else (0, 0)
    width = ((high - low).bit_length() + 7) // 8
    if width > 1:
        raw = np.ascontiguousarray((a - U(low)).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    else:
        raw = (a - U(low)).astype(np.uint8).tobytes() if width else b""
    return len(a).to_bytes(8, "little") + low.to_bytes(8, "little") + bytes([width]), raw


def _joined(n: int, low: int, width: int, raw: memoryview | bytes) -> np.ndarray:
    if width == 0:
        return np.full(n, low, dtype=U)
    planes = np.frombuffer(raw, dtype=np.uint8)
    if width == 1:
        out = planes.astype(U)
    else:
        out = np.zeros((n, 8), dtype=np.uint8)
        out[:, :width] = planes.reshape(width, n).T
        out = out.reshape(-1).view(U)
    if low:
        out += U(low)
    return out


def _head(b: memoryview) -> tuple[int, int, int]:
    return int.from_bytes(b[:8], "little"), int.from_bytes(b[8:16], "little"), b[16]


def pack(a: np.ndarray) -> bytes:
    """Compress integers of at most 8 bytes by byte planes over the least; unpack() gives them back as uint64."""
    head, raw = _planes(a)
    return head + _compress(raw) if raw else head


def unpack(b: bytes) -> np.ndarray:
    b = memoryview(b)
    n, low, width = _head(b)
    return _joined(n, low, width, _decompress(b[17:], n * width) if n * width else b"")


def pack_columns(columns: list[np.ndarray]) -> bytes:
    """pack() for several arrays, compressed as one."""
    parts = [_planes(c) for c in columns]
    raw = b"".join(x for _, x in parts)
    return len(parts).to_bytes(2, "little") + b"".join(h for h, _ in parts) + (_compress(raw) if raw else b"")


def unpack_columns(b: bytes) -> list[np.ndarray]:
    b = memoryview(b)
    heads = [_head(b[2 + 17 * i : 19 + 17 * i]) for i in range(int.from_bytes(b[:2], "little"))]
    sizes = [n * width for n, _, width in heads]
    raw = memoryview(_decompress(b[2 + 17 * len(heads) :], sum(sizes))) if sum(sizes) else b""
    out, at = [], 0
    for head, size in zip(heads, sizes):
        out.append(_joined(*head, raw[at : at + size]))
        at += size
    return out


def pack_sorted(a: np.ndarray) -> bytes:
    """Compress an ascending array by its differences."""
    return pack(np.diff(a, prepend=U(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=U)


def stable_order(keys: np.ndarray) -> np.ndarray:
    """np.argsort(keys, kind="stable"), made for uint64.

    A key's leading bits and its place are sorted as one number, which takes less than half the time of sorting places
    by keys. The bits that find no room matter only between keys that agree in all others: where such a pair comes out
    in the wrong order, places are sorted by the whole keys.
    """
    n = len(keys)
    if n < 2 or keys.dtype != U:
        return np.argsort(keys, kind="stable")
    low, high = keys.min(), keys.max()
    bits = (n - 1).bit_length()
    drop = max(0, int(high - low).bit_length() + bits - 64)
    order = np.sort(((keys - low) >> U(drop) << U(bits)) | np.arange(n, dtype=U))
    order = (order & U((1 << bits) - 1)).view(np.int64)
    if drop:
        found = keys[order]
        if (found[1:] < found[:-1]).any():
            return np.argsort(keys, kind="stable")
    return order


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, ascending; the first place of each; and which of them stands at each place."""
    order = stable_order(keys)
    found = keys[order]
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return found[new], order[new], number


def sum_by_key(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of each column of values."""
    order = stable_order(keys)
    keys = keys[order]
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[cuts], *(np.add.reduceat(v[order], cuts) if len(cuts) else v[:0] for v in values)

"""Sorted orders and packed columns of the n-gram exchange."""

import numpy as np
import zstandard

from docloom.llm import arrays as A


def test_orders_equal_numpy_where_bits_find_no_room():
    r = np.random.default_rng(3)
    close = np.repeat(r.integers(0, 1 << 63, 500, dtype=A.U) << A.U(1), 40) + r.integers(0, 3, 20_000, dtype=A.U)
    for keys in [close, r.integers(0, 50, 5000, dtype=A.U), r.integers(1 << 50, 1 << 62, 5000, dtype=A.U), close[:1], close[:0], np.r_[close, A.U(0), A.U((1 << 64) - 1)], r.integers(-9, 9, 100)]:
        assert np.array_equal(A.stable_order(keys), np.argsort(keys, kind="stable"))
        got, want = A.distinct(keys), np.unique(keys, return_index=True, return_inverse=True)
        assert all(np.array_equal(x, y) for x, y in zip(got, want, strict=True))


def test_columns_are_compressed_as_one(monkeypatch):
    r = np.random.default_rng(4)
    columns = [np.zeros(1000, dtype=A.U), r.integers(5, 9, 1000), r.integers(0, 1 << 40, 1000, dtype=A.U) + A.U(1 << 63), np.full(1000, (1 << 64) - 1, dtype=A.U), np.arange(0), r.integers(0, 2, 7).astype(bool)]
    made = []
    monkeypatch.setattr(zstandard, "ZstdCompressor", lambda f=zstandard.ZstdCompressor, **k: made.append(1) or f(**k))
    for some in [columns, columns[:1], columns[4:5], []]:
        got = A.unpack_columns(A.pack_columns(some))
        assert len(got) == len(some) and all(np.array_equal(x, y.astype(A.U)) for x, y in zip(got, some))
    packed = [A.pack(c) for c in columns * 20]
    assert len(made) <= 1 and all(np.array_equal(A.unpack(p), c.astype(A.U)) for p, c in zip(packed, columns * 20))

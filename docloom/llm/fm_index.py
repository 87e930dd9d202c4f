"""Benchmark decontamination by an FM-index over each shard of the training texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom._ship import ensure_importable
from docloom.llm.memory import lean

SHARD_BYTES = 8 << 20
PATTERN_BYTES = 8 << 20
NO_ITEM = np.iinfo(np.int64).min
#: [\x00-\x2F\x3A-\x60\x7B-\x7F] parts words, after A-Z have been lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
SCHEMA = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, spans array<struct<start:int,stop:int>>, item_ids array<bigint>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WaveletTree:
    """Rank of a symbol in a sequence, bit level by bit level, for arrays of positions at once."""

    def __init__(self, seq: np.ndarray, bits: int) -> None:
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1
            ones = np.zeros(len(seq) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol stands before position at."""
        low = np.zeros_like(at)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            at = np.where(bit, zeros + ones[at], at - ones[at])
            low = np.where(bit, zeros + ones[low], low - ones[low])
        return at - low


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by prefix doubling."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        key = rank * (int(rank.max()) + 1)
        key[: n - step] += rank[step:]
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.r_[1, key[order][1:] != key[order][:-1]])
        rank[order] = new
        if new[-1] == n or step >= n:
            return order
        step *= 2


class FmIndex:
    """Counts and places of phrases in a sequence of symbols 1..sigma with 0 between texts.

    Inside, symbols are one higher and a unique 0 ends the sequence, so that stepping back
    from any suffix leads to the one before it.
    """

    def __init__(self, seq: np.ndarray, sigma: int, sample: int = 8) -> None:
        seq, sigma = np.append(seq.astype(np.int64) + 1, 0), sigma + 1
        order = suffix_array(seq)
        self.n = len(seq)
        self.last = seq[order - 1]
        self.first = np.r_[0, np.cumsum(np.bincount(seq, minlength=sigma + 1))].astype(np.int64)
        self.tree = WaveletTree(self.last, max(1, int(sigma).bit_length()))
        marked = order % sample == 0
        self.marked = marked
        self.marked_before = np.r_[0, np.cumsum(marked)]
        self.samples = order[marked]

    def find(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows low:high of each phrase, one a row of the matrix."""
        return self.find_at(phrases.reshape(-1), np.arange(len(phrases)) * phrases.shape[1], phrases.shape[1])

    def find_at(self, words: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows low:high of each phrase words[at : at + length], by backward search; phrases that are lost already aren't searched on."""
        low = np.zeros(len(at), dtype=np.int64)
        high = np.full(len(at), self.n, dtype=np.int64)
        live = np.arange(len(at))
        for j in range(length - 1, -1, -1):
            c = words[at[live] + j].astype(np.int64) + 1
            low[live] = self.first[c] + self.tree.rank(c, low[live])
            high[live] = np.maximum(low[live], self.first[c] + self.tree.rank(c, high[live]))
            live = live[high[live] > low[live]]
        return low, high

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows start: step back to the next sampled position."""
        out = np.zeros(len(rows), dtype=np.int64)
        todo, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            hit = self.marked[rows]
            out[todo[hit]] = self.samples[self.marked_before[rows[hit]]] + steps
            todo, rows = todo[~hit], rows[~hit]
            c = self.last[rows]
            rows = self.first[c] + self.tree.rank(c, rows)
            steps += 1
        return out


@dataclass
class Phrases:
    """Windows of some benchmark items: symbols of the words; the items' symbols one after another; for each length the
    places of its distinct windows; and the items of each window (owners[bounds[i] : bounds[i + 1]], NO_ITEM: a null id)."""

    symbols: dict[bytes, int]
    words: np.ndarray
    windows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]

    @property
    def shortest(self) -> int:
        return min(w[0] for w in self.windows)


def phrases_of(items: list[tuple[int | None, str | None]], width: int) -> Phrases | None:
    """None if no item has a word."""
    symbols: dict[bytes, int] = {}
    parts = [np.fromiter((symbols.setdefault(w, len(symbols) + 1) for w in words_of((text or "").encode("utf-8"))), dtype=np.int32) for _, text in items]
    sizes = np.array([len(x) for x in parts], dtype=np.int64)
    words = np.concatenate([np.zeros(0, dtype=np.int32), *parts])
    first = np.cumsum(sizes) - sizes
    windows = []
    for length in sorted({int(min(n, width)) for n in sizes if n}):
        own = np.flatnonzero(sizes >= width if length == width else sizes == length)
        n = sizes[own] - length + 1
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[own], n)
        item = np.array([NO_ITEM if items[i][0] is None else items[i][0] for i in own.tolist()], dtype=np.int64)
        order = np.lexsort((np.repeat(item, n), *(words[at + j] for j in range(length - 1, -1, -1))))
        at, item = at[order], np.repeat(item, n)[order]
        new = np.zeros(len(at), dtype=bool)
        new[:1] = True
        for j in range(length):
            new[1:] |= words[at[1:] + j] != words[at[:-1] + j]
        windows.append((length, at[new], item, np.append(np.flatnonzero(new), len(at))))
    return Phrases(symbols, words, windows) if windows else None


def hits_in_shard(texts: list[list[bytes]], phrases: Phrases) -> list[tuple[int, int, int, list[int]]]:
    """(document, first word, last word + 1, items) of each occurrence of a window.

    A word that no benchmark item has can't be in an occurrence. Such words, and stretches
    of other words shorter than the shortest window, are left out of the index.
    """
    get = phrases.symbols.get
    counts = np.array([len(w) for w in texts], dtype=np.int64)
    seq = np.fromiter((s for w in texts for s in (*map(get, w, repeat(0)), 0)), dtype=np.int32, count=int(counts.sum()) + len(texts))
    known = np.r_[False, seq > 0, False]
    starts, stops = np.flatnonzero(known[1:] & ~known[:-1]), np.flatnonzero(known[:-1] & ~known[1:])
    keep = stops - starts >= phrases.shortest
    starts, stops = starts[keep], stops[keep]
    if not len(starts):
        return []
    sizes = stops - starts + 1  # with the 0 that follows
    where = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    index = FmIndex(seq[where], len(phrases.symbols))
    first = np.r_[0, np.cumsum(counts + 1)]
    out = []
    for length, places, items, bounds in phrases.windows:
        low, high = index.find_at(phrases.words, places, length)
        for w in np.flatnonzero(high > low).tolist():
            at = where[index.places(np.arange(low[w], high[w]))]
            docs = np.searchsorted(first, at, side="right") - 1
            owners = items[bounds[w] : bounds[w + 1]].tolist()
            out += [(int(d), int(a - first[d]), int(a - first[d]) + length, owners) for d, a in zip(docs, at)]
    return out


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(blocks: list, shard_bytes: int):
    def shard(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        spans: list[list[tuple[int, int]]] = [[] for _ in ids]
        items: list[set[int]] = [set() for _ in ids]
        for block in blocks:
            phrases = block.value
            for d, a, b, owners in hits_in_shard(texts, phrases) if phrases else []:
                spans[d].append((a, b))
                items[d].update(o for o in owners if o != NO_ITEM)
            if len(blocks) > 1:  # one block of patterns in memory at a time; it is read again from disk
                block.__dict__.pop("_value", None)
        merged = [merge_spans(x) for x in spans]
        names = [",".join(sorted(str(x) for x in own)) for own in items]
        hit = [sum(b - a for a, b in x) for x in merged]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, type=pa.int64()),
                pa.array([len(w) for w in texts], type=pa.int64()),
                pa.array(hit, type=pa.int64()),
                pa.array([len(x) for x in items], type=pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in names]),
                pa.array([x > 0 for x in hit]),
                pa.array([[{"start": a, "stop": b} for a, b in x] for x in merged], type=pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                pa.array([sorted(x) for x in items], type=pa.list_(pa.int64())),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "item_ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), pc.fill_null(batch.column(1), b"")):
                raw = text.as_py()
                ids.append(i)
                texts.append(words_of(raw))
                size += len(raw)
                if size >= shard_bytes:
                    yield shard(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield shard(ids, texts)

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", width: int = 10, shard_bytes: int = SHARD_BYTES, pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """Words of each row of docs that lie in an occurrence of a benchmark window.

    A window is width consecutive words of an item, or all words of a shorter one. The
    benchmark is the query set: it is cut in blocks of at most pattern_bytes of text, each
    broadcast, and every training shard (shard_bytes of text) is indexed and searched for
    each block. No row of docs moves between tasks.

    Columns: doc_id, n_words, n_hit (words in an occurrence), n_items, items_sha256 (of the
    item ids as sorted strings, comma-joined), contaminated, spans (merged word ranges to
    remove), item_ids. Null or empty texts have no words and are never hit; an item without
    words has no window; an item with a null id is searched for, but no id of it is
    reported. Equal windows of several items report all of them. Null ids and repeated rows
    stay; texts of any length are searched whole; an empty table gives no rows, and an
    empty benchmark no hits. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    ensure_importable(spark)
    items = benchmark.select(F.col(item_id_col).cast("bigint").alias("i"), F.col(item_text_col).cast("string").alias("t")).filter("t is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first().n
    n = max(1, -(-total // pattern_bytes))
    blocks = []
    for b in range(n):
        own = items if n == 1 else items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b)
        blocks.append(spark.sparkContext.broadcast(phrases_of([(r.i, r.t) for r in own.collect()], width)))
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string").cast("binary"))
    return rows.mapInArrow(lean(_scan(blocks, shard_bytes)), SCHEMA)

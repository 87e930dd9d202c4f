"""Incremental removal of repeated passages through a log-structured index of window fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import arrays as A
from docloom.llm import blocks as B
from docloom.llm.workspace import Workspace

#: Words of the runs whose least hash is a window's fingerprint.
ANCHOR = 16
RUN_SCHEMA = "shard bigint, keys binary, extra binary"
RESULT_SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


class Words:
    """The words of a block, its windows and their fingerprints."""

    def __init__(self, block: B.Block, width: int) -> None:
        self.block, self.width = block, width
        self.buf, self.starts, self.ends, self.first = block.words(A.SPACES, lower=False)
        self.hashes = A.hash_spans(self.buf, self.starts, self.ends)
        self.at, self.doc = A.gram_docs(self.first, width)
        k = min(ANCHOR, width)
        least = A.sliding_min(A.grams(self.hashes, k), width - k + 1)
        self.anchor = least[self.at] if len(self.at) else np.zeros(0, dtype=A.U)

    def candidates(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places, keys, checks (of independent word hashes) and ids of the windows whose fingerprint is among shared (ascending)."""
        if not len(shared) or not len(self.at):
            none = np.zeros(0, dtype=np.int64)
            return none, none.astype(A.U), none.astype(A.U), none
        hit = shared[np.minimum(np.searchsorted(shared, self.anchor), len(shared) - 1)] == self.anchor
        at = self.at[hit]
        keys = A.grams(self.hashes, self.width)[at]
        checks = A.grams(A.hash_spans(self.buf, self.starts, self.ends, seed=1), self.width, salt=1)[at]
        return at, keys, checks, self.block.ids[self.doc[hit]]


def _entries(keys: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of distinct (key, check, id), and for each input the place of its entry."""
    order = np.lexsort((ids, checks, keys))
    k, c, d = keys[order], checks[order], ids[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1]) | (d[1:] != d[:-1])] if len(k) else np.zeros(0, dtype=bool)
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def _anchor_message(width: int):
    def make(block: B.Block, _: list):
        w = Words(block, width)
        ids = w.block.ids[w.doc]
        order = np.lexsort((ids, w.anchor))
        a, d = w.anchor[order], ids[order]
        if not len(a):
            return a, [d]
        cut = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        return a[cut], [np.maximum.reduceat(d, cut) != np.minimum.reduceat(d, cut)]

    return make


def _merge(shard: int, blocks: list, keys: list, columns: list) -> tuple:
    """One shard: merge-join the batch's sorted arrays with the sorted runs of the past, and make the batch's run."""
    none = np.zeros(0, dtype=A.U)
    now = [(b, k, c[0]) for b, k, c in zip(blocks, keys, columns) if b != B.EXTRA]
    past = [(k, c[0]) for b, k, c in zip(blocks, keys, columns) if b == B.EXTRA]
    all_keys = np.concatenate([none, *(k for _, k, _ in now)])
    several = np.concatenate([none, *(s for _, _, s in now)]).astype(np.int64)
    owner = np.concatenate([none, *(np.full(len(k), b, dtype=A.U) for b, k, _ in now)])
    order = np.argsort(all_keys, kind="stable")
    all_keys, owner, several = all_keys[order], owner[order], several[order]
    fresh, n, more = A.sum_by_key(all_keys, np.ones(len(all_keys), dtype=np.int64), several)
    shared = (n > 1) | (more > 0)
    old_hits: dict[int, list[np.ndarray]] = {}
    for old, owners in past:  # both sides ascend: a merge join
        if not len(fresh) or not len(old):
            continue
        at = np.minimum(np.searchsorted(fresh, old), len(fresh) - 1)
        met = fresh[at] == old
        shared[at[met]] = True
        by = np.argsort(owners[met], kind="stable")
        found, cut = np.unique(owners[met][by], return_index=True)
        for b, part in zip(found.tolist(), np.split(old[met][by], cut[1:])):
            old_hits.setdefault(b, []).append(np.unique(part))
    to = [b for b, _, _ in now] + list(old_hits)
    replies = [[shared[np.searchsorted(fresh, own)]] for _, own, _ in now] + [[np.unique(np.concatenate(x))] for x in old_hits.values()]
    return to, replies, (A.pack_sorted(all_keys), A.pack_columns([owner]), None) if now else None


def _shared_keys(w: Words, reply: list[np.ndarray], new: bool) -> np.ndarray:
    if not reply:
        return np.zeros(0, dtype=A.U)
    return np.unique(w.anchor)[reply[0].astype(bool)] if new else reply[0]


def _window_message(width: int, group: int):
    def make(block: B.Block, replies: list):
        w = Words(block, width)
        _, keys, checks, ids = w.candidates(_shared_keys(w, replies[0], block.block >> 48 == group))
        use, _ = _entries(keys, checks, ids)
        return keys[use], [checks[use], ids[use].astype(A.U) ^ A.U(1 << 63)]

    return make


def _verify(shard: int, blocks: list, keys: list, columns: list) -> tuple:
    """One shard of exact windows: those that a smaller id has too."""
    sizes = np.cumsum([len(k) for k in keys])
    k, c, d = (np.concatenate(x) for x in (keys, [x[0] for x in columns], [x[1] for x in columns]))
    order = np.lexsort((d, c, k))
    k, c, d = k[order], c[order], d[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    dup = np.zeros(len(k), dtype=bool)
    dup[order] = d > least
    return blocks, [[x] for x in np.split(dup, sizes[:-1])], None


def _remove(width: int, group: int, keep_text: bool):
    def make(block: B.Block, replies: list) -> pa.RecordBatch:
        w = Words(block, width)
        at, keys, checks, ids = w.candidates(_shared_keys(w, replies[0], True))
        _, place = _entries(keys, checks, ids)
        dup = replies[1][0].astype(bool) if replies[1] else np.zeros(0, dtype=bool)
        edge = np.zeros(len(w.starts) + width + 1, dtype=np.int32)
        hit = at[dup[place]] if len(at) else at
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + width, -1)
        gone = np.cumsum(edge)[: len(w.starts)] > 0
        kept = np.flatnonzero(~gone)
        sizes = w.ends[kept] - w.starts[kept] + 1
        stop = np.cumsum(sizes)
        source = np.repeat(w.starts[kept] - (stop - sizes), sizes) + np.arange(int(sizes.sum()))
        text = w.buf[np.minimum(source, max(0, len(w.buf) - 1))] if len(source) else np.zeros(0, dtype=np.uint8)
        text[stop - 1] = 0x20
        bounds = np.r_[0, stop][np.searchsorted(kept, w.first)]
        raw = text.tobytes()
        texts = [raw[a : b - 1] if b > a else b"" for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        lost = np.r_[0, np.cumsum(gone)]
        return pa.RecordBatch.from_arrays(
            [
                block.id_array(),
                pa.array(np.diff(w.first).astype(np.int64)),
                pa.array((lost[w.first[1:]] - lost[w.first[:-1]]).astype(np.int64)),
                pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
                pa.array([x.decode("utf-8") for x in texts] if keep_text else [None] * len(texts), type=pa.string()),
            ],
            [x.split()[0] for x in RESULT_SCHEMA.split(", ")],
        )

    return make


def _compacted(bits: int):
    """One shard's part of several runs as one sorted run."""

    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        keys = np.concatenate([B.opened_keys(x[0], shard, 64, bits) for x in table["keys"].to_pylist()])
        owners = np.concatenate([A.unpack_columns(x[0])[0] for x in table["extra"].to_pylist()])
        order = np.argsort(keys, kind="stable")
        return pa.table({"shard": table["shard"][:1], "keys": pa.array([A.pack_sorted(keys[order])], type=pa.binary()), "extra": pa.array([A.pack_columns([owners[order]])], type=pa.binary())})

    return run


class FingerprintIndex:
    """Sorted immutable runs of window fingerprints, and the texts that they were taken of.

    A window's fingerprint is the least hash of its runs of ANCHOR words (winnowing), so
    that equal windows have equal fingerprints and neighbouring windows mostly share one:
    the index holds about one fingerprint for eighteen words. A run is a Parquet folder of
    one row a key range: ascending fingerprints and the blocks of text that have them.
    """

    def __init__(self, spark, path: str, *, width: int = 50, fanout: int = 4) -> None:
        self.store, self.width, self.fanout = Workspace(spark, "", path), width, max(2, fanout)

    def runs(self) -> list[str]:
        return self.store.tables("runs")

    def add(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
        """Index a batch; (doc_id, n_words, n_removed, kept_sha256, kept) of its rows.

        A word goes if a window of width words over it also starts in a document with a
        smaller id, in this batch or any before it. Matching fingerprints only nominate
        windows: these are then verified by 128 bits of their own words (of two independent
        word hashes), with those of all blocks that own the fingerprint, old and new.
        Batches are to come in ascending order of ids; results given for earlier batches
        stay as they were.

        Null texts have no words; texts of any length are read whole. A null id is larger
        than all others, and equal ids don't remove each other's words. An empty batch
        gives no rows. Other columns are not read, whatever their names.
        """
        spark, store, width = docs.sparkSession, self.store, self.width
        old = store.tables("texts")
        group = len(old) + 1
        ws = Workspace(spark, "dedup")
        new = B.write_blocks(docs, Workspace(spark, "", store.path("texts")), f"{group:06d}", id_col, text_col, group=group)
        texts = spark.read.schema(B.BLOCK_SCHEMA).parquet(*(store.path(f"texts/{t}") for t in [*old, f"{group:06d}"]))
        size = replace(B.size_of(texts), n_buckets=B.size_of(new).n_buckets)
        runs = self.runs()
        more = None
        if runs:
            past = spark.read.schema(RUN_SCHEMA).parquet(*(store.path(f"runs/{r}") for r in runs))
            more = B.dealt(past, 64, size)
        told, kept = B.exchange(new, _anchor_message(width), _merge, bits=64, size=size, ws=ws, name="shared", more=more, keep=ws)
        kept.filter("keys is not null").select("shard", "keys", "extra").write.mode("overwrite").parquet(store.path(f"runs/l0-{group:06d}"))
        asked = B.with_replies(new, told)
        if old:
            past_texts = spark.read.schema(B.BLOCK_SCHEMA).parquet(*(store.path(f"texts/{t}") for t in old))
            asked = asked.unionByName(past_texts.join(told, "block"))
        exact, _ = B.exchange(asked, _window_message(width, group), _verify, bits=64, size=size, ws=ws, name="verified")
        rows = B.each_block(B.with_replies(B.with_replies(new, told), exact), _remove(width, group, keep_text), RESULT_SCHEMA)
        self.compact()
        return rows

    def compact(self) -> None:
        """Merge the runs of a level into one of the next, wherever fanout of them have gathered."""
        spark, store = self.store.spark, self.store
        level = 0
        while any(r.startswith(f"l{level}-") for r in self.runs()) or any(int(r[1:].split("-")[0]) > level for r in self.runs()):
            own = [r for r in self.runs() if r.startswith(f"l{level}-")]
            if len(own) >= self.fanout:
                rows = spark.read.schema(RUN_SCHEMA).parquet(*(store.path(f"runs/{r}") for r in own))
                size = B.size_of(spark.read.schema(B.BLOCK_SCHEMA).parquet(store.path("texts/*")))
                B.dealt(rows, 64, size).groupBy("shard").applyInArrow(_compacted(size.shard_bits), RUN_SCHEMA).write.mode("overwrite").parquet(store.path(f"merging/l{level + 1}-{own[-1].split('-')[1]}"))
                store.move(f"merging/l{level + 1}-{own[-1].split('-')[1]}", f"runs/l{level + 1}-{own[-1].split('-')[1]}")
                for r in own:
                    store.drop(f"runs/{r}")
            level += 1


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 50, batches: int = 2, keep_text: bool = False) -> DataFrame:
    """FingerprintIndex.add() over all of docs, in batches of ascending ids, from an empty index."""
    spark = docs.sparkSession
    index = FingerprintIndex(spark, Workspace(spark, "dedup-index").root, width=width, fanout=max(2, batches))
    at = [i / batches for i in range(1, batches)]
    cuts = sorted(set(docs.agg(F.percentile_approx(F.col(id_col).cast("bigint"), at, 10_000).alias("q")).first().q or [])) if at else []
    out = None
    for low, high in zip([None, *cuts], [*cuts, None]):
        own = docs
        if low is not None:
            own = own.filter((F.col(id_col) > low) | (F.col(id_col).isNull() if high is None else F.lit(False)))
        if high is not None:
            own = own.filter(F.col(id_col) <= high)
        rows = index.add(own, id_col=id_col, text_col=text_col, keep_text=keep_text)
        out = rows if out is None else out.unionByName(rows)
    return out

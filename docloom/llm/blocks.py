"""Blocks of documents and the exchange of sorted key arrays with hash-range shards.

Corpus statistics of n-grams have as many keys as the corpus has words. Rows of one key
each would cost some 40 bytes a word in a shuffle. Here documents are packed in blocks of
bounded size; a block sends the shards of the key range compressed sorted arrays, the
shard merges the arrays of all blocks and answers each in the order of its own keys. A
frequent key is one entry a block, so no key, source or group of copies makes a hot task;
blocks and shards are both bounded, and their number grows with the corpus.

Blocks times shards would grow with the square of the corpus. So a block deals its keys to
2 ** FAN_BITS ranges only, whatever the number of shards, and sends nothing to a range
without keys; relays, each of which gathers the messages of 2 ** FAN_BITS times as many
blocks for one range, deal them on by the next bits until the ranges are shards. Every
level holds as much in a task as a block's message, and sends as many arrays as blocks
times 2 ** FAN_BITS at most. Answers go the same way back.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom._ship import ensure_importable
from docloom.llm import arrays as A
from docloom.llm.memory import lean
from docloom.llm.workspace import Workspace

BLOCK_BYTES = 3 << 20
SHARD_BYTES = 6 << 20
#: Text bytes of a bucket of blocks, which one task reads block by block, and the most buckets that Spark allows by default.
BUCKET_BYTES, MOST_BUCKETS = 12 << 20, 100_000
BLOCK_SCHEMA = "block bigint, ids array<bigint>, lengths binary, body binary, n_bytes bigint"
#: Bits of the key by which one level deals.
FAN_BITS = 8
#: Blocks of a task whose messages for one range travel in one row.
ROW_BLOCKS = 4
MESSAGE_SCHEMA = "shard bigint, slot bigint, blocks array<bigint>, keys array<binary>, extra array<binary>"
SERVED_SCHEMA = "shard bigint, slot bigint, blocks array<bigint>, replies array<binary>, keys binary, extra binary, stats array<bigint>"
#: In place of a block's number: a row that the operator adds for a shard.
EXTRA = -1
NO_ID = np.iinfo(np.int64).max


@dataclass
class Block:
    """ids: int64, NO_ID where the id is null; offsets: of the documents' bytes in buf."""

    block: int
    ids: np.ndarray
    offsets: np.ndarray
    buf: np.ndarray

    def words(self, separators: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The buffer used, starts, ends and first word of each document."""
        buf = A.mapped(self.buf, A.LOWER) if lower else self.buf
        return buf, *A.word_spans(buf, self.offsets, separators)

    def id_array(self) -> pa.Array:
        return pa.array(self.ids, mask=self.ids == NO_ID)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pack_rows(batches: Iterator[pa.RecordBatch], limit: int, group: int) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    ids, lengths, bodies, size = [], [], [], 0

    def flush() -> pa.RecordBatch:
        body = zstandard.ZstdCompressor(level=5).compress(b"".join(bodies))
        row = [[(group << 48) + (part << 24) + seq], pa.array([pa.concat_arrays(ids)], type=pa.list_(pa.int64())), [A.pack(np.concatenate(lengths))], [body], [size]]
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in row], ["block", "ids", "lengths", "body", "n_bytes"])

    for batch in batches:
        buf, offsets = utf8(batch.column(1))
        own = batch.column(0).cast(pa.int64())
        start = 0
        while start < len(own):
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + max(0, limit - size), side="right")) - 1)
            end = min(end, len(own))
            ids.append(own.slice(start, end - start))
            lengths.append(np.diff(offsets[start : end + 1]))
            bodies.append(buf[offsets[start] : offsets[end]].tobytes())
            size += int(offsets[end] - offsets[start])
            start = end
            if size >= limit or sum(map(len, ids)) >= 200_000 or start < len(own):
                yield flush()
                seq += 1
                ids, lengths, bodies, size = [], [], [], 0
    if ids:
        yield flush()


def write_blocks(docs: DataFrame, ws: Workspace, table: str, id_col: str, text_col: str, group: int = 0) -> DataFrame:
    """Pack (id, text) in blocks of about BLOCK_BYTES; a longer text is a block of its own.

    The table is written, so that the numbers of the blocks and their contents are fixed
    for all later passes, whatever tasks are run again; it is bucketed by number, so that
    replies come to the blocks and the texts stay where they are. group is part of the
    numbers.
    """
    ensure_importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    limit = BLOCK_BYTES
    packed = rows.mapInArrow(lean(lambda b: _pack_rows(b, limit, group)), BLOCK_SCHEMA)
    n = max(1, min(MOST_BUCKETS, -(-total // BUCKET_BYTES)))
    return ws.write_bucketed(packed.repartition(n, "block"), table, "block", n)


@dataclass
class Size:
    """Of a table of blocks, and how it is dealt."""

    n_blocks: int
    n_bytes: int
    n_buckets: int
    shard_bytes: int
    fan_bits: int

    @property
    def shard_bits(self) -> int:
        """log2 of how many shards there are, so that one holds about the keys of shard_bytes of text."""
        return math.ceil(math.log2(self.n_bytes / self.shard_bytes)) if self.n_bytes > self.shard_bytes else 0

    @property
    def levels(self) -> int:
        return max(1, -(-self.shard_bits // self.fan_bits))

    def depth(self, level: int) -> int:
        """Bits of the key that are dealt by after so many levels."""
        return min(self.shard_bits, self.fan_bits * level)

    def slot(self, block: int, level: int) -> int:
        """Which blocks go through one relay of a level together."""
        return int(A.mix(np.array([block], dtype=A.U))[0] % A.U(max(1, self.n_blocks))) >> (self.fan_bits * level)


def size_of(blocks: DataFrame) -> Size:
    r = blocks.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()
    return Size(r.n, r.b, max(1, min(MOST_BUCKETS, -(-r.b // BUCKET_BYTES))), SHARD_BYTES, FAN_BITS)


def key_bits(n_bytes: int, spare: int) -> int:
    """Bits of a key so that a key is taken for another with chance 2 ** -spare, whatever the corpus's size."""
    return min(64, math.ceil(math.log2(max(2, n_bytes))) + spare)


def open_block(block: int, ids: pa.Array, lengths: bytes, body: bytes) -> Block:
    sizes = A.unpack(lengths).astype(np.int64)
    raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=int(sizes.sum()) + 1)
    buf = np.frombuffer(raw, dtype=np.uint8)
    return Block(block, pc.fill_null(ids, int(NO_ID)).to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)].astype(np.int64), buf)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch, i


def _block_at(batch: pa.RecordBatch, i: int) -> Block:
    get = lambda name: batch.column(batch.schema.get_field_index(name))[i]
    return open_block(get("block").as_py(), get("ids").values, get("lengths").as_py(), get("body").as_py())


def cut(keys: np.ndarray, columns: list[np.ndarray], bits: int, depth: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(range, keys, columns) of each range of the first depth bits that has keys; keys ascend."""
    numbers = keys >> A.U(bits - depth) if depth else np.zeros(len(keys), dtype=A.U)
    starts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
        n = int(numbers[a])
        yield n, A.pack_sorted(keys[a:b] - A.U(n << (bits - depth) if depth else 0)), A.pack_columns([c[a:b] for c in columns])


def opened_keys(packed: bytes, shard: int, bits: int, depth: int) -> np.ndarray:
    return A.unpack_sorted(packed) + A.U(shard << (bits - depth) if depth else 0)


def dealt(kept: DataFrame, bits: int, size: Size) -> DataFrame:
    """Stored arrays (keys, extra: ascending keys and packed columns) as messages of no block to the shards of an exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, extra in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = _Rows()
                for shard, k, e in cut(A.unpack_sorted(keys), A.unpack_columns(extra), bits, size.shard_bits):
                    rows.add(0, shard, EXTRA, k, e)
                yield rows.batch()

    return kept.select("keys", "extra").mapInArrow(lean(run), MESSAGE_SCHEMA)


class _Rows:
    """Rows of MESSAGE_SCHEMA, gathered by slot and range."""

    def __init__(self) -> None:
        self.found: dict[tuple[int, int], list[tuple[int, bytes, bytes]]] = {}

    def add(self, slot: int, shard: int, block: int, keys: bytes, extra: bytes) -> None:
        self.found.setdefault((slot, shard), []).append((block, keys, extra))

    def batch(self) -> pa.RecordBatch:
        rows = list(self.found.items())
        column = lambda i, kind: pa.array([[x[i] for x in own] for _, own in rows], type=pa.list_(kind))
        self.found = {}
        return pa.RecordBatch.from_arrays(
            [pa.array([k[1] for k, _ in rows], type=pa.int64()), pa.array([k[0] for k, _ in rows], type=pa.int64()), column(0, pa.int64()), column(1, pa.binary()), column(2, pa.binary())],
            ["shard", "slot", "blocks", "keys", "extra"],
        )


Make = Callable[[Block, list], tuple[np.ndarray, list[np.ndarray]]]
Serve = Callable[[int, list, list, list], tuple[list, list, "tuple | None"]]


def messages(blocks: DataFrame, make: Make, bits: int, size: Size) -> DataFrame:
    """What the blocks tell the ranges of the first level.

    make(block, replies) gives ascending keys of so many bits and columns of integers that
    go with them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = _Rows(), 0
        for batch, i in _rows(batches):
            block = _block_at(batch, i)
            slot = size.slot(block.block, 1) if size.levels > 1 else 0
            for shard, keys, extra in cut(*make(block, replies_at(batch, i)), bits, size.depth(1)):
                rows.add(slot, shard, block.block, keys, extra)
            held += 1
            if held == ROW_BLOCKS:
                yield rows.batch()
                held = 0
        if held:
            yield rows.batch()

    return blocks.mapInArrow(lean(run), MESSAGE_SCHEMA)


def _entries(table: pa.Table, *names: str) -> Iterator[tuple]:
    for row in zip(*(table[n].to_pylist() for n in names)):
        yield from zip(*([x] * len(row[1]) if not isinstance(x, list) else x for x in row))


def _relay(level: int, bits: int, size: Size):
    """Deal the messages for one range on by the next bits."""

    def run(table: pa.Table) -> pa.Table:
        rows = _Rows()
        slot = table["slot"][0].as_py()
        for shard, block, keys, extra in _entries(table, "shard", "blocks", "keys", "extra"):
            for n, k, e in cut(opened_keys(keys, shard, bits, size.depth(level)), A.unpack_columns(extra), bits, size.depth(level + 1)):
                rows.add(slot >> size.fan_bits if level + 1 < size.levels else slot, n, block, k, e)
        return pa.Table.from_batches([rows.batch()])

    return run


def _answer(serve: Serve, bits: int, size: Size):
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        found = sorted(_entries(table, "shard", "blocks", "keys", "extra"), key=lambda x: x[1])
        blocks = [x[1] for x in found]
        keys = [opened_keys(x[2], shard, bits, size.shard_bits) for x in found]
        to, replies, own = serve(shard, blocks, keys, [A.unpack_columns(x[3]) for x in found])
        by: dict[int, list] = {}
        for block, columns in zip(to, replies):
            by.setdefault(size.slot(block, size.levels - 1) if size.levels > 1 else 0, []).append((block, A.pack_columns(columns)))
        rest = [None] * len(by)
        keys, extra, stats = own or (None, None, None)
        return pa.table(
            {
                "shard": pa.array([shard] * (len(by) + 1), type=pa.int64()),
                "slot": pa.array([*by, None], type=pa.int64()),
                "blocks": pa.array([*([b for b, _ in x] for x in by.values()), None], type=pa.list_(pa.int64())),
                "replies": pa.array([*([r for _, r in x] for x in by.values()), None], type=pa.list_(pa.binary())),
                "keys": pa.array([*rest, keys], type=pa.binary()),
                "extra": pa.array([*rest, extra], type=pa.binary()),
                "stats": pa.array([*rest, stats], type=pa.list_(pa.int64())),
            }
        )

    return run


def _back(level: int, size: Size):
    """Join the answers of the ranges below one range, block by block."""

    def run(table: pa.Table) -> pa.Table:
        parts: dict[int, list[tuple[int, list[np.ndarray]]]] = {}
        shard = 0
        for at, block, reply in _entries(table, "shard", "blocks", "replies"):
            shard = at >> (size.depth(level + 1) - size.depth(level))
            parts.setdefault(block, []).append((at, A.unpack_columns(reply)))
        by: dict[int, list] = {}
        for block, own in parts.items():
            own.sort(key=lambda x: x[0])
            whole = A.pack_columns([np.concatenate(c) for c in zip(*(x[1] for x in own))])
            by.setdefault(size.slot(block, level - 1) if level > 1 else 0, []).append((block, whole))
        return pa.table(
            {
                "shard": pa.array([shard] * len(by), type=pa.int64()),
                "slot": pa.array(list(by), type=pa.int64()),
                "blocks": pa.array([[b for b, _ in x] for x in by.values()], type=pa.list_(pa.int64())),
                "replies": pa.array([[r for _, r in x] for x in by.values()], type=pa.list_(pa.binary())),
            }
        )

    return run


def exchange(blocks: DataFrame, make: Make, serve: Serve, *, bits: int, size: Size, ws: Workspace, name: str, more: DataFrame | None = None, keep: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """The blocks' replies (block, name), and what the shards keep (shard, keys, extra, stats), in the workspace keep or ws.

    serve(shard, blocks, keys, columns) sees all arrays of one shard, block by block, and
    gives blocks, their replies (columns of integers in the order of the block's keys) and
    what it keeps or None. more has rows of the operator's own for shards, as messages of
    the block EXTRA. The answers are written before they are sorted out, so that a lost
    executor repeats a task of a shard and not the exchange.
    """
    told = messages(blocks, make, bits, size)
    for level in range(1, size.levels):
        told = told.groupBy("slot", "shard").applyInArrow(_relay(level, bits, size), MESSAGE_SCHEMA)
    if more is not None:
        told = told.unionByName(more)
    answers = told.groupBy("shard").applyInArrow(_answer(serve, bits, size), SERVED_SCHEMA)
    replies, own = ws.write_halves(answers, F.col("blocks").isNotNull(), f"{name}-served")
    back = replies.select("shard", "slot", "blocks", "replies")
    for level in range(size.levels - 1, 0, -1):
        above = F.shiftright("shard", size.depth(level + 1) - size.depth(level))
        back = back.withColumn("above", above).groupBy("slot", "above").applyInArrow(_back(level, size), "shard bigint, slot bigint, blocks array<bigint>, replies array<binary>")
    each = back.select("shard", F.explode(F.arrays_zip("blocks", "replies")).alias("x"))
    kept = kept_replies(each.select(F.col("x.blocks").alias("block"), "shard", F.col("x.replies").alias("reply")), name, ws, size)
    ws.drop(ws.half(f"{name}-served", True))
    if keep is not None and keep is not ws:
        own = keep.write(own, f"{name}-served/half=false")
    return kept, own.select("shard", "keys", "extra", "stats")


_BLOCK_COLUMNS = {x.split()[0] for x in BLOCK_SCHEMA.split(", ")}


def replies_at(batch: pa.RecordBatch, i: int) -> list[list[np.ndarray]]:
    """For each round asked for, the replies as columns over the block's keys; none for a block without keys."""
    out = []
    for name in batch.schema.names:
        if name not in _BLOCK_COLUMNS:
            found = batch.column(batch.schema.get_field_index(name))[i].as_py() or []
            parts = [A.unpack_columns(x["reply"]) for x in sorted(found, key=lambda x: x["shard"])]
            out.append([np.concatenate(c) for c in zip(*parts)])
    return out


def kept_replies(replies: DataFrame, name: str, ws: Workspace, size: Size) -> DataFrame:
    """(block, name): each block's replies, at most 2 ** FAN_BITS arrays, in the buckets of the blocks."""
    own = replies.repartition(size.n_buckets, "block").groupBy("block").agg(F.collect_list(F.struct("shard", "reply")).alias(name))
    return ws.write_bucketed(own, name, "block", size.n_buckets)


def with_replies(blocks: DataFrame, kept: DataFrame) -> DataFrame:
    return blocks.join(kept, "block", "left")


def each_block(blocks: DataFrame, make: Callable[[Block, list], pa.RecordBatch | None], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i in _rows(batches):
            out = make(_block_at(batch, i), replies_at(batch, i))
            if out is not None and out.num_rows:
                yield out

    return blocks.mapInArrow(lean(run), schema)

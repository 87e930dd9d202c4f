"""Byte-level BPE by a segment tree of pair ranks, and its inverse."""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom._ship import ensure_importable
from docloom.llm.fragments import LONG, PATTERN, fragments_of, spread
from docloom.llm.memory import trim

#: Entries of a worker's memos of parts and of pieces; they are emptied when full, which changes no result.
MEMO, MEMO_PIECES = 300_000, 150_000
#: Leaves of the trees that are in memory at once.
TREE_LEAVES = 1 << 16
#: Rows, and UTF-8 bytes unless a single text has more, that are encoded together.
STEP_ROWS, STEP_BYTES = 1000, 2 << 20
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary"


def load_ranks(lines: bytes) -> dict[bytes, int]:
    """token bytes -> rank from a file of 'base64 rank' lines."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}


class PairTree:
    """Leftmost minimum of the ranks of live neighbour pairs over byte positions.

    Leaf i holds the rank of the pair whose left token starts at byte i, or NONE. An inner
    node holds the smaller of its children as rank * size + position, so that equal ranks
    give the leftmost. A point update climbs log2(size) levels.
    """

    NONE = 1 << 62

    def __init__(self, ranks: list[int]) -> None:
        self.size = 1 << max(0, (len(ranks) - 1).bit_length())
        size = self.size
        self.node = [self.NONE] * (2 * size)
        for i, r in enumerate(ranks):
            if r >= 0:
                self.node[size + i] = r * size + i
        for i in range(size - 1, 0, -1):
            a, b = self.node[2 * i], self.node[2 * i + 1]
            self.node[i] = a if a <= b else b

    def put(self, i: int, rank: int) -> None:
        node, at = self.node, self.size + i
        node[at] = rank * self.size + i if rank >= 0 else self.NONE
        at >>= 1
        while at:
            a, b = node[2 * at], node[2 * at + 1]
            low = a if a <= b else b
            if node[at] == low:
                break
            node[at] = low
            at >>= 1

    def least(self) -> int:
        """Position of the leftmost pair of least rank, or -1."""
        return -1 if self.node[1] == self.NONE else self.node[1] & (self.size - 1)


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match of the split pattern: merge the leftmost pair of least rank until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    tree = PairTree([get(piece[i : i + 2], -1) for i in range(n - 1)])
    end = list(range(1, n + 1))  # end of the live token that starts at i
    before = list(range(-1, n - 1))  # start of the live token before that at i
    while (i := tree.least()) >= 0:
        mid = end[i]
        tree.put(mid, -1) if mid < n - 1 else None
        end[i] = stop = end[mid]
        if stop < n:
            before[stop] = i
            tree.put(i, get(piece[i : end[stop]], -1))
        else:
            tree.put(i, -1)
        if i:
            tree.put(before[i], get(piece[before[i] : stop], -1))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class PairTable:
    """Rank of the token that two neighbour tokens make, for arrays of token ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for whole, rank in ranks.items():
            for cut in range(1, len(whole)):
                left, right = ranks.get(whole[:cut]), ranks.get(whole[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.rank = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """-1 where the two make no token."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], -1)


def encode_pieces(pieces: list[bytes], table: PairTable) -> list[np.ndarray]:
    """encode_piece() for many pieces of up to 64 bytes at once: one segment tree a row.

    Every step merges the leftmost pair of least rank in each row that still has one, and
    climbs the levels of its tree for the three leaves that change.
    """
    out: list = [None] * len(pieces)
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    for bits in range(0, 7):
        size = 1 << bits
        for rows in _parts(np.flatnonzero((lengths <= size) & (lengths > size // 2)), TREE_LEAVES >> bits):
            _encode_rows(pieces, rows, lengths[rows], bits, table, out)
    return out


def _parts(rows: np.ndarray, most: int) -> list[np.ndarray]:
    return [rows[i : i + most] for i in range(0, len(rows), most)]


def _encode_rows(pieces: list[bytes], rows: np.ndarray, n: np.ndarray, bits: int, table: PairTable, out: list) -> None:
    """encode_pieces() for the pieces at rows, whose lengths n all need trees of 2 ** bits leaves."""
    size, k = 1 << bits, len(rows)
    raw = np.frombuffer(b"".join(pieces[r].ljust(size, b"\0") for r in rows), dtype=np.uint8).reshape(k, size)
    token = table.single[raw]
    after = np.tile(np.arange(1, size + 1), (k, 1))
    before = np.tile(np.arange(-1, size - 1), (k, 1))
    node = np.full((k, 2 * size), PairTree.NONE, dtype=np.int64)
    if size > 1:
        rank = table.of(token[:, :-1], token[:, 1:])
        rank[np.arange(1, size)[None, :] >= n[:, None]] = -1
        node[:, size : 2 * size - 1] = np.where(rank >= 0, (rank << bits) | np.arange(size - 1), PairTree.NONE)
        for i in range(size - 1, 0, -1):
            node[:, i] = np.minimum(node[:, 2 * i], node[:, 2 * i + 1])
    alive = np.arange(size)[None, :] < n[:, None]
    live = np.flatnonzero(node[:, 1] != PairTree.NONE) if size > 1 else np.zeros(0, dtype=np.int64)
    while len(live):
        low = node[live, 1]
        i = low & (size - 1)
        gone = after[live, i]
        stop = after[live, gone]
        token[live, i] = low >> bits
        alive[live, gone] = False
        after[live, i] = stop
        node[live, size + gone] = PairTree.NONE
        more = stop < n[live]
        before[live[more], stop[more]] = i[more]
        rank = np.full(len(live), -1, dtype=np.int64)
        rank[more] = table.of(token[live[more], i[more]], token[live[more], stop[more]])
        node[live, size + i] = np.where(rank >= 0, (rank << bits) | i, PairTree.NONE)
        prev = before[live, i]
        has = np.flatnonzero(prev >= 0)
        rank = table.of(token[live[has], prev[has]], token[live[has], i[has]])
        node[live[has], size + prev[has]] = np.where(rank >= 0, (rank << bits) | prev[has], PairTree.NONE)
        prev[prev < 0] = i[prev < 0]
        path = np.stack([gone, i, prev]) + size
        for _ in range(bits):
            path >>= 1
            node[live, path] = np.minimum(node[live, 2 * path], node[live, 2 * path + 1])
        live = live[node[live, 1] != PairTree.NONE]
    for x, r in enumerate(rows):
        out[r] = token[x][alive[x]].astype("<u4")


class ByteBpe:
    """Encode and decode whole texts; memos keep the ids of pieces and parts that came before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.cut = pattern == PATTERN
        self.table = PairTable(ranks)
        self.token_size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.token_size[i] = len(token)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.zeros(int(self.token_size.sum()), dtype=np.uint8)
        for token, i in ranks.items():
            self.token_bytes[self.token_start[i] : self.token_start[i] + len(token)] = np.frombuffer(token, dtype=np.uint8)
        self.memo: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _learn(self, parts: list[bytes]) -> dict[bytes, bytes]:
        split = {s: self.find(s.decode("utf-8")) for s in parts}
        new = list({p for pieces in split.values() for p in pieces} - self.pieces.keys())
        raw = [p.encode("utf-8") for p in new]
        short = [i for i, p in enumerate(raw) if len(p) <= 64]
        found = {new[i]: ids.tobytes() for i, ids in zip(short, encode_pieces([raw[i] for i in short], self.table))}
        found |= {new[i]: np.array(encode_piece(p, self.ranks), dtype="<u4").tobytes() for i, p in enumerate(raw) if len(p) > 64}
        use = self.pieces | found if len(self.pieces) + len(found) <= MEMO_PIECES else found | {p: self.pieces[p] for pieces in split.values() for p in pieces if p in self.pieces}
        self.pieces = use if len(raw) == len(short) else {p: x for p, x in use.items() if len(p) <= LONG}
        return {s: b"".join([use[p] for p in pieces]) for s, pieces in split.items()}

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the bounds of each text's."""
        found = fragments_of(texts, self.cut)
        new = [x for x in found.distinct if x not in self.memo]
        learnt = self._learn(new) if new else {}
        if len(self.memo) + len(new) > MEMO:
            self.memo = {x: self.memo[x] for x in found.distinct if x in self.memo}
        self.memo |= learnt
        own = [self.memo[x] for x in found.distinct]
        for x in new:
            if len(x) > LONG:
                del self.memo[x]
        flat = np.frombuffer(b"".join(own), dtype="<u4")
        sizes = np.array([len(x) // 4 for x in own], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        per_part = sizes[found.part]
        bounds = np.r_[0, np.cumsum(per_part)][found.first]
        return (spread(flat, starts[found.part], per_part) if len(per_part) else flat), bounds

    def decode_many(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, and the bounds of each text's."""
        sizes = self.token_size[ids]
        out = spread(self.token_bytes, self.token_start[ids], sizes) if len(ids) else self.token_bytes[:0]
        return out, np.r_[0, np.cumsum(sizes)][bounds]

    def encode(self, text: str) -> bytes:
        return self.encode_column(pa.array([text]))[0].tobytes()

    def decode(self, ids: bytes) -> bytes:
        own = np.frombuffer(ids, dtype="<u4")
        return self.decode_many(own, np.array([0, len(own)]))[0].tobytes()


_OPEN: dict[tuple[str, str], ByteBpe] = {}


def opened(file_name: str, pattern: str) -> ByteBpe:
    """The worker's encoder, made once a process from the file shipped with the job."""
    key = (file_name, pattern)
    if key not in _OPEN:
        with open(SparkFiles.get(file_name), "rb") as f:
            _OPEN[key] = ByteBpe(load_ranks(f.read()), pattern)
    return _OPEN[key]


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file to all executors; its name there, which is of its contents: files of one name differ."""
    with open(path, "rb") as f:
        body = f.read()
    name = f"vocabulary-{hashlib.sha256(body).hexdigest()}{os.path.splitext(path)[1]}"
    if not any(x.rsplit("/", 1)[-1] == name for x in spark.sparkContext.listFiles):
        target = os.path.join(tempfile.mkdtemp(prefix="docloom-"), name)
        with open(target, "wb") as f:
            f.write(body)
        spark.sparkContext.addFile(target)
    return name


def steps(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most STEP_ROWS and STEP_BYTES; a longer text has a range of its own."""
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(ends):
        within = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + STEP_BYTES, side="right"))
        stop = min(max(within, start + 1), start + STEP_ROWS, len(ends))
        yield start, stop
        start = stop


def encode_documents(docs: DataFrame, *, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each row; ids: little-endian uint32.

    A map over the rows without a shuffle; the vocabulary goes to each executor once. Null
    texts count as empty: no tokens. Null ids stay null, repeated rows stay repeated; texts
    of any length are encoded whole; an empty table gives no rows; other columns are not
    read, whatever their names. The decoded hash is of the bytes that the ids give back.
    With keep_ids=False the ids column is null. Texts are cut in parts (fragments.py) for
    fragments.PATTERN only; under any other pattern they are split whole.
    """
    spark = docs.sparkSession
    ensure_importable(spark)
    name = ship_file(spark, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened(name, pattern)
        for whole in batches:
            for start, stop in steps(pc.fill_null(pc.binary_length(whole.column(1)), 0).to_numpy(zero_copy_only=False)):
                batch = whole.slice(start, stop - start)
                ids, at = bpe.encode_column(batch.column(1))
                back, back_at = bpe.decode_many(ids, at)
                raw, back = [ids[a:b].tobytes() for a, b in zip(at, at[1:])], memoryview(back)
                columns = [
                    batch.column(0),
                    pa.array(np.diff(at), type=pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
                    pa.array([hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(back_at, back_at[1:])]),
                    pa.array(raw if keep_ids else [None] * len(raw), type=pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])
            trim()

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)

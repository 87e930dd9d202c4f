"""N-gram Jaccard join: documents whose word-shingle sets are alike, and the groups they form."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import arrays as A
from docloom.llm import blocks as B
from docloom.llm.components import components
from docloom.llm.memory import lean
from docloom.llm.workspace import Workspace

#: Text bytes whose sets are in memory together while pairs are verified.
VERIFY_BYTES = 2 << 20
#: Postings of a token that are compared with as many others at a time.
UNIT_ROWS = 512
#: Bits of a class's parity bitmap: each shingle flips one, so that two bitmaps differ in no more bits than the sets in shingles.
MAP_BITS = 1024
UNIT_COLUMNS = ("token", "i", "j", "digest", "own", "n", "shared", "pos", "met", "prev", "root", "bitmap")
#: Frequencies above this one are equal; they set the order of tokens only, and any order gives the same pairs.
MOST_DF = (1 << 31) - 1
PREFIX_SCHEMA = "doc_id bigint, digest binary, n int, shared int, token bigint, prev bigint, pos int, met int, body binary, bitmap binary"


def shingle_sets(block: B.Block, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes ascending by (document, hash): documents, hashes, first entry of each document."""
    buf, starts, ends, first = block.words(A.SPACES, lower=True)
    words = A.hash_spans(buf, starts, ends, seed)
    n_words = np.diff(first)
    where, docs = A.gram_docs(first, k)
    hashes = A.grams(words, k)[where] if len(where) else np.zeros(0, dtype=A.U)
    for short in range(1, k):  # the whole sequence is the one shingle of a shorter document
        at = np.flatnonzero(n_words == short)
        if len(at):
            hashes = np.concatenate([hashes, A.grams(words, short)[first[:-1][at]]])
            docs = np.concatenate([docs, at])
        order = np.argsort(docs, kind="stable")
        docs, hashes = docs[order], hashes[order]
    bounds = np.searchsorted(docs, np.arange(len(block.ids) + 1))
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        hashes[a:b].sort()
    if len(docs):
        keep = np.r_[True, (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])]
        docs, hashes = docs[keep], hashes[keep]
    return docs, hashes, np.searchsorted(docs, np.arange(len(block.ids) + 1))


def _df_message(bits: int, k: int):
    def make(block: B.Block, _: list) -> tuple:
        hashes = np.sort(shingle_sets(block, k)[1] >> A.U(64 - bits))
        keys, counts = A.sum_by_key(hashes, np.ones(len(hashes), dtype=np.int64))
        return keys, [counts]

    return make


def _df_shard(shard: int, blocks: list, keys: list, columns: list) -> tuple:
    """Sum the blocks' counts; answer each block in the order of its keys."""
    total_keys, totals = A.sum_by_key(np.concatenate(keys), np.concatenate([c[0] for c in columns]))
    totals = np.minimum(totals, A.U(MOST_DF))
    return blocks, [[totals[np.searchsorted(total_keys, x)]] for x in keys], None


def _prefixes(bits: int, k: int, threshold: Fraction):
    p, q = threshold.numerator, threshold.denominator

    def make(block: B.Block, replies: list) -> pa.RecordBatch:
        docs, hashes, first = shingle_sets(block, k)
        short = hashes >> A.U(64 - bits)
        keys = np.unique(short)
        df = replies[0][0] if replies[0] else np.zeros(0, dtype=A.U)
        df = df[np.searchsorted(keys, short)].astype(np.int32)
        n = np.diff(first)
        shared = np.add.reduceat(np.r_[df >= 2, False].astype(np.int32), first[:-1]) if len(n) else n
        shared = np.where(n > 0, shared, 0).astype(np.int32)
        prefix = n - (p * n + q - 1) // q + 1
        zip_text = zstandard.ZstdCompressor(level=1).compress
        digests, bodies, maps, owner, tokens, before, places, met = [], [], [], [], [], [], [], []
        _, other, at = shingle_sets(block, k, seed=1)
        for d, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
            digests.append(xxhash.xxh3_64_digest(hashes[a:b].tobytes()) + xxhash.xxh3_64_digest(other[at[d] : at[d + 1]].tobytes()) if b > a else None)
            own = np.zeros(0, dtype=np.int64)
            if b > a and (n[d] - shared[d] < prefix[d]):
                own = np.argsort(df[a:b], kind="stable")[n[d] - shared[d] : prefix[d]]
            bodies.append(zip_text(block.buf[block.offsets[d] : block.offsets[d + 1]].tobytes()) if len(own) else None)
            maps.append(np.packbits(np.bincount((hashes[a:b] & A.U(MAP_BITS - 1)).astype(np.int64), minlength=MAP_BITS) & 1).tobytes() if len(own) else None)
            owner.append(np.full(len(own), d))
            tokens.append(hashes[a:b][own])
            before.append(np.r_[A.U(0), hashes[a:b][own][:-1]][: len(own)])
            places.append(np.arange(n[d] - shared[d], n[d] - shared[d] + len(own)))
            met.append(np.arange(len(own)))
        extra = len(n)
        owner = np.concatenate([np.arange(extra), *owner]).astype(np.int64)
        flat = lambda x, kind: np.concatenate([np.zeros(extra, dtype=kind), *x]).astype(kind)
        return pa.RecordBatch.from_arrays(
            [
                block.id_array().take(pa.array(owner)),
                pa.array(digests, type=pa.binary()).take(pa.array(owner)),
                pa.array(n[owner].astype(np.int32)),
                pa.array(shared[owner]),
                pa.array(flat(tokens, A.U).view(np.int64), mask=np.arange(len(owner)) < extra),
                pa.array(flat(before, A.U).view(np.int64)),
                pa.array(flat(places, np.int32)),
                pa.array(flat(met, np.int32)),
                pa.array(bodies + [None] * (len(owner) - extra), type=pa.binary()),
                pa.array(maps + [None] * (len(owner) - extra), type=pa.binary()),
            ],
            ["doc_id", "digest", "n", "shared", "token", "prev", "pos", "met", "body", "bitmap"],
        )

    return make


def suffix_bound(x: np.ndarray, y: np.ndarray, most: int, depth: int = 4) -> int:
    """A lower bound of the size of the symmetric difference of two ascending arrays.

    Both are cut at the middle element of y, and each half on; the search ends as soon as
    the bound passes most.
    """
    if depth == 0 or len(x) == 0 or len(y) == 0:
        return abs(len(x) - len(y))
    mid = len(y) // 2
    cut = int(np.searchsorted(x, y[mid]))
    left = abs(cut - mid)
    right = abs((len(x) - cut) - (len(y) - mid))
    if left + right > most:
        return left + right
    left = suffix_bound(x[:cut], y[:mid], most - right, depth - 1)
    return left + right if left + right > most else left + suffix_bound(x[cut:], y[mid:], most - left, depth - 1)


def _need(nx, ny, threshold: Fraction):
    """The least overlap of sets of these sizes that reaches the threshold."""
    p, q = threshold.numerator, threshold.denominator
    return (p * (nx + ny) + p + q - 1) // (p + q)


def _sets_of(bodies: list[bytes], k: int) -> list[np.ndarray]:
    """The shingle sets of some texts as ascending numbers: equal for shingles of equal bytes, and for no others."""
    unzip = zstandard.ZstdDecompressor().decompress
    raw = [unzip(x) for x in bodies]
    offsets = np.r_[0, np.cumsum([len(x) for x in raw])].astype(np.int64)
    block = B.Block(0, np.zeros(len(raw), dtype=np.int64), offsets, np.frombuffer(b"".join(raw), dtype=np.uint8))
    buf, starts, ends, first = block.words(A.SPACES, lower=True)
    words = A.dense_words(buf, starts, ends)
    sets: list = [None] * len(raw)
    n_words = np.diff(first)
    for size in range(1, k + 1):
        own = np.flatnonzero(n_words == size) if size < k else np.flatnonzero(n_words >= k)
        if len(own):
            numbers = A.dense_grams(words, size) + size * len(words)  # shorter texts are one shingle of their own length
            for d in own.tolist():
                sets[d] = np.unique(numbers[first[d] : first[d + 1] - size + 1])
    return [np.zeros(0, dtype=np.int64) if x is None else x for x in sets]


def _linked(x: np.ndarray, y: np.ndarray, threshold: Fraction) -> bool:
    need = _need(len(x), len(y), threshold)
    most = len(x) + len(y) - 2 * need
    if suffix_bound(x, y, most) > most:
        return False
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum()) >= need


def _verify(k: int, threshold: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch["body_a"].to_pylist(), batch["body_b"].to_pylist()
            linked, start = [], 0
            while start < len(left):
                index: dict[bytes, int] = {}
                size, stop = 0, start
                while stop < len(left) and (size < VERIFY_BYTES or stop == start):
                    for body in (left[stop], right[stop]):
                        if body not in index:
                            index[body] = len(index)
                            size += 3 * len(body)
                    stop += 1
                sets = _sets_of(list(index), k)
                linked += [_linked(sets[index[a]], sets[index[b]], threshold) for a, b in zip(left[start:stop], right[start:stop])]
                start = stop
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(linked, type=pa.bool_())], ["a", "b", "linked"])

    return run


def _may_link(threshold: Fraction, x: str, y: str):
    """Length, index-prefix and positional filters for two postings of one token.

    The smaller set needs the token within its first n - need(n, n) + 1 places only. Tokens
    of frequency 1 (all places before the first posting) can't be shared: at most met
    earlier tokens are, and at most shared ones altogether.
    """
    p, q = threshold.numerator, threshold.denominator
    col = lambda s, c: F.col(f"{s}.{c}").cast("bigint")
    nx, ny = col(x, "n"), col(y, "n")
    floor = lambda a, b: F.floor(a.cast("decimal(20,0)") / F.lit(b)).cast("bigint")
    need = floor(p * (nx + ny) + (p + q - 1), p + q)
    alone = lambda n: n - floor(p * n * 2 + (p + q - 1), p + q) + 1
    smaller = (nx < ny) | ((nx == ny) & (F.col(f"{x}.digest") < F.col(f"{y}.digest")))
    first = F.when(smaller, col(x, "pos") < alone(nx)).otherwise(col(y, "pos") < alone(ny))
    most = F.least(F.least(col(x, "met"), col(y, "met")) + 1 + F.least(nx - col(x, "pos") - 1, ny - col(y, "pos") - 1), col(x, "shared"), col(y, "shared"))
    return (F.least(nx, ny) * q >= F.greatest(nx, ny) * p) & first & (most >= need)


def _unit_pairs(rows: dict[str, np.ndarray], threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one unit that differ in their roots and pass all filters of _may_link() and the bitmap filter."""
    own, same = rows["own"], rows["i"][0] == rows["j"][0]
    left = np.flatnonzero(own == rows["i"][0])
    right = left if same else np.flatnonzero(own == rows["j"][0])
    p, q = threshold.numerator, threshold.denominator
    get = lambda c: (rows[c][left][:, None], rows[c][right][None, :])
    (nx, ny), (px, py), (mx, my), (sx, sy), (rx, ry) = get("n"), get("pos"), get("met"), get("shared"), get("root")
    need = _need(nx, ny, threshold)
    alone = lambda n: n - (2 * p * n + p + q - 1) // (p + q) + 1
    dx, dy = get("digest")
    smaller = (nx < ny) | ((nx == ny) & (dx < dy))
    most = np.minimum(np.minimum(mx, my) + 1 + np.minimum(nx - px - 1, ny - py - 1), np.minimum(sx, sy))
    ok = (rx != ry) & (np.minimum(nx, ny) * q >= np.maximum(nx, ny) * p) & (most >= need) & np.where(smaller, px < alone(nx), py < alone(ny))
    vx, vy = get("prev")
    ok &= (vx != vy) | (vx == 0)  # else the token before, which both post too, has the pair
    if same:
        ok &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    a, b = np.nonzero(ok)
    limit = (nx + ny - 2 * need)[a, b]
    a, b = left[a], right[b]
    keep = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), 1 << 15):
        part = slice(at, at + (1 << 15))
        keep[part] = np.bitwise_count(rows["bitmap"][a[part]] ^ rows["bitmap"][b[part]]).sum(axis=1) <= limit[part]
    return a[keep], b[keep]


def _compare_units(threshold: Fraction):
    """Over rows sorted by unit: the pairs of each unit that need a test."""

    def arrays(table: pa.Table) -> dict[str, np.ndarray]:
        out = {c: table[c].to_numpy() for c in ("token", "i", "j", "own", "n", "shared", "pos", "met", "prev")}
        names: dict[bytes, int] = {}
        out["root"] = np.array([names.setdefault(x, len(names)) for x in table["root"].to_pylist()], dtype=np.int64)
        out["names"] = table["digest"].to_pylist()
        rank = {d: i for i, d in enumerate(sorted(set(out["names"])))}
        out["digest"] = np.array([rank[d] for d in out["names"]], dtype=np.int64)
        out["bitmap"] = np.frombuffer(b"".join(table["bitmap"].to_pylist()), dtype=np.uint64).reshape(-1, MAP_BITS // 64)
        return out | {c: out[c].astype(np.int64) for c in ("n", "shared", "pos", "met")}

    def pairs(table: pa.Table) -> pa.RecordBatch:
        x = arrays(table)
        new = np.r_[True, (x["token"][1:] != x["token"][:-1]) | (x["i"][1:] != x["i"][:-1]) | (x["j"][1:] != x["j"][:-1])]
        cuts = np.r_[np.flatnonzero(new), len(new)]
        found = set()
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            if b - a > 1:
                l, r = _unit_pairs({c: v[a:b] for c, v in x.items() if c != "names"}, threshold)
                found.update((min(u, v), max(u, v)) for u, v in zip((x["names"][a + i] for i in l.tolist()), (x["names"][a + i] for i in r.tolist())))
        return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], type=pa.binary()), pa.array([v for _, v in found], type=pa.binary())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            last = [table[c][-1].as_py() for c in ("token", "i", "j")]
            at = table.num_rows  # the last unit may go on in the next batch
            unit = np.logical_and.reduce([table[c].to_numpy() == v for c, v in zip(("token", "i", "j"), last)])
            at = int(np.flatnonzero(~unit)[-1]) + 1 if not unit.all() else 0
            if at:
                yield pairs(table.slice(0, at))
            rest = table.slice(at)
        if rest is not None and rest.num_rows:
            yield pairs(rest)

    return run


def jaccard_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: float = 0.8, rounds: int = 2) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs, by Jaccard links of k-word shingles.

    Two rows link where |x & y| >= threshold * |x | y|; component_id is the smallest id
    that links lead to. Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased.

    1. Document frequencies of all shingles are summed in hash-range shards and sent back.
       They set the order of the tokens, rarest first. A frequency of 1 rules a token out;
       shingles that share a key only raise each other's frequency, which loses no pair.
    2. Rows of equal sets are one class (128 bits: digests of the sorted set under two
       independent hashes of words).
    3. Each class posts its prefix tokens. Within a token, classes are first compared with
       one class only, and then again under another order; pairs within a group that has
       formed need no test. All other pairs are then compared in units of UNIT_ROWS by as
       many postings, inside which they are arrays and not rows: lengths, index prefixes,
       positions and a parity bitmap that bounds the difference of the sets.
    4. A pair that passes is verified once, with both whole texts, after a suffix filter:
       words and shingles count as equal only if their bytes are.

    Null or empty texts have no shingle, link with nothing and are their own component;
    texts of any length are read whole; an empty table gives no rows.
    Rows of one id are separate documents, but equal ids make one node of the result only
    where their texts link. A null id never is a component_id unless all ids of its group
    are null. Other columns are not read.
    """
    exact = Fraction(str(threshold))
    ws = Workspace(docs.sparkSession, "jaccard")
    blocks = B.write_blocks(docs, ws, "blocks", id_col, text_col)
    size = B.size_of(blocks)
    bits = B.key_bits(size.n_bytes, 8)
    replies, _ = B.exchange(blocks, _df_message(bits, k), _df_shard, bits=bits, size=size, ws=ws, name="frequencies")
    rows = ws.write(B.each_block(B.with_replies(blocks, replies), _prefixes(bits, k, exact), PREFIX_SCHEMA), "prefixes")
    ws.drop("blocks")
    ws.drop("frequencies")
    members = rows.filter("token is null").select("doc_id", "digest", "n")
    postings = ws.write(rows.filter("token is not null").groupBy("token", "digest").agg(*(F.first(c).alias(c) for c in ("n", "shared", "pos", "met", "prev"))), "postings")
    texts = ws.write(rows.filter("body is not null").groupBy("digest").agg(F.first("body").alias("body"), F.first("bitmap").alias("bitmap")), "texts")
    links, tested, roots = None, None, None
    for r in range(rounds + 1):
        own = postings if roots is None else postings.join(roots, postings.digest == roots.node, "left")
        own = own.select("token", "digest", "n", "shared", "pos", "met", "prev", (F.col("digest") if roots is None else F.coalesce("root", "digest")).alias("root"))
        by_root = own.groupBy("token", "root").agg(F.count("*").alias("m"))
        open_tokens = by_root.groupBy("token").agg(F.sum("m").alias("all"), F.sum(F.col("m").cast("double") * F.col("m")).alias("within")).filter("all * all > within")
        left = open_tokens.agg(F.count("*").alias("tokens"), F.sum(F.col("all").cast("double") * F.col("all") - F.col("within")).alias("pairs"), F.sum("all").alias("rows")).first()
        if not left.tokens:
            break
        if r < rounds and left.pairs > left.rows:
            still = ws.write(own.join(open_tokens.select("token"), "token", "left_semi"), f"open-{r}")
            order = F.xxhash64("digest", F.lit(r))
            hubs = still.groupBy("token").agg(F.min(F.struct(order.alias("o"), "digest", "n", "shared", "pos", "met", "root")).alias("h")).select("token", "h.*")
            met = still.alias("x").join(hubs.alias("y"), "token").filter(F.col("x.root") != F.col("y.root")).filter(_may_link(exact, "x", "y"))
            met = met.select(F.least("x.digest", "y.digest").alias("a"), F.greatest("x.digest", "y.digest").alias("b"))
            last = False
        else:
            units = F.ceil(F.col("all") / UNIT_ROWS).cast("int")
            placed = own.join(open_tokens.select("token", units.alias("units")), "token").join(texts.select("digest", "bitmap"), "digest")
            placed = placed.withColumn("own", F.pmod(F.xxhash64("digest"), F.col("units")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("units") - 1)))
            placed = placed.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).select(*UNIT_COLUMNS)
            met = placed.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(lean(_compare_units(exact)), "a binary, b binary")
            last = True
        pairs = met.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        with_a = pairs.join(texts.select(F.col("digest").alias("a"), F.col("body").alias("body_a")), "a")
        with_b = with_a.join(texts.select(F.col("digest").alias("b"), F.col("body").alias("body_b")), "b")
        told = ws.write(with_b.select("a", "b", "body_a", "body_b").mapInArrow(lean(_verify(k, exact)), "a binary, b binary, linked boolean"), f"tested-{r}")
        tested = told.select("a", "b") if tested is None else tested.unionByName(told.select("a", "b"))
        found = told.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        if found.isEmpty():
            if last:
                break
            continue
        links = found if roots is None else found.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
        roots = components(links, ws, f"components-{r}")
        if last:
            break
    return _label(members, roots)


def _label(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    classes = members.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("least"))
    if roots is not None:
        named = classes.join(roots, classes.digest == roots.node, "left").select("digest", F.coalesce("root", "digest").alias("root"), "least")
        whole = named.groupBy("root").agg(F.min("least").alias("component_id"))
        classes = named.join(whole, "root").select("digest", "component_id")
    else:
        classes = classes.select("digest", F.col("least").alias("component_id"))
    return members.join(classes, "digest", "left").select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))

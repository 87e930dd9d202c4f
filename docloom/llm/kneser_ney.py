"""Interpolated modified Kneser-Ney language model over hash-range shards of sorted arrays."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import arrays as A
from docloom.llm import blocks as B
from docloom.llm.workspace import Workspace

#: Hashes of the marks before and after a text; words have at least one byte, so that no word has them.
START, END = A.U(0x53A7B1C2D3E4F501), A.U(0x9C8B7A6958473625)
RESULT_SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
#: Vectors that go with the keys of a round: the count (raw or continuation), and for contexts how many followers have the
#: counts 1, 2, 3 and more, and the sum of what these last have above 3 (mostly 0: the followers' counts follow from all four).
WIDTH = 5


@dataclass
class Tokens:
    """Word hashes of all documents of a block; each is followed by END and preceded by order - 1 times START."""

    hashes: np.ndarray
    doc: np.ndarray
    real: np.ndarray  # not START


def tokens_of(block: B.Block, order: int) -> Tokens:
    buf, starts, ends, first = block.words(A.SPACES, lower=True)
    words, pad = A.hash_spans(buf, starts, ends), order - 1
    n = np.diff(first)
    size = n + pad + 1
    out = np.full(int(size.sum()), START, dtype=A.U)
    end = np.cumsum(size)
    doc = np.repeat(np.arange(len(n)), size)
    real = np.ones(len(out), dtype=bool)
    for p in range(pad):
        real[end - size + p] = False
    out[end - 1] = END
    put = real.copy()
    put[end - 1] = False
    out[put] = words
    return Tokens(out, doc, real)


@dataclass
class Round:
    """The distinct n-grams of a block, and for each real token the place of the n-gram that
    ends at it and of that before it (its context of n words)."""

    keys: np.ndarray
    gram: np.ndarray
    context: np.ndarray

    def first_token(self) -> np.ndarray:
        """A token that ends each n-gram (0 for those that are contexts only)."""
        out = np.zeros(len(self.keys), dtype=np.int64)
        out[self.gram] = np.arange(len(self.gram))
        return out


#: Bits that keys of two words and more have beyond the count of the corpus's bytes.
SPARE_BITS = 26


def width_of(n: int, bits: int) -> int:
    """Bits of a key: words have whole hashes, so that n_known and the vocabulary are counts of words."""
    return 64 if n == 1 else bits


def round_of(t: Tokens, n: int, order: int, bits: int) -> Round:
    """Below the highest order, n-grams that end at the last START are contexts too."""
    ends = t.real.copy()
    if n < order:
        ends[:-1] |= t.real[1:]
    at = np.flatnonzero(ends)
    keys, _, place = A.distinct(A.grams(t.hashes, n, salt=n)[at - n + 1] >> A.U(64 - width_of(n, bits)))
    where = np.zeros(len(t.hashes), dtype=np.int64)
    where[at] = place
    real = np.flatnonzero(t.real)
    return Round(keys, where[real], where[real - 1] if n < order else where[:0])


def _serve(shard: int, blocks: list, keys: list, columns: list) -> tuple:
    """Merge the blocks' arrays into the shard's sorted arrays and answer each block.

    A reply gives, in the order of the block's keys, what all other blocks add to its own
    vectors (mostly 0, as most n-grams stand in one block) and whether this block is the
    first to have the key (its owner). The shard keeps its sorted keys and their sums;
    stats: how many keys have the count 1, 2, 3, 4, how many have any, the sum of counts,
    and the same two of the last column.
    """
    width = max(len(x) for x in columns)
    table, owner, place = A.distinct(np.concatenate(keys))
    told = [np.concatenate([x[c] for x in columns]) for c in range(width)]
    sums = [np.zeros(len(table), dtype=A.U) for _ in told]
    for total, own in zip(sums, told):
        at = np.flatnonzero(own)
        np.add.at(total, place[at], own[at])
    first = np.zeros(len(place), dtype=bool)
    first[owner] = True
    others = [total[place] - own for total, own in zip(sums, told)]
    ends = np.cumsum([len(k) for k in keys]).tolist()
    replies = [[*(x[a:b] for x in others), first[a:b]] for a, b in zip([0, *ends[:-1]], ends)]
    counts, raw = sums[0], sums[-1]
    stats = [*(int((counts == c).sum()) for c in (1, 2, 3, 4)), int((counts > 0).sum()), int(counts.sum()), int((raw > 0).sum()), int(raw.sum())]
    return blocks, replies, (A.pack_sorted(table), A.pack_columns(sums), stats)


@dataclass
class Discounts:
    """Of one order: D1, D2, D3+."""

    values: tuple[float, float, float]

    def of(self, counts: np.ndarray) -> np.ndarray:
        d1, d2, d3 = self.values
        return np.where(counts <= 0, 0.0, np.where(counts == 1, d1, np.where(counts == 2, d2, d3)))


def discounts(n1: int, n2: int, n3: int, n4: int) -> Discounts:
    """Chen and Goodman's estimates; counts too few to tell give 0.5, 1 and 1.5."""
    if not (n1 and n2 and n3 and n4):
        return Discounts((0.5, 1.0, 1.5))
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return Discounts(tuple(float(np.clip(d, 0.01, i + 0.99)) for i, d in enumerate(raw)))


def _held(ids: np.ndarray, folds: int, fold: int) -> np.ndarray:
    """Which ids are held out: all of them for no folds."""
    if not folds:
        return np.ones(len(ids), dtype=bool)
    return np.array([i != B.NO_ID and zlib.crc32(str(i).encode()) % folds == fold for i in ids.tolist()], dtype=bool)


def _orders(block: B.Block, replies: list, order: int, bits: int, folds: int, fold: int) -> Iterator[tuple[Tokens, Round, list[np.ndarray], list[np.ndarray]]]:
    """From the highest order down, as far as there are replies and one further: tokens, n-grams, the block's own
    vectors, and the sums over all blocks (empty without a reply).

    The vectors are raw counts for the highest order (and for n = 1 in one more column),
    continuation counts below, and the followers that the block owns for contexts of n words.
    """
    t = tokens_of(block, order)
    train = ~_held(block.ids, folds, fold)[t.doc[t.real]]
    above: Round | None = None
    counts = owned = np.zeros(0, dtype=np.int64)
    for i, n in enumerate(range(order, 0, -1)):
        now = round_of(t, n, order, bits)
        count_of = lambda places: np.bincount(places, minlength=len(now.keys))  # noqa: B023, E731
        if above is None:
            own = [count_of(now.gram[train])]
        else:
            # each owned (n + 1)-gram continues its last n words and follows its first n
            mine = owned.astype(bool) & (counts > 0)
            token, c = above.first_token()[mine], counts[mine]
            before = now.context[token]
            own = [count_of(now.gram[token]), count_of(before[c == 1]), count_of(before[c == 2]), count_of(before[c >= 3])]
            own.append(np.rint(np.bincount(before, np.maximum(c - 3, 0), len(now.keys))).astype(np.int64))
        if n == 1 and order > 1:
            own.append(count_of(now.gram[train]))
        if i >= len(replies):
            yield t, now, own, []
            return
        others = [c.astype(np.int64) for c in replies[i]] or [np.zeros(len(now.keys), dtype=np.int64)] * (len(own) + 1)
        sums = [x + y for x, y in zip(own, others)]
        above, counts, owned = now, sums[0], others[-1]
        yield t, now, own, sums


def _message(order: int, bits: int, folds: int, fold: int):
    def make(block: B.Block, replies: list):
        *_, (_, now, own, _) = _orders(block, replies, order, bits, folds, fold)
        return now.keys, own

    return make


def _score(known: dict, folds: int, fold: int):
    order = known["order"]

    def make(block: B.Block, replies: list) -> pa.RecordBatch:
        rounds = list(_orders(block, replies, order, known["bits"], folds, fold))
        t = rounds[0][0]
        doc = t.doc[t.real]
        p = np.full(len(doc), 1.0 / (known["vocabulary"] + 1))
        raw = below = low = None
        for n in range(1, order + 1):
            _, now, _, got = rounds[order - n]
            counts = got[0][now.gram]
            d = known["discounts"][n].values
            if n == 1:
                raw = got[-1][now.gram]
                total, n1, n2, n3 = known["unigrams"]
                seen = np.full(len(doc), total > 0)
                safe, spare = max(total, 1), (d[0] * n1 + d[1] * n2 + d[2] * n3) / max(total, 1)
            else:
                total = low[1] + 2 * low[2] + 3 * low[3] + low[4]
                shares = (d[0] * low[1] + d[1] * low[2] + d[2] * low[3]) / np.maximum(total, 1)
                seen, safe, spare = (total > 0)[below.context], np.maximum(total, 1)[below.context], shares[below.context]
            p = np.where(seen, np.maximum(counts - known["discounts"][n].of(counts), 0) / safe + spare * p, p)
            below, low = now, got
        size = len(block.ids)
        by_doc = lambda x: np.bincount(doc, x, size)
        base = np.log10((raw + 1.0) / (known["tokens"] + (known["vocabulary"] + 1)))
        return pa.RecordBatch.from_arrays(
            [
                block.id_array(),
                pa.array(_held(block.ids, folds, fold)),
                pa.array(np.bincount(doc, minlength=size).astype(np.int64)),
                pa.array(by_doc((raw > 0).astype(float)).astype(np.int64)),
                pa.array(np.full(size, known["tokens"], dtype=np.int64)),
                pa.array(by_doc(base)),
                pa.array(by_doc(np.log10(np.maximum(p, 1e-300)))),
            ],
            [x.split()[0] for x in RESULT_SCHEMA.split(", ")],
        )

    return make


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = 3, folds: int = 7, held_fold: int = 2, model_path: str | None = None) -> DataFrame:
    """Log10 probabilities of all rows' texts under a model of the rows that aren't held out.

    A row is held out if crc32 of its id as text leaves held_fold on division by folds.
    Tokens are words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, then one end. Columns:
    doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens,
    base_score (add-one unigrams), score (the model).

    From the highest order down, each block of documents sends the shards of the key range
    its distinct n-grams with their counts as compressed sorted arrays; the shard merges
    them into sorted arrays and answers. A key belongs to the first block that has it,
    which tells the next lower order that one more n-gram continues its last words and
    follows its first. Sums of counts of counts give each order's discounts. The shards'
    sorted arrays are the model: they are stored, one row a shard, and with model_path they
    stay there for score_texts(); the documents themselves are scored by the answers that
    their blocks got while counting. Keys of words are whole 64-bit hashes; those of longer
    n-grams have SPARE_BITS more than the count of the corpus's bytes (56 for 1 GB, 64 from
    some 250 GB on): the score, and nothing else, takes an unseen n-gram for another with
    chance below 2**-26.

    Null texts count as empty: the end is their only token. Texts of any length are read
    whole. Null ids are never held out; repeated rows count and are scored each; an empty
    table gives no rows. Without training tokens the unseen word's share is the whole
    distribution. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "kneser-ney")
    models = Workspace(spark, "", model_path) if model_path else ws
    blocks = B.write_blocks(docs, ws, "blocks", id_col, text_col)
    size = B.size_of(blocks)
    bits = B.key_bits(size.n_bytes, SPARE_BITS)
    known: dict = {"order": order, "bits": bits, "discounts": {}}
    asked = blocks
    for n in range(order, 0, -1):
        replies, model = B.exchange(asked, _message(order, bits, folds, held_fold), _serve, bits=width_of(n, bits), size=size, ws=ws, name=f"order_{n}", keep=models)
        n1, n2, n3, n4, kinds, total, words, tokens = ((x or 0) for x in model.select(*(F.sum(F.col("stats")[i]).alias(f"n{i}") for i in range(8))).first())
        known["discounts"][n] = discounts(n1, n2, n3, n4)
        if n == 1:
            known |= {"unigrams": (total, n1, n2, max(0, kinds - n1 - n2)), "vocabulary": words, "tokens": tokens}
        asked = B.with_replies(asked, replies)
    if model_path:
        told = known | {"discounts": {n: d.values for n, d in known["discounts"].items()}}
        models.write(spark.createDataFrame([(json.dumps(told),)], "known string"), "known")
    return B.each_block(asked, _score(known, folds, held_fold), RESULT_SCHEMA)


def _lookup(shard: int, blocks: list, keys: list, columns: list) -> tuple:
    """Answers of one shard of a stored model: its sorted arrays, searched for the keys of each block."""
    own = [i for i, b in enumerate(blocks) if b == B.EXTRA]
    width = len(columns[own[0]]) if own else WIDTH
    table = np.concatenate([np.zeros(0, dtype=A.U), *(keys[i] for i in own)])
    sums = [np.concatenate([np.zeros(1, dtype=A.U), *(columns[i][c] for i in own)]) for c in range(width)]  # place 0: not found
    order = np.argsort(table, kind="stable")
    ask = [i for i, b in enumerate(blocks) if b != B.EXTRA]
    replies = []
    for i in ask:
        at = np.minimum(np.searchsorted(table, keys[i], sorter=order), max(0, len(table) - 1))
        place = np.where(table[order[at]] == keys[i], order[at] + 1, 0) if len(table) else np.zeros(len(keys[i]), dtype=np.int64)
        replies.append([*(c[place] for c in sums), np.zeros(len(place), dtype=A.U)])
    return [blocks[i] for i in ask], replies, None


def score_texts(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """score_documents() for other texts under a stored model: none of them is learnt from, and all are held out.

    Blocks ask the shards for their distinct n-grams; each task of a shard opens its part of
    the stored sorted arrays and searches them. Nothing of the model goes to the driver but
    its discounts and totals.
    """
    spark = docs.sparkSession
    ws, models = Workspace(spark, "kneser-ney-score"), Workspace(spark, "", model_path)
    known = json.loads(spark.read.parquet(models.path("known")).first().known)
    known["discounts"] = {int(n): Discounts(tuple(d)) for n, d in known["discounts"].items()}
    order, bits = known["order"], known["bits"]
    blocks = B.write_blocks(docs, ws, "blocks", id_col, text_col)
    size, everything = B.size_of(blocks), blocks
    for n in range(order, 0, -1):
        ask = lambda block, _, n=n: (round_of(tokens_of(block, order), n, order, bits).keys, [])
        stored = B.dealt(spark.read.parquet(models.path(models.half(f"order_{n}-served", False))), width_of(n, bits), size)
        replies, _ = B.exchange(blocks, ask, _lookup, bits=width_of(n, bits), size=size, ws=ws, name=f"order_{n}", more=stored)
        everything = B.with_replies(everything, replies)
    return B.each_block(everything, _score(known, 0, 0), RESULT_SCHEMA)

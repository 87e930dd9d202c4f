"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom._ship import ensure_importable
from docloom.llm import arrays as A
from docloom.llm import blocks as B
from docloom.llm.memory import lean
from docloom.llm.workspace import Workspace

#: Insults, by the voter that looks for them. Fixed starting words; further ones are mined from labelled rows.
LEXICON = {
    "contempt": "worthless pathetic disgusting useless filthy despicable revolting",
    "intelligence": "idiot idiots moron morons stupid imbecile dumb dumbass brainless cretin",
    "person": "scum loser losers clown clowns trash garbage vermin parasite freak pig",
    "profanity": "shit fuck fucking bitch bastard asshole crap damn whore slut",
    "german": "idiot dumm dummkopf arschloch abschaum widerlich wertlos schwachkopf",
    "french": "imbécile connard salaud ordure minable débile crétin abruti",
    "spanish": "estúpido imbécil basura escoria patético asqueroso inútil cabrón",
}
MINED_GROUPS = 4
HASH_BITS = 16
VOTERS = [*LEXICON, *(f"words{i}" for i in range(MINED_GROUPS)), *(f"stems{i}" for i in range(MINED_GROUPS)), "repeated", "masked", "shouting", "threat"]
#: Rows of labelled documents that the classifier is trained on; the lexicon is mined from all.
MOST_ROWS = 6_000
STEM = 5
SAMPLE_SCHEMA = "doc_id bigint, votes binary, slots binary, times binary, label int"


@dataclass
class Lexicon:
    """Hashes of the words (ascending) that each voter knows, and of the stems."""

    word_keys: np.ndarray
    word_voter: np.ndarray
    stem_keys: np.ndarray
    stem_voter: np.ndarray


def _hash_words(words: list[str]) -> np.ndarray:
    raw = [w.encode("utf-8") for w in words]
    ends = np.cumsum([len(w) for w in raw]).astype(np.int64)
    return A.hash_spans(np.frombuffer(b"".join(raw), dtype=np.uint8), np.r_[0, ends[:-1]], ends) if raw else np.zeros(0, dtype=A.U)


def _sorted(keys: np.ndarray, voter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys, return_index=True)
    return keys, voter[at]


def base_lexicon(words: dict[int, int] | None = None, stems: dict[int, int] | None = None) -> Lexicon:
    """The fixed words, and mined hashes with their group."""
    keys = [_hash_words(x.split()) for x in LEXICON.values()]
    voter = [np.full(len(k), i) for i, k in enumerate(keys)]
    mined = lambda d, first: (np.array(list(d), dtype=A.U), np.array([first + g for g in d.values()], dtype=np.int64)) if d else (np.zeros(0, dtype=A.U), np.zeros(0, dtype=np.int64))
    w, wv = mined(words, len(LEXICON))
    s, sv = mined(stems, len(LEXICON) + MINED_GROUPS)
    return Lexicon(*_sorted(np.concatenate([*keys, w]), np.concatenate([*voter, wv])), *_sorted(s, sv))


@dataclass
class Features:
    """counts: hits of each voter in each document; words and stems: distinct hashes, with the bounds of the documents."""

    counts: np.ndarray
    n_words: np.ndarray
    words: np.ndarray
    stems: np.ndarray
    first: np.ndarray


def _lookup(hashes: np.ndarray, keys: np.ndarray, voter: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, voter[at], -1)


def read(buf: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> Features:
    """Words are runs of letters, digits and bytes above ASCII with A-Z lower-cased."""
    low = A.LOWER[buf]
    starts, ends, first = A.word_spans(low, offsets, A.PUNCT)
    words = A.hash_spans(low, starts, ends)
    stems = A.hash_spans(low, starts, np.minimum(ends, starts + STEM))
    stems[ends - starts < STEM] = 0
    docs = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    n, v = len(offsets) - 1, len(VOTERS)
    counts = np.zeros((n, v), dtype=np.int64)
    for found in (_lookup(words, lexicon.word_keys, lexicon.word_voter), _lookup(stems, lexicon.stem_keys, lexicon.stem_voter)):
        hit = np.flatnonzero(found >= 0)
        np.add.at(counts, (docs[hit], found[hit]), 1)
    insults = counts[:, : v - 4].sum(axis=1)
    counts[:, v - 4] = np.maximum(insults - 1, 0)
    star = (low[1:-1] == 42) & _letter(low[:-2]) & (_letter(low[2:]) | (low[2:] == 42)) if len(low) > 2 else np.zeros(0, dtype=bool)
    at = np.searchsorted(offsets, np.flatnonzero(star) + 1, side="right") - 1
    np.add.at(counts, (at, np.full(len(at), v - 3)), 1)
    upper = np.r_[0, np.cumsum((buf >= 65) & (buf <= 90))]
    small = np.r_[0, np.cumsum((buf >= 97) & (buf <= 122))]
    counts[:, v - 2] = (upper[offsets[1:]] - upper[offsets[:-1]]) > 2 * (small[offsets[1:]] - small[offsets[:-1]])
    marks = np.r_[0, np.cumsum(buf == 33)]
    counts[:, v - 1] = (marks[offsets[1:]] - marks[offsets[:-1]] >= 3) & (insults > 0)
    return Features(counts, np.diff(first), words, stems, first)


def _letter(b: np.ndarray) -> np.ndarray:
    return (b >= 97) & (b <= 122) | (b >= 128)


def votes_of(counts: np.ndarray) -> np.ndarray:
    """1: toxic, 0: no sign of it. A voter that sees nothing votes 0; the model learns how little that says."""
    return (counts > 0).astype(np.int8)


def _distinct(f: Features, d: int, hashes: np.ndarray) -> np.ndarray:
    own = np.unique(hashes[f.first[d] : f.first[d + 1]])
    return own[own != 0]


def mine(counts: DataFrame, prior: float, purity: float = 0.9, chance: float = 0.01) -> dict[int, int]:
    """Hashes that toxic rows and hardly any other rows have: hash -> group by how sure they are.

    counts has a row (hash, toxic, n) of each distinct hash: toxic rows and all rows that have it.
    A hash needs so many toxic rows that, over all hashes tried, one would have as many by
    chance alone with no more than the given probability. Only hashes kept come to the driver.
    """
    prior = float(np.clip(prior, 0.001, 0.5))
    least = max(3, int(np.ceil(np.log(max(counts.count(), 2) / chance) / -np.log(prior))))
    kept = counts.filter((F.col("toxic") >= least) & (F.col("toxic") >= purity * F.col("n"))).toPandas()
    found, bad, n = (kept[c].to_numpy(dtype=np.int64) for c in ("hash", "toxic", "n"))
    share = (bad + 0.02) / (n + 1.0)
    groups = np.clip(((share - 0.5) * 2 * MINED_GROUPS).astype(int), 0, MINED_GROUPS - 1)
    return dict(zip(found.view(A.U).tolist(), groups.tolist()))


class LabelModel:
    """P(votes | class) as a tree of voter dependencies in each class, fitted by EM on vote patterns.

    A voter's accuracy is its table given its parent in the tree; the tree joins the pairs
    with most mutual information given the class (their correlation), where that exceeds a
    threshold. Rows are distinct vote vectors with how many documents cast them.
    """

    def __init__(self, prior: float, edge: float = 0.003, rounds: int = 25) -> None:
        self.prior, self.edge, self.rounds = prior, edge, rounds

    def fit(self, votes: np.ndarray, weight: np.ndarray, start: np.ndarray) -> LabelModel:
        """start: first guess of P(toxic) for each vote vector."""
        q = start
        for _ in range(self.rounds):
            self._maximise(votes, weight, q)
            new = self.posterior(votes)
            if np.abs(new - q).max() < 1e-6:
                break
            q = new
        return self

    def _maximise(self, votes: np.ndarray, weight: np.ndarray, q: np.ndarray) -> None:
        v = votes.shape[1]
        self.prior = float(np.clip((weight * q).sum() / weight.sum(), 0.005, 0.6))
        self.pair = np.zeros((2, v, v, 2, 2))
        for y, w in ((0, weight * (1 - q)), (1, weight * q)):
            total = w.sum() + 1.0
            for a in (0, 1):
                for b in (0, 1):
                    joint = ((votes == a) * w[:, None]).T @ (votes == b)
                    self.pair[y, :, :, a, b] = joint
            one = np.clip(np.einsum("iiaa->ia", self.pair[y]) + 0.5, 1e-9, None)
            one /= one.sum(axis=1, keepdims=True)
            base = one[:, None, :, None] * one[None, :, None, :]
            self.pair[y] = (self.pair[y] + base) / total if total > 1 else base
            self.pair[y] /= self.pair[y].sum(axis=(2, 3), keepdims=True)
        self.one = np.stack([np.einsum("iiaa->ia", p) for p in self.pair])
        self.one /= self.one.sum(axis=2, keepdims=True)
        p = np.array([1 - self.prior, self.prior])
        base = self.one[:, :, None, :, None] * self.one[:, None, :, None, :]
        info = (p[:, None, None] * (self.pair * np.log(np.maximum(self.pair, 1e-12) / np.maximum(base, 1e-12))).sum(axis=(3, 4))).sum(axis=0)
        np.fill_diagonal(info, 0)
        self.parent = np.full(v, -1)
        seen, best, via = {0}, info[0].copy(), np.zeros(v, dtype=int)
        while len(seen) < v:
            j = max((j for j in range(v) if j not in seen), key=lambda j: best[j])
            self.parent[j] = via[j] if best[j] > self.edge else -1
            seen.add(j)
            closer = info[j] > best
            best, via = np.where(closer, info[j], best), np.where(closer, j, via)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = []
        for y in (0, 1):
            out = np.log(self.prior if y else 1 - self.prior)
            for j, up in enumerate(self.parent):
                a = votes[:, j]
                if up < 0:
                    out = out + np.log(np.maximum(self.one[y, j, a], 1e-9))
                else:
                    joint = self.pair[y, j, up]
                    out = out + np.log(np.maximum(joint[a, votes[:, up]] / np.maximum(joint.sum(axis=0)[votes[:, up]], 1e-12), 1e-9))
            logs.append(out)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


@dataclass
class Classifier:
    """score = sigmoid(bias + voters . log1p(counts) + mean of the weights of hashed words and stems)."""

    lexicon: Lexicon
    bias: float
    voter_weights: np.ndarray
    hashed: np.ndarray

    def scores(self, f: Features) -> np.ndarray:
        z = self.bias + voter_inputs(f.counts) @ self.voter_weights
        n = np.maximum(f.n_words, 1)
        both = np.r_[0.0, np.cumsum(self.hashed[slot(f.words)] + self.hashed[slot(f.stems ^ A.U(1))])]
        z = z + (both[f.first[1:]] - both[f.first[:-1]]) / np.sqrt(n)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def slot(hashes: np.ndarray) -> np.ndarray:
    return (A.mix(hashes) >> A.U(64 - HASH_BITS)).astype(np.int64)


def voter_inputs(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts) + (counts > 0)


@dataclass
class Bag:
    """Slots of a document's distinct words and stems, and how many fall in each: at most 2 ** HASH_BITS of either."""

    slots: np.ndarray
    times: np.ndarray

    @property
    def size(self) -> int:
        return int(self.times.sum())


def bag_of(words: np.ndarray, stems: np.ndarray) -> Bag:
    slots, times = np.unique(np.concatenate([slot(words), slot(stems ^ A.U(1))]), return_counts=True)
    return Bag(slots.astype("<u4"), times.astype("<u4"))


def train(x: np.ndarray, bags: list[Bag], y: np.ndarray, epochs: int = 12, rate: float = 0.1, l2: float = 2e-4, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic regression on soft labels by AdaGrad over mini-batches; the hashed part is held small."""
    rng = np.random.default_rng(seed)
    bias, w, h = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), np.zeros(x.shape[1]), np.zeros(1 << HASH_BITS)
    gb, gw, gh = 1e-6, np.full(x.shape[1], 1e-6), np.full(1 << HASH_BITS, 1e-3)
    scale = np.array([1 / np.sqrt(max(1, b.size / 2)) for b in bags])
    epochs = max(epochs, min(400, 100_000 // max(1, len(y))))
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            at = np.concatenate([bags[i].slots for i in part]).astype(np.int64) if len(part) else np.zeros(0, dtype=np.int64)
            times = np.concatenate([bags[i].times for i in part]).astype(float) if len(part) else np.zeros(0)
            own = np.repeat(np.arange(len(part)), [len(bags[i].slots) for i in part])
            z = bias + x[part] @ w + np.bincount(own, h[at] * times, len(part)) * scale[part]
            err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]
            g = x[part].T @ err / len(part) + l2 * w
            gw += g * g
            w -= rate * 3 * g / np.sqrt(gw)
            gb += err.mean() ** 2
            bias -= rate * err.mean() / np.sqrt(gb)
            if len(at):
                touched, step = A.sum_by_key(at, times * (err * scale[part])[own] / len(part))
                step = step + 50 * l2 * h[touched]
                gh[touched] += step * step
                h[touched] -= 0.02 * rate * step / np.sqrt(gh[touched])
    return bias, w, h


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of at most a megabyte or so: start, stop, bytes and offsets."""
    buf, offsets = B.utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + (1 << 20), side="right")) - 1)
        stop = min(stop, batch.num_rows)
        yield start, stop, buf[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def _sample(lexicon: Lexicon):
    """Votes and bags of the classifier's rows, worked out by the executors with the whole lexicon."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, buf, offsets in _texts(batch, 1):
                f = read(buf, offsets, lexicon)
                part = batch.slice(start, stop - start)
                bags = [bag_of(_distinct(f, d, f.words), _distinct(f, d, f.stems)) for d in range(stop - start)]
                raw = lambda arrays: pa.array([x.tobytes() for x in arrays], type=pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), raw(f.counts.astype("<i8")), raw(b.slots for b in bags), raw(b.times for b in bags), part.column(2)], ["doc_id", "votes", "slots", "times", "label"])

    return run


#: Kinds of what _tally counts: words and stems by hash, and rows.
WORD, STEM_KIND, ROW = 0, 1, 2


def _tally(lexicon: Lexicon):
    """(kind, hash, toxic, n): rows with each distinct word and stem, and all rows, toxic ones and both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, buf, offsets in _texts(batch, 0):
                f = read(buf, offsets, lexicon)
                toxic = (batch.column(1).slice(start, stop - start).to_numpy(zero_copy_only=False) > 0).astype(np.int64)
                for kind, hashes in ((WORD, f.words), (STEM_KIND, f.stems)):
                    own = [_distinct(f, d, hashes) for d in range(stop - start)]
                    keys, label = np.concatenate(own), np.repeat(toxic, [len(x) for x in own])
                    if len(keys):
                        yield _counted(kind, *A.sum_by_key(keys, label, np.ones(len(keys), dtype=np.int64)))
                yield _counted(ROW, np.zeros(1, dtype=A.U), toxic.sum(keepdims=True), np.array([stop - start]))

    return run


def _counted(kind: int, keys: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [np.full(len(keys), kind, dtype=np.int32), keys.view(np.int64), toxic.astype(np.int64), n.astype(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["kind", "hash", "toxic", "n"])


def _patterns(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, offsets in _texts(batch, 0):
                rows, n = np.unique(votes_of(read(buf, offsets, lexicon).counts), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], type=pa.binary()), pa.array(n, type=pa.int64())], ["votes", "n"])

    return run


def _score(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = model.value
        for batch in batches:
            out = [classifier.scores(read(buf, offsets, classifier.lexicon)) for _, _, buf, offsets in _texts(batch, 1)]
            score = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score), pa.array((score >= threshold).astype(np.int32)), *batch.columns[3:]], ["doc_id", "held_out", "score", "predicted", *batch.schema.names[3:]])

    return run


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, label_id_col: str, most_rows: int = MOST_ROWS) -> Classifier:
    """Fit on docs (those that may be learnt from) and the labels of some of them.

    The lexicon is mined from the counts of all labelled documents. At most most_rows of
    them, the first by a hash of their ids, are the classifier's rows: their votes and
    bags, at most some 0.5 MB a row however long its text, come to the driver. The label
    model is fitted on the votes of all docs, as distinct vote vectors.
    """
    ensure_importable(docs.sparkSession)
    known = labels.select(F.col(label_id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    own = known.join(docs.select(F.col(id_col).cast("bigint").alias("doc_id")).distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    all_texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ws = Workspace(docs.sparkSession, "toxicity")
    # one plan at every size: labels grow with the documents, and few of them would be broadcast
    tally = all_texts.join(known.hint("merge"), "doc_id").select("text", "label").mapInArrow(lean(_tally(base_lexicon())), "kind int, hash bigint, toxic bigint, n bigint")
    tally = ws.write(tally.groupBy("kind", "hash").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")), "tally")
    all_rows = tally.filter(F.col("kind") == ROW).first()
    found = {c: mine(tally.filter(F.col("kind") == k), all_rows.toxic / all_rows.n) if all_rows and all_rows.toxic else {} for c, k in (("words", WORD), ("stems", STEM_KIND))}
    lexicon = base_lexicon(found["words"], found["stems"])
    texts = all_texts.join(own, "doc_id").select("doc_id", "text", "label")
    rows = texts.mapInArrow(lean(_sample(lexicon)), SAMPLE_SCHEMA).collect()
    ws.drop()
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.votes, r.slots))
    label = np.array([int(r.label > 0) for r in rows], dtype=np.int64)
    counts = np.array([np.frombuffer(r.votes, dtype="<i8") for r in rows], dtype=np.int64).reshape(-1, len(VOTERS))
    bags = [Bag(np.frombuffer(r.slots, dtype="<u4"), np.frombuffer(r.times, dtype="<u4")) for r in rows]
    patterns = docs.select(F.col(text_col).cast("string")).mapInArrow(lean(_patterns(lexicon)), "votes binary, n bigint").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    votes = np.array([np.frombuffer(r.votes, dtype=np.int8) for r in patterns], dtype=np.int64).reshape(-1, len(VOTERS))
    weight = np.array([r.n for r in patterns], dtype=float)
    order = np.lexsort(votes.T)
    votes, weight = votes[order], weight[order]
    prior = float(np.clip(label.mean() if len(label) else 0.1, 0.01, 0.5))
    model = LabelModel(prior)
    if len(votes):
        model.fit(votes, weight, np.clip(0.02 + 0.49 * votes[:, : len(VOTERS) - 3].sum(axis=1), 0.02, 0.98))
    soft = model.posterior(votes_of(counts).astype(np.int64)) if len(votes) and len(rows) else np.zeros(len(rows))
    bias, w, h = train(voter_inputs(counts), bags, soft) if len(rows) else (-3.0, np.zeros(len(VOTERS)), np.zeros(1 << HASH_BITS))
    return Classifier(lexicon, bias, w, h)


def score_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", label_id_col: str = "doc_id", folds: int = 3, held_fold: int = 1, threshold: float = 0.7, most_rows: int = MOST_ROWS, row_col: str | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs; 1 is toxic. row_col, a bigint, is kept where given.

    Rows whose crc32 of the id as text leaves held_fold on division by folds are held out:
    neither their labels nor their votes are used. Voters look for words of fixed and mined
    lexicons, for stems, and for patterns; a tree-structured generative model learns from
    their agreement how accurate and how correlated they are, and a linear classifier is
    trained on its posteriors. The score depends on the text alone.

    Null and empty texts get the score of a text without any sign; texts of any length are
    read whole. Null ids are never held out and never learnt from; a repeated id counts as
    toxic if any of its labels does. Without labels or rows the fixed prior scores all; an
    empty table gives no rows. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    ensure_importable(spark)
    held = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == held_fold, F.lit(False))
    model = spark.sparkContext.broadcast(fit(docs.filter(~held), labels, id_col=id_col, text_col=text_col, label_col=label_col, label_id_col=label_id_col, most_rows=most_rows))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held.alias("held_out"), *([row_col] if row_col else []))
    return rows.mapInArrow(lean(_score(model, threshold)), "doc_id bigint, held_out boolean, score double, predicted int" + (f", `{row_col}` bigint" if row_col else ""))

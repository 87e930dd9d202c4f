"""Secrets in texts: fixed patterns, and a character convolutional network over every other candidate.

A candidate is a run of the characters of keys and passwords, of MOST_SHORT characters at least and with a digit in it.
The network (numpy, forward and backward) sees the characters of the candidate and of LEFT and RIGHT characters around
it; a longer candidate is seen in as many windows as it needs, and its score is the highest. It is trained on labelled
findings: all different candidates of all documents, where the fixed patterns label them, and findings drawn by rule
(known key formats, and numbers, addresses, versions, paths and identifiers that are none). Findings are dealt to shards
by their digests, each with as many drawn ones; in each round every shard trains the network by itself for one epoch,
and the mean of the shards' weights goes into the next. Three of ten findings aren't trained on: by all of them scores
are calibrated (Platt), and each shape of candidate gets the highest threshold that still finds RECALL of its secrets.
Nothing but weights, sums and counts goes to the driver. Then every text is searched whole, in one pass without a
shuffle, and what patterns find is kept whatever the network says.

Defined cases: a null text is empty and has no span; null and repeated ids are rows of their own; equal texts get equal
spans; an empty table gives no rows. Positions count code points. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom._ship import ensure_importable
from docloom.llm.memory import lean
from docloom.llm.workspace import Workspace

#: Kind, pattern, the group whose length counts, and the least length.
BASE = (
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
LEARNED = "learned"
#: Windows of a shard of findings, and the findings drawn by rule beside them. Share of secrets that a threshold has to find.
SHARD_WINDOWS, MADE_FINDINGS, RECALL = 8192, 6_000, 0.98
ROUNDS = 10
MOST_SHORT, LEFT, BODY, RIGHT = 8, 24, 48, 12
WIDTH = LEFT + BODY + RIGHT
#: 0: beyond the text, 1: any other character, 2: white space, then printable ASCII.
_CODES = np.ones(0x110000, dtype=np.uint8)
_CODES[0x21:0x7F] = np.arange(3, 3 + 0x7F - 0x21)
_CODES[[9, 10, 11, 12, 13, 32]] = 2
SYMBOLS = 3 + 0x7F - 0x21
_CHARS = "A-Za-z0-9+/_.=-"
_DIGIT, _AHEAD, _BACK = re.compile("[0-9]"), re.compile(f"[{_CHARS}]*"), re.compile(f"[{_CHARS}]*$")
SHAPES = ("number", "hex", "mixed", "other")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of what the fixed patterns find, leftmost first and without overlaps of one kind."""
    out = []
    lower = text.lower()
    for k, (_, pattern, group, least) in enumerate(BASE):
        if k == 0 and not any(w in lower for w in _KEYWORDS) or k == 1 and "AKIA" not in text:
            continue
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of key characters with a digit, without dots and hyphens at their ends."""
    out, at = [], 0
    while (m := _DIGIT.search(text, at)) is not None:
        start = m.start()
        while start > at and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+/_.=-")):
            start -= 1
        at = end = _AHEAD.match(text, m.start()).end()
        while end > start and text[end - 1] in ".-":
            end -= 1
        while start < end and text[start] in ".-":
            start += 1
        if end - start >= MOST_SHORT:
            out.append((start, end))
    return out


def shape(value: str) -> int:
    if re.fullmatch(r"[0-9._/+=-]+", value):
        return 0
    if re.fullmatch(r"[0-9a-fA-F]+", value):
        return 1
    return 2 if re.search("[a-z]", value) and re.search("[A-Z]", value) else 3


def windows(text: str, start: int, end: int) -> list[tuple[np.ndarray, int]]:
    """Codes of WIDTH characters and the length of the body, for each BODY characters of a candidate."""
    out = []
    for at in range(start, end, BODY):
        body = min(BODY, end - at)
        low, high = max(0, at - LEFT), min(len(text), at + body + RIGHT)
        codes = np.zeros(WIDTH, dtype=np.uint8)
        own = _CODES[np.frombuffer(text[low:high].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        codes[LEFT - (at - low) : LEFT - (at - low) + len(own)] = own
        out.append((codes, body))
    return out


# --- the network ------------------------------------------------------------------------------------------------------

SPAN, SIZE, FILTERS, HIDDEN = 5, 8, 24, 16
PLACES = WIDTH - SPAN + 1


class Network:
    """Embedded characters and regions, one convolution, its maxima in the candidate and anywhere, a hidden layer."""

    def __init__(self, seed: int = 11) -> None:
        r = np.random.default_rng(seed)
        draw = lambda *s: (r.standard_normal(s) * (2 / s[0]) ** 0.5).astype(np.float32)
        self.w = {
            "symbols": (r.standard_normal((SYMBOLS, SIZE)) * 0.5).astype(np.float32), "regions": (r.standard_normal((3, SIZE)) * 0.5).astype(np.float32),
            "filters": draw(SPAN * SIZE, FILTERS), "filter_bias": np.zeros(FILTERS, np.float32),
            "hidden": draw(2 * FILTERS, HIDDEN), "hidden_bias": np.zeros(HIDDEN, np.float32), "out": draw(HIDDEN, 1), "out_bias": np.zeros(1, np.float32),
        }

    @staticmethod
    def regions(body: np.ndarray) -> np.ndarray:
        place = np.arange(WIDTH)[None, :]
        return (place >= LEFT).astype(np.int8) + (place >= LEFT + body[:, None])

    def forward(self, codes: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, tuple]:
        w, n = self.w, len(codes)
        region = self.regions(body)
        x = w["symbols"][codes] + w["regions"][region]
        cols = np.lib.stride_tricks.sliding_window_view(x, SPAN, axis=1).transpose(0, 1, 3, 2).reshape(n, PLACES, SPAN * SIZE)
        z = np.maximum(cols @ w["filters"] + w["filter_bias"], 0)
        inside = region[:, SPAN // 2 : SPAN // 2 + PLACES] == 1
        tops = [np.where(inside[:, :, None], z, -1).argmax(axis=1), z.argmax(axis=1)]
        pooled = np.concatenate([np.take_along_axis(z, t[:, None, :], axis=1)[:, 0] for t in tops], axis=1)
        h = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
        return (h @ w["out"] + w["out_bias"])[:, 0], (region, cols, tops, pooled, h)

    def scores(self, codes: np.ndarray, body: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(codes[i : i + 512], body[i : i + 512])[0] for i in range(0, len(codes), 512)] or [np.zeros(0)])

    def gradients(self, codes: np.ndarray, body: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean logistic loss."""
        w, n = self.w, len(codes)
        logits, (region, cols, tops, pooled, h) = self.forward(codes, body)
        d = ((1 / (1 + np.exp(-logits)) - labels) * weights / weights.sum()).astype(np.float32)[:, None]
        g = {"out": h.T @ d, "out_bias": d.sum(axis=0)}
        dh = d @ w["out"].T * (h > 0)
        g["hidden"], g["hidden_bias"] = pooled.T @ dh, dh.sum(axis=0)
        dp = dh @ w["hidden"].T * (pooled > 0)
        rows = np.arange(n)[:, None]
        g["filters"], g["filter_bias"] = np.zeros_like(w["filters"]), np.zeros_like(w["filter_bias"])
        dx = np.zeros((n, WIDTH, SIZE), dtype=np.float32)
        by_place = w["filters"].T.reshape(FILTERS, SPAN, SIZE)
        for t, part in zip(tops, (dp[:, :FILTERS], dp[:, FILTERS:]), strict=True):
            g["filters"] += np.einsum("nfc,nf->cf", cols[rows, t], part, optimize=True)
            g["filter_bias"] += part.sum(axis=0)
            at = t[:, :, None] + np.arange(SPAN)
            np.add.at(dx, (np.arange(n)[:, None, None], at), part[:, :, None, None] * by_place[None])
        g["symbols"], g["regions"] = np.zeros_like(w["symbols"]), np.zeros_like(w["regions"])
        np.add.at(g["symbols"], codes, dx)
        np.add.at(g["regions"], region, dx)
        return g

    def epoch(self, moments: tuple[dict, dict], at_round: int, rounds: int, codes: np.ndarray, body: np.ndarray, labels: np.ndarray, weights: np.ndarray, batch: int = 128, rate: float = 4e-3) -> None:
        """One of several epochs of Adam, over shuffled batches."""
        first, second = moments
        order = np.random.default_rng([5, at_round]).permutation(len(labels))
        n = -(-len(order) // batch)
        for i in range(n):
            own, step = order[i * batch : (i + 1) * batch], at_round * n + i + 1
            for k, g in self.gradients(codes[own], body[own], labels[own], weights[own]).items():
                first[k] = (0.9 * first[k] + 0.1 * g).astype(np.float32)
                second[k] = (0.99 * second[k] + 0.01 * g * g).astype(np.float32)
                self.w[k] -= (rate * (1 - 0.9 * step / (n * rounds)) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def moments(self) -> tuple[dict, dict]:
        return {k: np.zeros_like(v) for k, v in self.w.items()}, {k: np.zeros_like(v) for k, v in self.w.items()}


def trained_on(findings: Sequence[Finding]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, bodies, labels and weights of the windows; a finding's windows share its weight, and both classes weigh the same."""
    rows = [(c, n, f.secret, 1 / len(f.windows)) for f in findings for c, n in f.windows]
    labels, weights = np.array([float(r[2]) for r in rows]), np.array([r[3] for r in rows])
    share = (labels * weights).sum() / weights.sum()
    weights *= np.where(labels == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))
    return np.stack([r[0] for r in rows]), np.array([r[1] for r in rows]), labels, weights


Sums = Callable[[float, float], Sequence[float]]


def platt(sums: Sums) -> tuple[float, float]:
    """a, b of the calibrated probability 1 / (1 + exp(-(a x + b))), by damped Newton steps.

    sums(a, b) gives the loss, its two derivatives by a and b, and the three second ones (aa, ab, bb).
    """
    ab, now = np.array([1.0, 0.0]), sums(1.0, 0.0)
    for _ in range(50):
        step = np.linalg.solve(np.array([[now[3], now[4]], [now[4], now[5]]]) + 1e-6 * np.eye(2), np.array(now[1:3]))
        scale = 1.0
        while (new := sums(*(ab - scale * step).tolist()))[0] > now[0] and scale > 1e-4:
            scale /= 2
        ab, now = ab - scale * step, new
        if np.abs(scale * step).max() < 1e-6:
            break
    return round(float(ab[0]), 9), round(float(ab[1]), 9)


def smoothed(up: float, n: float) -> tuple[float, float]:
    """What stands for labels 1 and 0."""
    return (up + 1) / (up + 2), 1 / (n - up + 2)


def array_sums(logits: np.ndarray, labels: np.ndarray) -> Sums:
    high, low = smoothed(labels.sum(), len(labels))
    x, target = logits.astype(float), np.where(labels == 1, high, low)

    def sums(a: float, b: float) -> Sequence[float]:
        z = a * x + b
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        d, h = p - target, p * (1 - p)
        return [float(v.sum()) for v in (np.logaddexp(0, z) - target * z, d * x, d, h * x * x, h * x, h)]

    return sums


@dataclass(frozen=True)
class Finding:
    """A labelled candidate: its windows, its shape, a digest of all it is judged by."""

    windows: tuple[tuple[np.ndarray, int], ...]
    shape: int
    secret: bool
    digest: bytes


def finding(text: str, start: int, end: int, secret: bool) -> Finding:
    own = tuple(windows(text, start, end))
    return Finding(own, shape(text[start:end]), secret, hashlib.sha256(b"".join(c.tobytes() + bytes([n]) for c, n in own)).digest())


def calibrated(logits: np.ndarray, a: float, b: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a * np.asarray(logits, dtype=float) + b, -50, 50)))


def held_back(f: Finding) -> bool:
    return f.digest[0] % 10 < 3


def rank_of(n: int, recall: float) -> int:
    """Of n secrets in the order of their scores, the one whose score is the threshold."""
    return int((1 - recall) * n)


#: A shape with fewer secrets than this takes the threshold of all, and at least 0.5.
LEAST_SECRETS = 20


@dataclass
class Scanner:
    """A trained network with its calibration and a threshold a shape. quality: what the held-back findings say."""

    network: Network
    a: float
    b: float
    thresholds: list[float]
    quality: dict[str, float]

    def probabilities(self, found: Sequence[Sequence[tuple[np.ndarray, int]]]) -> np.ndarray:
        """Of candidates, each given by its windows: the highest of theirs."""
        if not found:
            return np.zeros(0)
        flat = [x for own in found for x in own]
        p = calibrated(self.network.scores(np.stack([c for c, _ in flat]), np.array([n for _, n in flat])), self.a, self.b)
        return np.maximum.reduceat(p, np.cumsum([0, *(len(own) for own in found[:-1])]))


def train(findings: Sequence[Finding], recall: float = RECALL) -> Scanner:
    """A scanner from findings at hand; trained() makes one from the findings of whole documents."""
    held = [f for f in findings if held_back(f)]
    rows = trained_on([f for f in findings if not held_back(f)])
    network = Network()
    moments = network.moments()
    for i in range(ROUNDS):
        network.epoch(moments, i, ROUNDS, *rows)
    logits = np.array([network.scores(np.stack([c for c, _ in f.windows]), np.array([n for _, n in f.windows])).max() for f in held])
    labels, shapes = np.array([float(f.secret) for f in held]), np.array([f.shape for f in held])
    a, b = platt(array_sums(logits, labels))
    p = calibrated(logits, a, b)

    def threshold(chosen: np.ndarray) -> float:
        own = np.sort(p[chosen & (labels == 1)])
        return float(own[rank_of(len(own), recall)])

    every = threshold(np.ones(len(held), dtype=bool))
    thresholds = [threshold(shapes == s) if (labels[shapes == s] == 1).sum() >= LEAST_SECRETS else max(every, 0.5) for s in range(len(SHAPES))]
    said = p >= np.array(thresholds)[shapes]
    return Scanner(network, a, b, thresholds, {"recall": float(said[labels == 1].mean()), "false_alarms": float(said[labels == 0].mean()), "held": float(len(held))})


# --- labelled findings ------------------------------------------------------------------------------------------------

_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def made_findings(n: int, seed: int = 1) -> list[Finding]:
    """Findings drawn by rule: secrets and others in equal parts, in code, settings or prose."""
    r = random.Random(seed)
    of = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    word = lambda: of("etaoinshrdlucmé", r.randint(2, 9))
    prose = lambda: " ".join(word() for _ in range(r.randint(0, 6)))
    digits, lower_hex = "0123456789", "0123456789abcdef"
    secrets = [
        lambda: "ghp_" + of(_ALNUM, 36), lambda: "sk-" + of(_ALNUM, r.choice([32, 48])), lambda: "sk_live_" + of(_ALNUM, 24), lambda: "glpat-" + of(_ALNUM, 20),
        lambda: f"xoxb-{of(digits, 11)}-{of(digits, 12)}-{of(_ALNUM, 24)}", lambda: "AIza" + of(_ALNUM + "-_", 35), lambda: "AKIA" + of(_ALNUM[:26] + digits, 16),
        lambda: "npm_" + of(_ALNUM, 36), lambda: f"eyJ{of(_ALNUM, 20)}.eyJ{of(_ALNUM, 40)}.{of(_ALNUM + '-_', 43)}", lambda: of(lower_hex, r.choice([24, 32, 40, 64])),
        lambda: of(lower_hex, r.choice([32, 40])).upper(), lambda: of(_ALNUM, r.randint(20, 64)), lambda: of(_ALNUM + "+/", r.randint(24, 88)) + "=" * r.randint(0, 2), lambda: of(_ALNUM, r.randint(8, 16)),
    ]
    #: The last kind is a secret only where a name says so.
    named = ["password", "passwd", "pwd", "secret", "token", "api_key", "apiKey", "auth", "access_key", "client_secret", "credential", "DB_PASSWORD", "private_key"]
    others = [
        lambda: of(digits, r.choice([8, 9, 10, 12, 13, 16])), lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), lambda: f"20{of(digits, 2)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}",
        lambda: f"{word()}{r.choice(['', word()])}{r.choice('._-')}{of(digits, 2)}", lambda: f"v{r.randint(0, 20)}.{r.randint(0, 30)}.{r.randint(0, 99)}-{word()}", lambda: f"/{word()}/{word()}{r.randint(2, 4)}.{r.randint(0, 14)}/{word()}_{word()}.py",
        lambda: f"{word()}_{word()}_{r.randint(0, 99)}", lambda: f"{word().title()}{word().title()}{r.randint(0, 99)}", lambda: f"{word()}.example.com/{word()}/{r.randint(1, 9999)}",
        lambda: f"+{r.randint(1, 99)}-{of(digits, 3)}-{of(digits, 4)}-{of(digits, 3)}", lambda: f"{r.randint(0, 23):02d}.{r.randint(0, 59):02d}.{of(digits, 3)}", lambda: f"{of(digits, 3)}-{of(digits, 10)}",
        lambda: f"{of(digits, 4)}-{of(digits, 4)}-{of(digits, 4)}-{of(digits, 4)}", lambda: f"{word()}-{word()}-{r.randint(1, 999)}.html", lambda: f"{word()}{r.randint(1, 9)}{word()}",
    ]
    out = []
    while len(out) < n:
        secret = len(out) % 2 == 0
        kind = r.randrange(len(secrets if secret else others))
        value = (secrets if secret else others)[kind]()
        quote = r.choice(["", "", '"', "'"])
        if secret and (kind == len(secrets) - 1 or r.random() < 0.5):
            before = f"{r.choice(named)}{r.choice([' = ', '=', ': ', ':', '  =  '])}{quote}"
        elif r.random() < 0.3:
            before = f"{word()}{r.choice([' = ', '=', ': ', ' '])}{quote}".replace("=", "= ") if not secret else r.choice(["Bearer ", "export X= ", f"{word()}: "])
        else:
            before = quote
        after = quote + r.choice([" ", "\n", ", ", "; ", ""])
        if not secret and kind in (3, 6, 14) and r.random() < 0.7:
            before, after = "", f"@{word()}{r.choice(['', str(r.randint(0, 9))])}.{r.choice(['example.com', 'example.org', word() + '.net'])} "
        text = f"{prose()} {before}{value}{after}{prose()}"
        at = text.index(value, len(text) - len(value) - len(after) - 70 if len(text) > len(value) + len(after) + 70 else 0)
        for start, end in candidates(text):
            if start < at + len(value) and end > at:
                out.append(finding(text, start, end, secret))
                break
    return out[:n]


def beside(base: list[tuple[int, int, int]], found: list[tuple[int, int]]) -> list[bool]:
    """Which candidates share no character with what the fixed patterns find; both are in the order of their starts."""
    out, at, reach = [], 0, 0
    for s, e in found:
        while at < len(base) and base[at][0] < e:
            reach = max(reach, base[at][2])
            at += 1
        out.append(reach <= s)
    return out


def labelled(text: str) -> Iterator[Finding]:
    """The candidates of a text; those that share characters with what the fixed patterns find are secrets."""
    found = candidates(text)
    for (s, e), free in zip(found, beside(base_spans(text), found), strict=True):
        yield finding(text, s, e, not free)


_FINDINGS = "digest binary, secret int, shape int, windows binary"
_SHARD = "shard bigint, sizes binary, secrets binary, shapes binary, held binary, windows binary"


def _finding_batch(part: list[Finding]) -> pa.RecordBatch:
    cols = [[f.digest for f in part], [int(f.secret) for f in part], [f.shape for f in part], [b"".join(c.tobytes() + bytes([n]) for c, n in f.windows) for f in part]]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.binary(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["digest", "secret", "shape", "windows"])


def all_findings(docs: DataFrame, text_col: str) -> DataFrame:
    """The different findings of all documents, with all their windows; one that any document labels a secret is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                for f in labelled(text.as_py() or ""):
                    part.append(f)
                    size += len(f.windows)
                    if size >= 2000:
                        yield _finding_batch(part)
                        part, size = [], 0
        if part:
            yield _finding_batch(part)

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), _FINDINGS)
    return found.groupBy("digest").agg(F.max("secret").alias("secret"), F.first("shape").alias("shape"), F.first("windows").alias("windows"))


def _opened(windows: bytes) -> tuple[tuple[np.ndarray, int], ...]:
    return tuple((x[:WIDTH], int(x[WIDTH])) for x in np.frombuffer(windows, dtype=np.uint8).reshape(-1, WIDTH + 1))


def sharded(found: DataFrame, ws: Workspace) -> DataFrame:
    """One row for about SHARD_WINDOWS windows: findings dealt by their digests, and others drawn by rule."""
    n_windows = found.agg(F.coalesce(F.sum(F.length("windows")), F.lit(0)).alias("n")).first().n // (WIDTH + 1)
    n = -(-n_windows // SHARD_WINDOWS) or 1

    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        rows = sorted((r for r in table.to_pylist() if r["digest"] is not None), key=lambda r: r["digest"])
        own = [Finding(_opened(r["windows"]), r["shape"], bool(r["secret"]), r["digest"]) for r in rows] + made_findings(MADE_FINDINGS, shard + 1)
        cols = [np.array([len(f.windows) for f in own], dtype=np.int32).tobytes(), *(bytes(int(x) for x in v) for v in ([f.secret for f in own], [f.shape for f in own], [held_back(f) for f in own]))]
        return pa.table([pa.array([shard], type=pa.int64()), *(pa.array([c], type=pa.binary()) for c in [*cols, b"".join(c.tobytes() + bytes([k]) for f in own for c, k in f.windows)])], names=[c.split()[0] for c in _SHARD.split(", ")])

    none = found.sparkSession.range(n).selectExpr("id AS shard", "CAST(null AS binary) AS digest", "0 AS secret", "0 AS shape", "CAST(null AS binary) AS windows")
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(n))).unionByName(none)
    return ws.write(dealt.repartition(min(n, 2000), "shard").groupBy("shard").applyInArrow(run, _SHARD), "shards")


def _shards(batches: Iterator[pa.RecordBatch], held: bool) -> Iterator[list[Finding]]:
    """Of each shard the findings held back, or the others."""
    for batch in batches:
        for r in batch.to_pylist():
            windows, at, out = _opened(r["windows"]), 0, []
            for size, secret, kind, back in zip(np.frombuffer(r["sizes"], dtype=np.int32).tolist(), r["secrets"], r["shapes"], r["held"], strict=True):
                if bool(back) == held:
                    out.append(Finding(windows[at : at + size], kind, bool(secret), b""))
                at += size
            yield out


#: Weights are summed as multiples of this, so that their sum doesn't depend on the order of the shards.
UNIT = 2.0**-40


def _flat(*parts: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for p in parts for k in sorted(p)])


def _parted(flat: np.ndarray, shapes: dict[str, np.ndarray]) -> list[dict[str, np.ndarray]]:
    out, at = [], 0
    while at < len(flat):
        out.append({})
        for k in sorted(shapes):
            out[-1][k] = flat[at : at + shapes[k].size].reshape(shapes[k].shape).astype(np.float32)
            at += shapes[k].size
    return out


def fitted(shards: DataFrame) -> Network:
    """Rounds of one epoch a shard; weights and moments of a round are the means of the shards'."""
    network = Network()
    moments = network.moments()
    for i in range(ROUNDS):
        start = _flat(network.w, *moments)

        def run(batches: Iterator[pa.RecordBatch], i: int = i, start: np.ndarray = start) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(start) + 1, dtype=np.int64)
            for own in _shards(batches, False):
                net = Network()
                net.w, *state = _parted(start, net.w)
                net.epoch(tuple(state), i, ROUNDS, *trained_on(own))
                total += np.append(np.rint(_flat(net.w, *state).astype(float) / UNIT).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays([pa.array([total], type=pa.list_(pa.int64()))], ["sums"])

        sums = shards.mapInArrow(lean(run), "sums array<bigint>").select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
        mean = np.array([r.x for r in sorted(sums.collect())], dtype=float)
        network.w, *moments = _parted(mean[:-1] * UNIT / mean[-1], network.w)
    return network


def held_scores(shards: DataFrame, network: Network) -> DataFrame:
    """(secret, shape, logit, place) of all findings held back; places are integers in the order of the logits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _shards(batches, True):
            if own:
                flat = [x for f in own for x in f.windows]
                logits = np.maximum.reduceat(network.scores(np.stack([c for c, _ in flat]), np.array([n for _, n in flat])), np.cumsum([0, *(len(f.windows) for f in own[:-1])])).astype(np.float32)
                raw = logits.view(np.int32).astype(np.int64)
                cols = [[int(f.secret) for f in own], [f.shape for f in own], logits.astype(float), np.where(raw < 0, -(raw & 0x7FFFFFFF) - 1, raw)]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.float64(), pa.int64()), strict=True)], ["secret", "shape", "logit", "place"])

    return shards.mapInArrow(lean(run), "secret int, shape int, logit double, place bigint")


def table_sums(held: DataFrame, up: int, n: int) -> Sums:
    """array_sums() of a table."""
    high, low = smoothed(up, n)
    x, target = F.col("logit"), F.when(F.col("secret") == 1, high).otherwise(low)

    def sums(a: float, b: float) -> Sequence[float]:
        z = a * x + b
        p = 1 / (1 + F.exp(-z))
        d, h = p - target, p * (1 - p)
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - target * z
        return list(held.agg(*(F.sum(v).alias(f"s{i}") for i, v in enumerate((loss, d * x, d, h * x * x, h * x, h)))).first())

    return sums


def ranked_logits(held: DataFrame, recall: float, up: bool) -> dict[int, tuple[int, float]]:
    """For each shape and for all (-1): how many secrets there are, and the logit that rank_of() picks of theirs.

    Counts of the places' upper bits say which of them has the rank, counts of the lower ones within it where: no task
    sorts or holds all secrets. up: whether higher logits are likelier secrets.
    """
    place = F.col("place") if up else -F.col("place")
    own = held.filter("secret = 1").select(F.explode(F.array("shape", F.lit(-1))).alias("kind"), "logit", F.shiftright(place, 16).alias("upper"), place.bitwiseAND(F.lit(0xFFFF)).alias("lower"))
    sizes = {r.kind: r.n for r in own.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    ranks = held.sparkSession.createDataFrame([(k, rank_of(n, recall)) for k, n in sizes.items()], "kind int, rank bigint")

    def picked(rows: DataFrame, by: str, ranks: DataFrame) -> DataFrame:
        counts = rows.groupBy("kind", by).agg(F.count("*").alias("n"), F.first("logit").alias("logit"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("kind").orderBy(by)))
        return upto.join(F.broadcast(ranks), "kind").filter("upto > rank AND upto - n <= rank").select("kind", by, "logit", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))

    upper = picked(own, "upper", ranks)
    found = picked(own.join(F.broadcast(upper.select("kind", "upper")), ["kind", "upper"]), "lower", upper.select("kind", "rank"))
    return {r.kind: (sizes[r.kind], r.logit) for r in found.collect()}


def trained(docs: DataFrame, text_col: str, recall: float = RECALL) -> Scanner:
    """A scanner from the findings of all documents and those drawn by rule."""
    ws = Workspace(docs.sparkSession, "secret-scan")
    shards = sharded(ws.write(all_findings(docs, text_col), "findings"), ws)
    network = fitted(shards)
    held = ws.write(held_scores(shards, network), "held")
    n, secrets = held.agg(F.count("*"), F.sum("secret")).first()
    a, b = platt(table_sums(held, secrets, n))
    ranked = ranked_logits(held, recall, a >= 0)
    at = {k: float(calibrated(np.array([logit]), a, b)[0]) for k, (_, logit) in ranked.items()}
    thresholds = [at[s] if ranked.get(s, (0,))[0] >= LEAST_SECRETS else max(at[-1], 0.5) for s in range(len(SHAPES))]
    said = (1 / (1 + F.exp(-(a * F.col("logit") + b))) >= F.get(F.array(*(F.lit(t) for t in thresholds)), F.col("shape"))).cast("double")
    found, alarms = held.agg(F.avg(F.when(F.col("secret") == 1, said)), F.avg(F.when(F.col("secret") == 0, said))).first()
    ws.drop()
    return Scanner(network, a, b, thresholds, {"recall": found, "false_alarms": alarms, "held": float(n)})


# --- the operator -----------------------------------------------------------------------------------------------------

_FOUND = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_learned bigint, base_sha256 string, spans string"


def scan_text(text: str, scanner: Scanner | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those that the network adds: candidates beside all base spans."""
    base, added = base_spans(text), []
    if scanner is not None:
        found = candidates(text)
        free = [x for x, own in zip(found, beside(base, found), strict=True) if own]
        for low in range(0, len(free), 256):
            part = free[low : low + 256]
            p = scanner.probabilities([windows(text, s, e) for s, e in part])
            added += [(s, len(BASE), e) for (s, e), x in zip(part, p, strict=True) if x >= scanner.thresholds[shape(text[s:e])]]
    return base, added


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """One row a document: counts a kind, spans kind:start:end, and the digest of those that the fixed patterns find."""
    ensure_importable(docs.sparkSession)
    scanner = scanner or trained(docs, text_col)
    kinds = [*(b[0] for b in BASE), LEARNED]

    def said(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, added = scan_text(text.as_py() or "", scanner)
                counts = [sum(k == j for _, k, _ in base) for j in range(len(BASE))]
                rows.append((*counts, len(added), hashlib.sha256(said(base).encode()).hexdigest(), said(sorted(base + added))))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=t) for c, t in zip(cols, types, strict=True))], [c.split()[0] for c in _FOUND.split(", ")])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), _FOUND)

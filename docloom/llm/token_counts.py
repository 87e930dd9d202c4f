"""Token counts behind a digest cache: a text is encoded once for each tokenizer version."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom._ship import ensure_importable
from docloom.llm.bpe import ship_file, steps
from docloom.llm.fragments import LONG, fragments_of
from docloom.llm.memory import lean
from docloom.llm.workspace import Workspace, shuffles_end_with_query

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"
#: Parts that a worker remembers the counts of; it forgets all when full, which changes no result.
MEMO = 400_000
_OPEN: dict[str, Counter] = {}


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary, the library's version and how it is called."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    with open(path, "rb") as f:
        body = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(f"{library} {version(library)} {body} no-added-special".encode()).hexdigest()


class Counter:
    """Counts of texts by the library that reads the file; of vocabularies that may be cut, each distinct part is encoded once."""

    def __init__(self, path: str) -> None:
        self.memo: dict[bytes, int] = {}
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            with open(path, "rb") as f:
                self.cut = may_be_cut(json.load(f))
            self.count = lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.cut = False
            self.count = lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]

    def counts_of(self, texts: pa.Array) -> np.ndarray:
        if not self.cut:
            return np.array(self.count(pc.fill_null(texts, "").to_pylist()), dtype=np.int64)
        found = fragments_of(texts)
        new = [x for x in found.distinct if x not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.memo = {x: self.memo[x] for x in found.distinct if x in self.memo}
        for start in range(0, len(new), 4096):  # the library holds what it makes of one call
            some = new[start : start + 4096]
            self.memo.update(zip(some, self.count([x.decode("utf-8") for x in some])))
        sizes = np.array([self.memo[x] for x in found.distinct], dtype=np.int64)
        for x in new:
            if len(x) > LONG:
                del self.memo[x]
        total = np.r_[0, np.cumsum(sizes[found.part])]
        return total[found.first[1:]] - total[found.first[:-1]]


def may_be_cut(settings: dict) -> bool:
    """Whether a tokenizer's file says that it splits texts by PATTERN first, with nothing that looks across single spaces."""
    split = settings.get("pre_tokenizer") or {}
    model = settings.get("model") or {}
    plain = settings.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    whole = model.get("type") == "BPE" and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    added = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or any(c.isspace() for c in x["content"])) for x in settings.get("added_tokens", []))
    return bool(plain and whole and added)


def normalised(text: Column) -> Column:
    """What the digest is taken of. Null is empty; byte-level counts depend on every byte, so that nothing is folded."""
    return F.coalesce(text, F.lit(""))


def _encode(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _OPEN:
            _OPEN[name] = Counter(SparkFiles.get(name))
        for batch in batches:
            for start, stop in steps(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)):
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_OPEN[name].counts_of(part.column(1)), type=pa.int64())], ["digest", "n_tokens"])

    return lean(run)


def count_tokens(docs: DataFrame, *, tokenizer_path: str, cache_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row; counts that are missing are added to the cache.

    The cache at cache_path is a set of Parquet folders of (tokenizer, digest, n_tokens),
    one for each call that found misses; it may be missing at first. Only the texts of
    missing digests move, one for each digest, as copies are combined before the shuffle.
    The library encodes them without begin, end or added special tokens, and with its
    default for special strings inside texts; where its file shows that it splits texts as
    fragments.PATTERN does, it encodes each distinct part once, else whole texts. The append is finished before the result
    is read, so that a lost executor encodes nothing twice.

    Null texts count as empty (0 bytes, 0 tokens for byte-level vocabularies). Null ids and
    repeated rows stay as they are; texts of any length are counted whole; an empty table
    gives no rows and an empty append. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    ensure_importable(spark)
    tokenizer = tokenizer_version(tokenizer_path)
    name = ship_file(spark, tokenizer_path)
    ws = Workspace(spark, "token-counts")
    text = normalised(F.col(text_col).cast("string"))
    keyed = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    known = _read(spark, cache_path, tokenizer)
    fresh = keyed.select("digest", "text")
    if known is not None:
        fresh = fresh.join(ws.write(known.select("digest"), "known"), "digest", "left_anti")
    fresh = fresh.groupBy("digest").agg(F.first("text").alias("text")).select("digest", "text")
    made = fresh.mapInArrow(_encode(name), "digest binary, n_tokens bigint")
    append(made.select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens"), cache_path)
    # written without a shuffle of its own behind it, so that the join may split a digest with many rows
    counts = ws.write(_read(spark, cache_path, tokenizer), "counts")
    rows = keyed.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest")
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def append(made: DataFrame, cache_path: str) -> None:
    with shuffles_end_with_query(made.sparkSession):
        made.write.parquet(f"{cache_path}/append-{uuid.uuid4().hex}")


def _read(spark, cache_path: str, tokenizer: str) -> DataFrame | None:
    """The counts of one tokenizer version; equal entries of calls at the same time are one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.schema(CACHE_SCHEMA).parquet(f"{cache_path}/append-*")
    return rows.filter(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

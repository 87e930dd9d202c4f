"""What several calls in one session could take from each other: vocabularies of one name, threads with scopes of their own."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from docloom.llm import bpe, token_counts, workspace

P = pytest.importorskip("public_tokenizers")


def test_two_vocabularies_of_one_name(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        whole = json.load(f)
    fewer = json.loads(json.dumps(whole))
    fewer["model"]["merges"] = fewer["model"]["merges"][:200]
    text = "Reading between the lines of the whole corpus, twice over."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for i, settings in enumerate((whole, fewer, whole)):
        (tmp_path / str(i)).mkdir()
        path = tmp_path / str(i) / "tokenizer.json"
        path.write_text(json.dumps(settings), encoding="utf-8")
        want = len(tokenizers.Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False))
        for _ in range(2):
            assert token_counts.count_tokens(docs, tokenizer_path=str(path), cache_path=str(tmp_path / "cache")).first().n_tokens == want


def test_two_rank_files_of_one_name(spark, tmp_path):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        lines = f.read().splitlines()
    docs = spark.createDataFrame([(1, "Reading between the lines")], "doc_id long, text string")
    got = []
    for i, body in enumerate((lines, lines[:300])):
        (tmp_path / str(i)).mkdir()
        path = tmp_path / str(i) / "ranks.tiktoken"
        path.write_bytes(b"\n".join(body))
        got.append(bpe.encode_documents(docs, ranks_path=str(path), pattern=P.PATTERN).first())
        assert got[-1].n_tokens == len(bpe.ByteBpe(bpe.load_ranks(path.read_bytes()), P.PATTERN).encode("Reading between the lines")) // 4
    assert got[0].n_tokens < got[1].n_tokens and got[0].decoded_sha256 == got[1].decoded_sha256


def test_scopes_of_threads_are_apart(spark):
    inside, left, found = threading.Event(), threading.Event(), []

    def first():
        with workspace.scratch():
            ws = workspace.Workspace(spark, "a")
            kept = ws.write(spark.range(10), "t")
            inside.set()
            left.wait(60)
            found.append(kept.count())

    def second():
        inside.wait(60)
        with workspace.scratch():
            workspace.Workspace(spark, "b").write(spark.range(3), "t")
        left.set()

    threads = [threading.Thread(target=f) for f in (first, second)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found == [10]


def test_setting_comes_back_after_writes_in_two_threads(spark):
    before, both = spark.conf.get(workspace._CLEANUP, None), threading.Barrier(2)

    def write(k):
        for _ in range(3):
            both.wait(60)
            with workspace.shuffles_end_with_query(spark):
                spark.range(100 * k).groupBy((F.col("id") % 3).alias("g")).count().collect()

    threads = [threading.Thread(target=write, args=(k,)) for k in (1, 20)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert spark.conf.get(workspace._CLEANUP, None) == before and not workspace._WRITES

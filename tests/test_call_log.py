"""Answers outlive a job that dies half way; one bucket bounds the calls of all tasks."""

import json
import os
import sys
import time
from collections import Counter
from email.message import Message
from urllib.error import HTTPError

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from docloom.operators import merging
from docloom.plans import call_log, model_calls

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Recording:
    """Notes each prompt in a file of its own; wrong the first time for some; ends its worker at a prompt once."""

    def __init__(self, folder, dies_at=None):
        self.folder, self.dies_at = folder, dies_at

    def __call__(self, prompt):
        if self.dies_at and self.dies_at in prompt and not os.path.exists(f"{self.folder}/died"):
            open(f"{self.folder}/died", "w").close()
            os._exit(1)
        with open(f"{self.folder}/{time.time_ns()}-{os.getpid()}.prompt", "w") as f:
            f.write(prompt)
        if "case 3" in prompt and "errors" not in prompt:
            return "no json"
        return json.dumps({"facts": [prompt[:8]]})


def asked(folder):
    return Counter((folder / n).read_text() for n in os.listdir(folder) if n.endswith(".prompt"))


def cases(spark, n):
    return spark.range(n).select(F.concat(F.lit("h"), F.col("id").cast("string")).alias("analysis_hash"), F.format_string("case %d.", F.col("id")).alias("prompt"), F.lit("{}").alias("context"))


def accept(answer, context):
    return answer["facts"], []


def test_each_prompt_is_asked_once_though_a_worker_dies(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    log, folder = call_log.AnswerLog(f"{tmp_path}/log"), str(tmp_path / "calls")
    run = lambda: model_calls.run_cases(cases(spark, 20), lambda: Recording(folder, "case 13."), "m", accept, partitions=1, log=log).collect()
    with pytest.raises(Exception):
        run()
    before = asked(tmp_path / "calls")
    assert before and log.answers(spark).count() == sum(before.values())
    rows = {r.analysis_hash: r for r in run()}
    assert len(rows) == 20 and {r.status for r in rows.values()} == {"success"} and rows["h3"].attempts == 2
    assert set(asked(tmp_path / "calls").values()) == {1} and sum(asked(tmp_path / "calls").values()) == 21
    assert {r.analysis_hash: r.response for r in run()} == {h: r.response for h, r in rows.items()} and sum(asked(tmp_path / "calls").values()) == 21
    again = model_calls.run_cases(cases(spark, 2), lambda: Recording(folder), "m", accept, log=call_log.AnswerLog(f"{tmp_path}/log2")).collect()
    assert len(again) == 2 and sum(asked(tmp_path / "calls").values()) == 23


def test_errors_leave_no_answer(spark, tmp_path):
    def refuses(prompt):
        raise OSError("down")

    log = call_log.AnswerLog(f"{tmp_path}/log")
    assert log.answers(spark).count() == 0 and log.progress(4, 9) == "0 of 4, ? left"
    assert [r.status for r in model_calls.run_cases(cases(spark, 1), lambda: refuses, "m", accept, log=log).collect()] == ["error"]
    assert log.find("h0", "m", "case 0.") is None and log.answers(spark).count() == 0
    log.add("h0", "m", "p", "r\n語")
    assert log.progress(4, 9) == "1 of 4, 27s left"
    assert log.find("h0", "m", "p") == "r\n語" and log.find("h0", "n", "p") is None and log.answers(spark).first().response == "r\n語"


def test_bucket_by_a_clock_of_its_own():
    now = [0.0]
    bucket = call_log.TokenBucket(60, burst=3, clock=lambda: now[0])
    assert [bucket.take() for _ in range(5)] == [0, 0, 0, 1, 2]
    now[0] = 100
    assert [bucket.take() for _ in range(4)] == [0, 0, 0, 1]
    bucket.back_off()
    bucket.back_off()
    assert bucket.take() == 2 and (bucket.pause, bucket.held) == (1, 101)
    now[0] = 103
    bucket.back_off()
    assert bucket.pause == 2 and bucket.take() == 2
    now[0] = 106
    bucket.went_well()
    bucket.back_off(30)
    assert bucket.pause == 30 and bucket.take() >= 30
    with pytest.raises(ValueError):
        call_log.TokenBucket(0)


def test_all_tasks_share_one_rate(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    folder = str(tmp_path / "calls")
    with call_log.BudgetServer(spark, 600) as budget:
        rows = model_calls.run_cases(cases(spark, 12), lambda: Recording(folder), "m", accept, partitions=4, budget=budget).collect()
    times = sorted(int(n.split("-")[0]) / 1e9 for n in os.listdir(folder))
    assert len(rows) == 12 and len(times) == 13
    assert times[-1] - times[0] > 0.95 * 12 * 0.1 - 0.15
    with pytest.raises(OSError):
        budget._ask("take")


def test_refused_calls_hold_all(spark):
    with call_log.BudgetServer(spark, 6000, burst=100) as budget:
        headers = Message()
        headers["Retry-After"] = "7"

        def refused(prompt):
            raise HTTPError("u", 429, "slow down", headers, None)

        waits = []
        with pytest.raises(HTTPError):
            budget.client(refused, waits.append)("p")
        budget.client(lambda p: "ok", waits.append)("p")
        assert waits[0] == 0 and 6 < waits[1] <= 7
        with pytest.raises(ConnectionError):
            call_log.Budget(budget.host, budget.port, "wrong")._ask("take")


def test_repeated_keys_of_new_rows_are_an_error(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="repeated"):
        merging.upsert(old, new, ["k"]).collect()
    assert sorted(map(tuple, merging.upsert(old, new.limit(1), ["k"]).collect()))[0] == (1, "a")
    assert len(merging.upsert(old, new, ["k"], order=["v"]).collect()) == 2


def test_cases_stay_in_their_tasks_and_runs_leave_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(model_calls, "RUN_ROWS", 3)
    own = cases(spark, 10).repartition(6)
    got = model_calls.run_cases(own, lambda: Recording(f"{tmp_path}"), "m", accept, partitions=None)
    assert got.rdd.getNumPartitions() == 6 and sorted(r.analysis_hash for r in got.collect()) == sorted(r.analysis_hash for r in own.collect())

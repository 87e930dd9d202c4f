"""Calls to a language model behind a cache: clients, answer repair, retries, statuses."""

from __future__ import annotations

import json
import re
import time
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom._ship import ensure_importable
from docloom.plans.call_log import AnswerLog, Budget

RUN_SCHEMA = "analysis_hash string, model string, status string, response string, facts string, errors array<string>, attempts int"
#: Runs that a task hands on at once.
RUN_ROWS = 200


class Client(Protocol):
    def __call__(self, prompt: str) -> str: ...


class ReplayClient:
    """Answers from a table of prompts; unknown prompts are an error. For tests and offline work."""

    def __init__(self, answers: dict[str, list[str]]) -> None:
        self.answers, self.used = answers, {}

    def __call__(self, prompt: str) -> str:
        key = next((k for k in self.answers if k in prompt), None)
        if key is None:
            raise KeyError("no answer for this prompt")
        n = self.used[key] = self.used.get(key, -1) + 1
        return self.answers[key][min(n, len(self.answers[key]) - 1)]


class HttpClient:
    """POST of a JSON request; the answer's text is the first of the given fields."""

    def __init__(self, url: str, model: str, timeout: float = 120, fields: tuple[str, ...] = ("response", "message.content", "thinking")) -> None:
        self.url, self.model, self.timeout, self.fields = url, model, timeout, fields

    def __call__(self, prompt: str) -> str:
        body = json.dumps({"model": self.model, "prompt": prompt, "stream": False, "format": "json", "think": False, "options": {"temperature": 0}}).encode()
        request = urllib.request.Request(self.url, body, {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as r:
            answer: Any = json.load(r)
        for field in self.fields:
            value = answer
            for part in field.split("."):
                value = value.get(part) if isinstance(value, dict) else None
            if isinstance(value, str) and value.strip():
                return value
        raise ValueError("empty answer")


def without_trailing_commas(s: str) -> str:
    """Commas before a closing bracket go, outside of strings."""
    return "".join(m[0] if m[0].startswith('"') else m[2] for m in re.finditer(r'("(?:[^"\\]|\\.)*")|(?:,\s*(?=[}\]]))?((?s:.))', s) if m[1] or m[2])


def parse_answer(text: str) -> dict:
    """The JSON object in a model's answer: whole, between the outer braces, or in a fence; with commas repaired."""
    bare = re.sub(r"^\s*```\w*\s*|\s*```\s*$", "", text)
    tries = [bare]
    if "{" in bare and "}" in bare:
        tries.append(bare[bare.index("{") : bare.rindex("}") + 1])
    tries += reversed(re.findall(r"```\w*\s*(\{.*?\})\s*```", text, re.S))
    for t in tries:
        for candidate in (t, without_trailing_commas(t)):
            try:
                found = json.loads(candidate)
            except ValueError:
                continue
            if isinstance(found, dict):
                return found
    raise ValueError("no JSON object in the answer")


def ask(client: Client, prompt: str, validate: Callable[[dict], tuple[list, list[str]]], retries: int = 2, wait: float = 0) -> dict:
    """One case: success, review (some facts wrong) or error, with the valid facts. Wrong answers are asked again with what was wrong."""
    out = {"status": "error", "response": None, "facts": [], "errors": ["not asked"], "attempts": 0}
    now = prompt
    while out["attempts"] <= retries and out["status"] != "success":
        out["attempts"] += 1
        try:
            out["response"] = client(now)
            out |= judged(out["response"], validate)
            now = f"{prompt}\n\nYour last answer had errors: {'; '.join(out['errors'])}"
        except Exception as e:  # noqa: BLE001  network and server errors are retried as they are
            out |= {"status": "error", "facts": [], "errors": [f"{type(e).__name__}: {e}"]}
            now = prompt
        if wait:
            time.sleep(wait)
    return out


def judged(response: str | None, validate: Callable[[dict], tuple[list, list[str]]]) -> dict:
    """status, facts and errors of an answer; one that can't be read is an error without facts."""
    try:
        facts, errors = validate(parse_answer(response or ""))
    except ValueError as e:
        return {"status": "error", "facts": [], "errors": [str(e)]}
    return {"status": "review" if errors else "success", "facts": facts, "errors": errors}


def wanted(status: Column, mode: str = "incomplete", force: bool = False) -> Column:
    """Which cases to run, by their cached status: incomplete, new, review or error; force: all."""
    if force:
        return F.lit(True)
    return {"incomplete": ~status.eqNullSafe("success"), "new": status.isNull()}.get(mode, status.eqNullSafe(mode))


def pending(cases: DataFrame, cache: DataFrame, model: str, mode: str = "incomplete", force: bool = False, limit: int | None = None) -> DataFrame:
    """Distinct cases to send: one for each analysis_hash, cached ones of the model left out. limit counts calls."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    known = cache.filter(F.col("model") == model).select("analysis_hash", F.col("status").alias("__status"))
    found = cases.dropDuplicates(["analysis_hash"]).join(known, "analysis_hash", "left").filter(wanted(F.col("__status"), mode, force)).drop("__status")
    return found if limit is None else found.orderBy("analysis_hash").limit(limit)


def from_other_model(cases: DataFrame, cache: DataFrame, source: str, target: str, statuses: tuple[str, ...] = ("review", "error")) -> DataFrame:
    """Cases that another model left in one of these statuses."""
    if source == target:
        raise ValueError("the source model must differ from the target")
    return cases.join(cache.filter((F.col("model") == source) & F.col("status").isin(*statuses)).select("analysis_hash").distinct(), "analysis_hash", "left_semi")


def run_cases(cases: DataFrame, make_client: Callable[[], Client], model: str, validate: Callable[[dict, dict], tuple[list, list[str]]], retries: int = 2, wait: float = 0, partitions: int | None = 4, log: AnswerLog | None = None, budget: Budget | None = None) -> DataFrame:
    """Runs of (analysis_hash, prompt, context) rows; partitions bounds the calls at a time, None leaves the cases in the tasks that have them.

    With a log, answers outlive their task: what is run again after a lost executor asks
    only what has no answer yet. A budget bounds the calls of all tasks together.
    """
    ensure_importable(cases.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = make_client()
        client = budget.client(plain) if budget else plain
        for frame in frames:
            out = []
            for h, p, c in zip(frame["analysis_hash"], frame["prompt"], frame["context"], strict=True):
                own = log.client(client, h, model) if log else client
                out.append(_row(h, model, ask(own, p, lambda a, c=c: validate(a, json.loads(c)), retries, wait)))
                if len(out) >= RUN_ROWS:
                    yield pd.DataFrame(out, columns=_COLUMNS)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=_COLUMNS)

    rows = cases.select("analysis_hash", "prompt", "context")
    return (rows if partitions is None else rows.repartition(partitions)).mapInPandas(run, RUN_SCHEMA)


_COLUMNS = [x.split()[0] for x in RUN_SCHEMA.split(", ")]


def _row(analysis_hash: str, model: str, answer: dict) -> dict:
    return {"analysis_hash": analysis_hash, "model": model, **answer, "facts": json.dumps(answer["facts"], ensure_ascii=False)}


def revalidated(runs: DataFrame, contexts: DataFrame, validate: Callable[[dict, dict], tuple[list, list[str]]], leave_unreadable: bool = False) -> DataFrame:
    """Stored runs judged again by today's validator, without any call; contexts: (analysis_hash, context).

    Runs of other cases stay as they are, as runs without an answer do. An answer that
    can't be read becomes an error without facts, or is left as it was. changed tells
    which runs differ; nothing is written here.
    """
    ensure_importable(runs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                old = {c: row[c] for c in _COLUMNS} | {"errors": list(row["errors"]) if row["errors"] is not None else None}
                new = dict(old)
                if row["response"] is not None and row["context"] is not None:
                    told = judged(row["response"], lambda a: validate(a, json.loads(row["context"])))  # noqa: B023
                    if not (leave_unreadable and told["status"] == "error"):
                        new |= told | {"facts": json.dumps(told["facts"], ensure_ascii=False)}
                out.append(new | {"changed": new != old})
            yield pd.DataFrame(out, columns=[*_COLUMNS, "changed"])

    joined = runs.select(*_COLUMNS).join(contexts.select("analysis_hash", "context"), "analysis_hash", "left")
    return joined.mapInPandas(run, RUN_SCHEMA + ", changed boolean")

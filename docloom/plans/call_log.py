"""What calls of a model leave behind while a job runs: answers that outlive their task, and one budget for all tasks."""

from __future__ import annotations

import hashlib
import hmac
import json
import secrets
import socket
import socketserver
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.error import HTTPError

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from docloom.functions.progress import eta
from docloom.sources.archives import opened

ANSWER_SCHEMA = "analysis_hash string, model string, prompt_sha256 string, response string, answered_at double"


class AnswerLog:
    """Answers of one run below a folder that all workers reach: one file an answer, there as a whole or not at all.

    An answer is found by its case, model and prompt. A task that is run again, or a job
    that is started again with the same folder, goes through the same prompts and meets
    its answers, follow-ups of wrong answers too; only what was never answered is asked.
    Errors of network and server leave nothing. A run that shall ask anew takes a new folder.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder.rstrip("/")
        self._files: tuple[pafs.FileSystem, str] | None = None

    def __getstate__(self) -> dict:
        return {"folder": self.folder, "_files": None}

    def _at(self, analysis_hash: str, model: str, prompt: str) -> tuple[pafs.FileSystem, str, str]:
        if self._files is None:
            self._files = opened(self.folder)
        files, root = self._files
        key = hashlib.sha256(json.dumps([analysis_hash, model, prompt]).encode()).hexdigest()
        return files, f"{root}/{key[:2]}", f"{key}.json"

    def find(self, analysis_hash: str, model: str, prompt: str) -> str | None:
        files, folder, name = self._at(analysis_hash, model, prompt)
        try:
            with files.open_input_stream(f"{folder}/{name}") as f:
                return json.loads(f.read())["response"]
        except FileNotFoundError:
            return None

    def add(self, analysis_hash: str, model: str, prompt: str, response: str) -> None:
        files, folder, name = self._at(analysis_hash, model, prompt)
        files.create_dir(folder, recursive=True)
        part = f"{folder}/.{uuid.uuid4().hex}"
        row = {"analysis_hash": analysis_hash, "model": model, "prompt_sha256": hashlib.sha256(prompt.encode()).hexdigest(), "response": response, "answered_at": time.time()}
        with files.open_output_stream(part) as f:
            f.write(json.dumps(row, ensure_ascii=False).encode())
        files.move(part, f"{folder}/{name}")

    def answers(self, spark: SparkSession) -> DataFrame:
        """All answers so far."""
        files, root = opened(self.folder)
        if files.get_file_info(root).type == pafs.FileType.NotFound:
            return spark.createDataFrame([], ANSWER_SCHEMA)
        return spark.read.schema(ANSWER_SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(self.folder)

    def progress(self, total: int, seconds: float) -> str:
        """How many answers of about total there are after so many seconds, and what is left at that speed; for the driver's log while the job runs."""
        files, root = opened(self.folder)
        found = files.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True))
        done = sum(x.base_name.endswith(".json") for x in found)
        return f"{done} of {total}, {eta(done, total, seconds)} left"

    def client(self, client: Callable[[str], str], analysis_hash: str, model: str) -> Callable[[str], str]:
        """client for one case, behind the log."""

        def call(prompt: str) -> str:
            known = self.find(analysis_hash, model, prompt)
            if known is None:
                known = client(prompt)
                self.add(analysis_hash, model, prompt, known)
            return known

        return call


class TokenBucket:
    """per_minute calls, burst of them at once. take() books the next call and tells how long to wait for it.

    back_off() holds all calls that aren't booked yet; without a word from the server, for
    twice as long as the last time, until a call has gone well.
    """

    def __init__(self, per_minute: float, burst: int = 1, clock: Callable[[], float] = time.monotonic) -> None:
        if per_minute <= 0 or burst < 1:
            raise ValueError("per_minute and burst must be positive")
        self.gap, self.burst, self.clock = 60 / per_minute, burst, clock
        self.next, self.held, self.pause = clock() - self.gap * (burst - 1), float("-inf"), 0.0
        self._lock = threading.Lock()

    def take(self) -> float:
        with self._lock:
            now = self.clock()
            self.next = max(self.next, now - self.gap * (self.burst - 1), self.held)
            wait = max(0.0, self.next - now)
            self.next += self.gap
            return wait

    def back_off(self, seconds: float = 0) -> None:
        with self._lock:
            if self.clock() < self.held:
                return  # calls that were under way when others had been refused already
            self.pause = seconds or min(600.0, max(1.0, 2 * self.pause))
            self.held = self.clock() + self.pause

    def went_well(self) -> None:
        with self._lock:
            if self.clock() >= self.held:
                self.pause = 0.0


@dataclass(frozen=True)
class Budget:
    """A task's way to the driver's bucket."""

    host: str
    port: int
    secret: str

    def _ask(self, what: str) -> float:
        with socket.create_connection((self.host, self.port), timeout=60) as s:
            s.sendall(f"{self.secret} {what}\n".encode())
            with s.makefile() as f:
                answer = f.readline().strip()
        if not answer:
            raise ConnectionError("the driver's budget didn't answer")
        return float(answer)

    def client(self, client: Callable[[str], str], sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
        """client that waits for its turn, and tells all tasks to wait when the server asks for it."""

        def call(prompt: str) -> str:
            sleep(self._ask("take"))
            try:
                out = client(prompt)
            except HTTPError as e:
                if e.code in (429, 503):
                    after = (e.headers or {}).get("Retry-After") or ""
                    self._ask(f"hold {after if after.isdigit() else 0}")
                raise
            self._ask("well")
            return out

        return call


class BudgetServer:
    """The bucket of one job, kept by the driver while the job runs: `with BudgetServer(spark, 60) as budget`."""

    def __init__(self, spark: SparkSession, per_minute: float, burst: int = 1) -> None:
        conf = spark.sparkContext.getConf()
        self.host = conf.get("spark.driver.host", "127.0.0.1")
        self.bucket, self.secret = TokenBucket(per_minute, burst), secrets.token_hex(16)
        bucket, secret = self.bucket, self.secret

        class Handler(socketserver.StreamRequestHandler):
            def handle(self) -> None:
                said, _, what = self.rfile.readline(1000).decode("ascii", "replace").strip().partition(" ")
                if not hmac.compare_digest(said.encode(), secret.encode()):
                    return
                out = 0.0
                if what == "take":
                    out = bucket.take()
                elif what == "well":
                    bucket.went_well()
                elif what.startswith("hold "):
                    bucket.back_off(float(what[5:]))
                self.wfile.write(f"{out}\n".encode())

        class Server(socketserver.ThreadingTCPServer):
            daemon_threads, allow_reuse_address = True, True

        self.server = Server((conf.get("spark.driver.bindAddress", self.host), 0), Handler)

    def __enter__(self) -> Budget:
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return Budget(self.host, self.server.server_address[1], self.secret)

    def __exit__(self, *exc) -> None:
        self.server.shutdown()
        self.server.server_close()

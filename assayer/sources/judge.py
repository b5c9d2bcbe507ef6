"""Judges: what answers a prompt. They are called in tasks, once for each request that no verdict answers."""

from __future__ import annotations

import hashlib
import http.client
import io
import json
import os
import threading
import time
import urllib.error
import urllib.request
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame


class JudgeError(Exception):
    """A reply that can't be had or used; the message is fit for a report."""


@dataclass(frozen=True)
class Reply:
    text: str
    cost: float
    provider: str


class Judge(Protocol):
    """Picklable; ask() runs in Python workers, in several threads of each."""

    model: str
    provider: str

    def ask(self, prompt: str, system: str) -> Reply: ...


@dataclass(frozen=True)
class DeterministicJudge:
    """Answers from a digest of the prompt: for tests and dry runs."""

    model: str = "digest"
    provider: str = "local"

    def ask(self, prompt: str, system: str) -> Reply:
        words = ("MET", "NOT_MET") if "NOT_MET" in system else ("A", "B", "TIE")
        digest = hashlib.sha256(f"{system}\0{prompt}".encode()).digest()
        return Reply(f"By digest.\n{words[digest[0] % len(words)]}", 0.0, self.provider)


def credential(variable: str, file: Path | None = None) -> str:
    """From the environment, else from a file. Read on the driver; never put in a column."""
    key = os.environ.get(variable, "").strip() or (file.read_text().strip() if file and file.exists() else "")
    if not key:
        raise JudgeError(f"no credential: set {variable}")
    return key


_OPEN = threading.local()


def kept_alive(request: urllib.request.Request, timeout: float) -> io.BytesIO:
    """The body of a reply, over a connection that its thread keeps for the next request to that host."""
    held = _OPEN.__dict__.setdefault("connections", {})
    at = (request.type, request.host)
    kind = http.client.HTTPSConnection if request.type == "https" else http.client.HTTPConnection
    known = at in held
    connection = held.pop(at, None) or kind(request.host, timeout=timeout)
    try:
        try:
            connection.request(request.get_method(), request.selector, request.data, dict(request.header_items()))
            reply = connection.getresponse()
        except (http.client.HTTPException, ConnectionError):
            connection.close()
            if not known:
                raise
            # the host has closed a connection that lay idle
            connection = kind(request.host, timeout=timeout)
            connection.request(request.get_method(), request.selector, request.data, dict(request.header_items()))
            reply = connection.getresponse()
        body = reply.read()
    except http.client.HTTPException as e:
        connection.close()
        raise OSError(type(e).__name__) from e
    except OSError:
        connection.close()
        raise
    held[at] = connection
    if reply.status >= 300:
        raise urllib.error.HTTPError(request.full_url, reply.status, reply.reason, reply.headers, None)
    return io.BytesIO(body)


@dataclass(frozen=True)
class ChatJudge:
    """A chat-completions endpoint, temperature 0, pinned to one provider if that is named."""

    url: str
    model: str
    provider: str = ""
    key: str = field(default="", repr=False)
    attempts: int = 4
    timeout: float = 120

    def ask(self, prompt: str, system: str, sleep=time.sleep, opened=kept_alive) -> Reply:
        body = {"model": self.model, "temperature": 0, "messages": [{"role": "system", "content": system}, {"role": "user", "content": prompt}]}
        if self.provider:
            body["provider"] = {"only": [self.provider], "allow_fallbacks": False}
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        reason = "no reply"
        for n in range(self.attempts):
            if n:
                sleep(2 ** (n - 1))
            try:
                with opened(request, timeout=self.timeout) as reply:
                    got = json.load(reply)
                text = got["choices"][0]["message"]["content"] or ""
            except urllib.error.HTTPError as e:
                reason = f"HTTP {e.code}"
                continue
            except (OSError, ValueError, KeyError, IndexError, TypeError) as e:
                reason = type(e).__name__
                continue
            provider = got.get("provider", "")
            if self.provider and provider.casefold() != self.provider.casefold():
                raise JudgeError("another provider answered than the one named")
            if text.strip():
                return Reply(text, float((got.get("usage") or {}).get("cost") or 0.0), provider)
            reason = "empty reply"
        raise JudgeError(f"the judge didn't answer ({reason})")


class Pace:
    """A token bucket: wait() returns `rate` times a second at most, and a second's worth at once after a rest."""

    def __init__(self, rate: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.clock, self.sleep = rate, clock, sleep
        self.tokens, self.at = max(1.0, rate), clock()
        self.lock = threading.Lock()

    def wait(self) -> None:
        with self.lock:  # who comes next waits behind it
            now = self.clock()
            self.tokens = min(max(1.0, self.rate), self.tokens + (now - self.at) * self.rate)
            self.at = now
            if self.tokens < 1:
                rest = (1 - self.tokens) / self.rate
                self.sleep(rest)
                self.tokens, self.at = 1.0, self.clock()
            self.tokens -= 1


class Journal:
    """Answers of one task, each on disk before it is told; a later try of the task, or a later run, finds them there."""

    def __init__(self, folder: Path, task: str):
        self.known: dict[str, dict] = {}
        for path in folder.glob(f"{task}-*.jsonl"):
            self.known |= {r["key"]: r for r in _answers(path)}
        folder.mkdir(parents=True, exist_ok=True)
        self.file = (folder / f"{task}-{uuid.uuid4().hex}.jsonl").open("ab")
        self.lock = threading.Lock()

    def put(self, answer: dict) -> None:
        with self.lock:
            self.file.write(json.dumps(answer).encode() + b"\n")
            self.file.flush()
            os.fsync(self.file.fileno())


def _answers(path: Path) -> Iterator[dict]:
    """The whole lines of a journal; the last may have been cut short."""
    with path.open("rb") as f:
        for line in f:
            if line.endswith(b"\n"):
                yield json.loads(line)


ANSWER = "key string, reply string, cost double, provider string, error string"
_FIELDS = ["key", "reply", "cost", "provider", "error"]


def _answer(judge: Judge, key: str, prompt: str, system: str) -> dict:
    out = {"key": key, "reply": None, "cost": 0.0, "provider": None, "error": None}
    try:
        got = judge.ask(prompt, system)
        return out | {"reply": got.text, "cost": got.cost, "provider": got.provider}
    except JudgeError as e:
        return out | {"error": str(e)}
    except Exception as e:  # noqa: BLE001  only its kind may be shown
        return out | {"error": type(e).__name__}


def ask_all(
    requests: DataFrame, judge: Judge, key: str = "key", at_once: int | None = None, per_second: float | None = None, journal: Path | None = None, run: str = "run"
) -> DataFrame:
    """key, reply, cost, provider, error of requests(key, prompt, system): one call a row.

    At most at_once calls run at a time, over all tasks (by default as many as Spark runs tasks), each in a thread of its
    own, and at most per_second begin in a second: both are divided among the tasks. With a journal folder, which all
    executors share, every answer is on disk before it is told, and a task of this run that is tried again asks only what
    has no answer there. Write the result before using it twice: a plan that is run again asks again.
    """
    slots = requests.sparkSession.sparkContext.defaultParallelism
    at_once = at_once or slots
    tasks = min(at_once, slots)
    threads = at_once // tasks

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = Pace(per_second / tasks) if per_second else None
        notes = Journal(journal, f"{run}-{TaskContext.get().partitionId()}") if journal else None

        def one(row: dict) -> dict:
            if notes and row["key"] in notes.known:
                return notes.known[row["key"]]
            if pace:
                pace.wait()
            got = _answer(judge, row["key"], row["prompt"], row["system"])
            if notes and got["error"] is None:
                notes.put(got)
            return got

        with ThreadPoolExecutor(threads) as pool:
            waiting: deque[Future] = deque()
            for batch in batches:
                done = []
                for row in batch.to_dict("records"):
                    if len(waiting) >= 2 * threads:
                        done.append(waiting.popleft().result())
                    waiting.append(pool.submit(one, row))
                yield pd.DataFrame(done, columns=_FIELDS)
            yield pd.DataFrame([f.result() for f in waiting], columns=_FIELDS)

    dealt = requests.select(requests[key].alias("key"), "prompt", "system").repartition(tasks, "key")
    return dealt.mapInPandas(ask, ANSWER)

import json
import time
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from assayer.plans import judging
from assayer.schemas import VERDICT
from assayer.sources import verdict_log
from assayer.sources.judge import ChatJudge, DeterministicJudge, Journal, JudgeError, Pace, Reply, ask_all


def rows(spark, keys, seq, met):
    return spark.createDataFrame([(f"k{k}", seq, met, None, None, 0.5) for k in keys], VERDICT)


def told(df):
    return {r["key"]: (r["seq"], r["met"]) for r in df.collect()}


def test_snapshots_keep_the_last_record(spark, tmp_path):
    log = f"{tmp_path}/log"
    assert verdict_log.compact(spark, log) is False and told(verdict_log.read_verdicts(spark, log)) == {}
    # a log of old: JSON lines alone
    (tmp_path / "log").mkdir()
    (tmp_path / "log/part-0.json").write_text("".join(json.dumps({"key": f"k{i}", "seq": 1, "met": True, "cost": 0.5}) + "\n" for i in range(100)))
    want = {f"k{i}": (1, True) for i in range(100)}
    assert told(verdict_log.read_verdicts(spark, log)) == want
    assert verdict_log.compact(spark, log, buckets=16) and not verdict_log.compact(spark, log)
    assert told(verdict_log.read_verdicts(spark, log)) == want
    verdict_log.append_verdicts(rows(spark, range(50, 60), 0, False), log)  # older than what is there
    verdict_log.append_verdicts(rows(spark, range(90, 120), 2, False), log)
    want |= {f"k{i}": (2, False) for i in range(90, 120)}
    assert told(verdict_log.read_verdicts(spark, log)) == want
    reader = verdict_log.read_verdicts(spark, log)
    assert verdict_log.compact(spark, log)
    now = verdict_log.state(spark, log)
    assert (now.number, now.buckets, now.deltas) == (2, 16, []) and told(reader) == want  # a reader from before keeps its files
    assert told(verdict_log.read_verdicts(spark, log)) == want
    verdict_log.append_verdicts(rows(spark, [500], 3, True), log)
    assert verdict_log.compact(spark, log) and told(verdict_log.read_verdicts(spark, log)) == want | {"k500": (3, True)}
    assert len([p for p in (tmp_path / "log/_snapshot").iterdir() if p.is_dir()]) == 2  # this one and the one before
    assert len(list((tmp_path / "log").glob("*.json"))) <= 4
    assert verdict_log.compact(spark, log, buckets=4) and verdict_log.state(spark, log).buckets == 4
    assert told(verdict_log.read_verdicts(spark, log)) == want | {"k500": (3, True)}


def test_a_probe_reads_the_buckets_it_hits(spark, tmp_path):
    log = f"{tmp_path}/log"
    verdict_log.append_verdicts(rows(spark, range(2000), 1, True), log)
    verdict_log.compact(spark, log, buckets=64)
    keys = spark.createDataFrame([("k7",), ("k7",), ("none",), (None,)], "key string")
    found = verdict_log.probe_verdicts(keys, log)
    assert told(found) == {"k7": (1, True)}
    every = verdict_log.read_verdicts(spark, log)
    assert len(every.inputFiles()) >= 60 and 1 <= len(found.inputFiles()) <= 3
    verdict_log.append_verdicts(rows(spark, [7], 2, False), log)
    assert told(verdict_log.probe_verdicts(keys, log)) == {"k7": (2, False)}
    assert told(verdict_log.probe_verdicts(keys.limit(0), log)) == {}


def test_two_compactions_at_once(spark, tmp_path, monkeypatch):
    log = f"{tmp_path}/log"
    verdict_log.append_verdicts(rows(spark, range(10), 1, True), log)
    real, first = verdict_log._commit, []

    def slow(spark_, path, number, content):
        if not first:
            first.append(1)
            assert verdict_log.compact(spark, log)  # another run is faster
            verdict_log.append_verdicts(rows(spark, [99], 1, True), log)
        return real(spark_, path, number, content)

    monkeypatch.setattr(verdict_log, "_commit", slow)
    assert verdict_log.compact(spark, log) is False
    assert len(told(verdict_log.read_verdicts(spark, log))) == 11


class Watched(DeterministicJudge):
    """Notes in a folder when it is asked; the number of open notes is the number of calls in flight."""

    def __init__(self, folder):
        super().__init__()
        object.__setattr__(self, "folder", str(folder))

    def ask(self, prompt, system):
        import os
        import uuid

        mine = f"{self.folder}/open-{uuid.uuid4().hex}"
        open(mine, "w").close()
        now = len([n for n in os.listdir(self.folder) if n.startswith("open-")])
        time.sleep(0.01)
        os.unlink(mine)
        with open(f"{self.folder}/log", "a") as f:
            f.write(f"{prompt} {now}\n")
        if os.path.exists(f"{self.folder}/break") and prompt == "p13":
            os.unlink(f"{self.folder}/break")
            os._exit(1)  # the worker is lost
        if prompt == "p5":
            raise JudgeError("the judge broke")
        return super().ask(prompt, system)


def requests(spark, n):
    return spark.createDataFrame([(f"k{i}", f"p{i}", "MET or NOT_MET") for i in range(n)], "key string, prompt string, system string")


@pytest.mark.parametrize("at_once", [1, 3, 12])
def test_calls_in_flight_are_bounded(spark, tmp_path, at_once):
    got = ask_all(requests(spark, 60), Watched(tmp_path), at_once=at_once).collect()
    assert sorted(r["key"] for r in got) == sorted(f"k{i}" for i in range(60)) and sum(r["error"] is not None for r in got) == 1
    seen = [int(line.split()[1]) for line in (tmp_path / "log").read_text().splitlines()]
    assert max(seen) <= at_once and len(seen) == 60


def test_a_lost_task_loses_no_answer(spark, tmp_path):
    """The worker dies on one of its calls; the next run asks that one, and none that was answered."""
    log, folder = f"{tmp_path}/log", tmp_path / "calls"
    folder.mkdir()
    (folder / "break").write_text("")
    judge = Watched(folder)
    with pytest.raises(Exception):  # noqa: B017  the session of tests has no second try
        judging.judged(requests(spark, 40), "rubric", judge, log, at_once=1)
    before = [line.split()[0] for line in (folder / "log").read_text().splitlines()]
    assert before[-1] == "p13"
    got = judging.judged(requests(spark, 40), "rubric", judge, log, at_once=4).collect()
    assert sum(r["met"] is not None for r in got) == 39 and [r["error"] for r in got if r["met"] is None] == ["the judge broke"]
    asked = [line.split()[0] for line in (folder / "log").read_text().splitlines()]
    assert {p: asked.count(p) for p in set(asked) if asked.count(p) > 1}.keys() <= {"p13", "p5"}
    assert not list((tmp_path / "log/_replies/waiting").iterdir())
    judging.judged(requests(spark, 40), "rubric", judge, log)
    assert len((folder / "log").read_text().splitlines()) == len(asked) + 1  # the failed one alone


def test_journal_and_pace(tmp_path):
    j = Journal(tmp_path, "run-1")
    j.put({"key": "a", "reply": "é\n"})
    j.file.write(b'{"key": "b", "rep')
    j.file.flush()
    assert Journal(tmp_path, "run-1").known == {"a": {"key": "a", "reply": "é\n"}} and Journal(tmp_path, "run-2").known == {}
    now = [0.0]
    pace = Pace(2, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    begun = []
    for _ in range(7):
        pace.wait()
        begun.append(now[0])
    assert begun == [0, 0, 0.5, 1.0, 1.5, 2.0, 2.5]


@pytest.fixture
def server():
    seen = {"connections": set(), "requests": 0}

    class Handler(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def do_POST(self):
            seen["connections"].add(self.client_address)
            seen["requests"] += 1
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["messages"][1]["content"]
            status = 503 if asked == "busy" else 200
            body = json.dumps({"choices": [{"message": {"content": f"for {asked}\nMET"}}], "provider": "P", "usage": {"cost": 0.5}}).encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(body)))
            if asked == "last":
                self.send_header("Connection", "close")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/chat", seen
    s.shutdown()


def test_connections_are_kept(server):
    url, seen = server
    judge = ChatJudge(url, "m", attempts=2, timeout=5)
    for i in range(5):
        assert judge.ask(f"{i}", "s") == Reply(f"for {i}\nMET", 0.5, "P")
    assert len(seen["connections"]) == 1 and seen["requests"] == 5
    with pytest.raises(JudgeError, match="HTTP 503"):
        judge.ask("busy", "s", sleep=lambda _: None)
    assert judge.ask("last", "s").text and judge.ask("after", "s").text
    with pytest.raises(JudgeError, match="ConnectionRefusedError"):
        ChatJudge("http://127.0.0.1:9/chat", "m", attempts=1).ask("x", "s")

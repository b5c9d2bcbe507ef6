import csv
import json
import shutil

import pytest
from makers import docx, para
from pyspark.sql import functions as F

from assayer.operators.validation import Invalid
from assayer.plans import flat, packet
from assayer.sources import bank, download
from assayer.sources.judge import DeterministicJudge, JudgeError, Reply
from assayer.schemas import BANK

PRODUCTS = ["alpha", "beta", "gamma"]
CALLS = "/tmp/assayer-test-calls"


class Scripted(DeterministicJudge):
    """Says MET, and A or B so that the product wins if its text has 'good'; counts calls in a file."""

    def ask(self, prompt, system):
        with open(CALLS, "a") as f:
            f.write("x")
        if "explode" in prompt:
            raise JudgeError("the judge broke")
        if "NOT_MET" in system:
            return Reply("reason\nmet\n" if "good" in prompt.split("[Material]")[1].split("[Condition]")[0] else "NOT_MET", 0.02, "p")
        first, second = prompt.split("[Deliverable B]")
        return Reply("A" if "good" in first.split("[Deliverable A]")[1] else "B" if "good" in second else "TIE", 0.01, "p")


def calls():
    try:
        return len(open(CALLS).read())
    except FileNotFoundError:
        return 0
    finally:
        open(CALLS, "w").close()


def fetch(url, to):
    to.write_bytes(docx(para("expert")) if url.endswith("docx") else b"reference")


def make_tasks(spark, path, prompt="do it"):
    rubric = json.dumps([{"rubric_item_id": "a", "criterion": " is   good ", "score": "3"}, {"rubric_item_id": "b", "criterion": "bad", "score": -1.0}])
    rows = [(f"t{i}", rubric, "clerk", prompt, [f"https://h/{i}.docx"], [f"e/{i}.docx"], ["reference_files/abc/data.txt"], [f"https://h/{i}.txt"]) for i in (1, 2)]
    spark.createDataFrame([*rows, ("t9", None, None, None, [], [], [], [])], BANK).write.mode("overwrite").parquet(str(path / "bank"))
    (path / "ids.txt").write_text("t1\n\n t2 \n")
    return bank.tasks(bank.read_task_ids(spark, str(path / "ids.txt")), bank.read_bank(spark, str(path / "bank"))).cache()


def write_metrics(root, rows):
    with (root / "metrics.csv").open("w", newline="", encoding="utf-8-sig") as f:
        out = csv.writer(f)
        out.writerow(["product", "task", "status", "session", "elapsed_seconds", "tokens", "notes"])
        out.writerows(rows)


def statuses(**by):
    return [(p, t, *by.get(f"{p}{t}", ("pending", "", "", "", ""))) for p in PRODUCTS for t in (1, 2)]


@pytest.fixture(scope="module")
def template(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("template")
    tasks = make_tasks(spark, at)
    packet.prepare(spark, tasks, at / "root", PRODUCTS, at / "dl", fetch)
    return tasks, at


@pytest.fixture
def prepared(template, tmp_path):
    tasks, at = template
    shutil.copytree(at, tmp_path, dirs_exist_ok=True)
    calls()
    return tasks, tmp_path / "root", tmp_path


def test_tasks(spark, tmp_path):
    tasks = make_tasks(spark, tmp_path)
    rows = tasks.orderBy("ordinal").collect()
    assert [(r["ordinal"], r["task_id"]) for r in rows] == [(1, "t1"), (2, "t2")]
    assert [tuple(i) for i in rows[0]["rubric"]] == [("a", "is good", 3), ("b", "bad", -1)]
    assert rows[0]["signature"] != make_tasks(spark, tmp_path, "other").orderBy("ordinal").first()["signature"]
    (tmp_path / "ids.txt").write_text("t1\nmissing\n")
    with pytest.raises(Invalid):
        bank.tasks(bank.read_task_ids(spark, str(tmp_path / "ids.txt")), bank.read_bank(spark, str(tmp_path / "bank")))
    for text in ("", "t1\nt1\n"):
        (tmp_path / "ids.txt").write_text(text)
        with pytest.raises(Invalid):
            bank.read_task_ids(spark, str(tmp_path / "ids.txt"))


def test_prepare_is_idempotent_and_guards(spark, prepared):
    tasks, root, tmp = prepared
    base = root / "alpha/t_01"
    assert sorted(p.name for p in base.iterdir()) == ["START.txt", "output", "prompt.txt", "reference_files"]
    assert (base / "reference_files/data.txt").read_bytes() == b"reference"
    (base / "output/work.docx").write_bytes(b"kept")
    packet.prepare(spark, tasks, root, PRODUCTS, tmp / "dl", lambda u, p: pytest.fail("fetched again"))
    assert (base / "output/work.docx").read_bytes() == b"kept"
    with pytest.raises(Invalid):
        packet.prepare(spark, make_tasks(spark, tmp, "changed"), root, PRODUCTS, tmp / "dl", fetch)
    (base / "prompt.txt").write_text("tampered")
    with pytest.raises(Invalid):
        packet.prepare(spark, tasks, root, PRODUCTS, tmp / "dl", fetch)


def test_the_manifest_is_the_commit(spark, prepared, monkeypatch):
    """A run that ends between writing and the manifest leaves the old manifest and its packets; the next one mends."""
    tasks, root, tmp = prepared
    before = (root / "manifest.json").read_bytes()
    lost = root / "alpha/t_01/reference_files/data.txt"
    lost.unlink()
    nested = root / "beta/t_01/reference_files/abc/data.txt"
    nested.parent.mkdir()
    nested.write_bytes(b"reference")
    with monkeypatch.context() as m:
        m.setattr(packet.records, "write_manifest", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            packet.prepare(spark, tasks, root, PRODUCTS, tmp / "dl", fetch)
    assert (root / "manifest.json").read_bytes() == before and nested.exists() and lost.read_bytes() == b"reference"
    identities = [(r["ordinal"], r["signature"]) for r in tasks.orderBy("ordinal").collect()]
    assert packet.records.read_manifest(spark, root, PRODUCTS, identities).count() == 6
    packet.prepare(spark, tasks, root, PRODUCTS, tmp / "dl", fetch)
    assert not nested.parent.exists() and (root / "manifest.json").read_bytes() == before and not (root / ".staged").exists()
    # a nested attachment with other contents is an error before anything is written
    nested.parent.mkdir()
    nested.write_bytes(b"other")
    lost.unlink()
    with pytest.raises(Invalid, match="changed"):
        packet.prepare(spark, tasks, root, PRODUCTS, tmp / "dl", fetch)
    assert not lost.exists() and nested.exists()


def test_an_address_is_fetched_once(spark, tmp_path):
    """However many ask; a task that is run again fetches only what its first run hasn't moved into place."""
    log, broken = tmp_path / "log", tmp_path / "broken"

    def fetch(url, to):
        with open(log, "a") as f:
            f.write(url + "\n")
        to.write_bytes(b"half")
        if url.endswith("/7") and not broken.exists():
            broken.write_text("")
            raise RuntimeError("the task is lost")
        if url.endswith("/3"):
            raise OSError
        to.write_bytes(url.encode())

    urls = [f"https://h/{i}" for i in range(10)]
    asked = spark.createDataFrame([(u,) for u in urls * 30] + [(None,), ("http://plain/1",)], "url string")
    with pytest.raises(Exception, match="lost"):  # the session of tests has no second try
        download.fetched(asked, tmp_path / "kept", fetch, sleep=lambda _: None, tasks=1)
    first = set(log.read_text().split())
    got = {r["url"]: r for r in download.fetched(asked, tmp_path / "kept", fetch, sleep=lambda _: None, tasks=1).collect()}
    assert sorted(got) == sorted([*urls, "http://plain/1"])
    seen = log.read_text().split()
    assert all(seen.count(u) == 1 for u in urls if u[-1] not in "37") and seen.count(urls[7]) == 2 and "https://h/7" in first
    assert {u: r["error"] for u, r in got.items() if r["error"]} == {urls[3]: "an attachment can't be fetched (OSError)", "http://plain/1": "attachments come over HTTPS"}
    assert all(open(got[u]["full"], "rb").read() == u.encode() for u in urls if u != urls[3])
    # a file of another name in the address's folder is its contents too
    again = download.fetched(asked.where("url = 'https://h/0'"), tmp_path / "kept", lambda u, p: pytest.fail("fetched again")).first()
    assert again["attempts"] == 0


def test_packets_refuse_what_they_must(spark, tmp_path):
    tasks = make_tasks(spark, tmp_path)
    change = lambda name, value: tasks.withColumn(name, F.array(*[F.lit(x) for x in value]))
    for bad in (change("reference_names", ["../x"]), change("reference_names", ["a/x", "b/X"]).withColumn("reference_urls", F.array(F.lit("https://h/1"), F.lit("https://h/2"))), change("reference_urls", []), change("reference_urls", ["ftp://h/1"])):
        with pytest.raises(Invalid):
            packet.prepare(spark, bad, tmp_path / "root", PRODUCTS, tmp_path / "dl", fetch)
    with pytest.raises(Invalid):
        packet.prepare(spark, tasks, tmp_path / "root", ["a/b"], tmp_path / "dl", fetch)
    assert not (tmp_path / "root/manifest.json").exists()
    odd = change("gold_names", ["/x"]).where("ordinal = 1").unionByName(change("gold_urls", []).where("ordinal = 2"))
    odd = odd.withColumn("gold_urls", F.when(F.col("ordinal") == 1, F.array(F.lit("https://h/1.docx"))).otherwise(F.col("gold_urls")))
    assert {r["ordinal"]: r["error"] for r in packet.expert_texts(spark, odd, tmp_path / "e", fetch).collect()} == {1: "a path must be relative and stay in its folder", 2: "names and addresses aren't as many"}


def test_nested_attachments_are_flattened(spark, prepared):
    tasks, root, tmp = prepared
    folder = root / "beta/t_02/reference_files"
    (folder / "abc").mkdir()
    (folder / "abc/data.txt").write_bytes(b"reference")
    packet.prepare(spark, tasks, root, PRODUCTS, tmp / "dl", fetch)
    assert [p.name for p in folder.iterdir()] == ["data.txt"]


def test_full_run(spark, prepared):
    tasks, root, tmp = prepared
    for p, word in (("alpha", "good"), ("beta", "good"), ("gamma", "poor")):
        for t in (1, 2):
            (root / f"{p}/t_{t:02d}/output/answer.docx").write_bytes(docx(para(f"{word} {p}")))
            (root / f"{p}/t_{t:02d}/output/.DS_Store").write_bytes(b"x")
    done = lambda s, *rest: ("completed", s, *rest)
    write_metrics(root, statuses(alpha1=done("s1", "1.5", "10", ""), alpha2=done("s2", "0", "10", ""), beta1=done("s1", "", "", "n"), beta2=done("s2", "", "", ""), gamma1=done("s1", "", "", ""), gamma2=("failed", "s2", "", "", "gave up")))
    experts = packet.expert_texts(spark, tasks, tmp / "experts", fetch).cache()
    assert [(r["expert"], r["error"]) for r in experts.collect()] == [("expert", None)] * 2
    args = (spark, tasks, root, PRODUCTS, Scripted(), tmp / "results")
    board, scores = packet.evaluate(*args, experts=experts)
    # earned 3 - 1 of 3, as both items are met
    assert [(r["rank"], r["product"], r["rubric_total"], r["pairwise_win_rate"]) for r in board] == [(1, "alpha", 6.667, 1.0), (1, "beta", 6.667, 1.0), (3, "gamma", 0.0, 0.25)]
    assert board[0]["tokens_total"] == 20 and board[0]["elapsed_seconds_total"] == 1.5 and board[1]["tokens_total"] is None and board[1]["tokens_recorded"] == 0
    assert [r["status"] for r in scores] == ["graded"] * 5 + ["failed"] and abs(scores[0]["judge_cost_usd"] - 0.05) < 1e-9
    assert scores[5]["rubric_score"] == 0.0 and scores[5]["judge_cost_usd"] == 0.0
    assert calls() == 5 * 3
    again = packet.evaluate(*args, experts=experts)
    assert calls() == 0 and again == (board, scores)
    (root / "alpha/t_01/output/answer.docx").write_bytes(docx(para("good but new")))
    packet.evaluate(*args, experts=experts)
    assert calls() == 3
    folder = next((tmp / "results").iterdir())
    assert (folder / "scores.csv").read_bytes().startswith(b"\xef\xbb\xbf") and "100.0%" in (folder / "report.md").read_text()


def test_row_errors_and_limit(spark, prepared):
    tasks, root, tmp = prepared
    done = ("completed", "s1", "", "", "note")
    write_metrics(root, statuses(alpha1=done, alpha2=("completed", "s2", "", "", ""), beta1=done, beta2=("completed", "s2", "", "", ""), gamma1=done, gamma2=("completed", "s2", "", "", "")))
    (root / "alpha/t_01/output/a.exe").write_bytes(b"x")
    (root / "beta/t_01/output/a.docx").write_bytes(docx(para("explode")))
    (root / "beta/t_02/output/a.docx").write_bytes(docx(para("good")))
    (root / "beta/t_02/prompt.txt").write_text("tampered")
    (root / "gamma/t_01/output/a.docx").write_bytes(docx(""))
    (root / "gamma/t_02/output/link.docx").symlink_to(root / "beta/t_02/output/a.docx")
    board, scores = packet.evaluate(spark, tasks, root, PRODUCTS, Scripted(), tmp / "results", ("rubric",))
    notes = {(r["product"], r["task"]): r["notes"] for r in scores}
    assert {r["status"] for r in scores} == {"error"} and all(r["rubric_score"] is None and r["judge_cost_usd"] is None for r in scores)
    assert "XLSX" in notes["alpha", 1] and notes["alpha", 1].startswith("note；") and "no deliverable" in notes["alpha", 2]
    assert "judge broke" in notes["beta", 1] and "prepared" in notes["beta", 2] and "no text" in notes["gamma", 1] and "link" in notes["gamma", 2]
    assert all(r["rank"] is None and r["status"] == "incomplete" for r in board) and [r["product"] for r in board] == PRODUCTS
    _, scores = packet.evaluate(spark, tasks, root, PRODUCTS, Scripted(), tmp / "results", ("rubric",), limit=1)
    assert [r["status"] for r in scores] == ["error", "not_evaluated"] * 3


@pytest.mark.parametrize(
    "row",
    [("unknown", "s", "", "", ""), ("completed", "", "", "", ""), ("completed", "s", "-1", "", ""), ("completed", "s", "nan", "", ""), ("completed", "s", "inf", "", ""), ("completed", "s", "bad", "", ""),
     ("completed", "s", "", "1.5", ""), ("completed", "s", "", "-1", ""), ("completed", "s", "", "1e309", ""), ("completed", "s", "", "9" * 5000, "")],
)
def test_bad_metrics(spark, prepared, row):
    tasks, root, _ = prepared
    write_metrics(root, statuses(alpha1=row))
    with pytest.raises(Invalid):
        packet.records.read_metrics(spark, root / "metrics.csv", packet._expected(spark, tasks, PRODUCTS))


def test_metrics_keys_and_shape(spark, prepared):
    tasks, root, _ = prepared
    expected = packet._expected(spark, tasks, PRODUCTS)
    good = statuses(alpha1=("completed", "s", "12.5", "100", 'a "quoted"\nnote'), beta1=("running", "s", "0", "0", ""))
    write_metrics(root, good)
    rows = {(r["product"], r["task"]): r for r in packet.records.read_metrics(spark, root / "metrics.csv", expected).collect()}
    assert rows["alpha", 1]["notes"] == 'a "quoted"\nnote' and rows["alpha", 1]["tokens"] == 100 and rows["beta", 1]["elapsed_seconds"] == 0.0 and rows["gamma", 2]["session"] is None
    for bad in (good[1:], [*good, good[0]], [("other", *good[0][1:]), *good[1:]], [("alpha", 0, *good[0][2:]), *good[1:]], statuses(alpha1=("completed", "s", "", "", ""), alpha2=("pending", "s", "", "", "")), [good[0][:-1], *good[1:]], [(*good[0], "more"), *good[1:]]):
        write_metrics(root, bad)
        with pytest.raises(Invalid):
            packet.records.read_metrics(spark, root / "metrics.csv", expected)


def test_flat(spark, tmp_path):
    tasks = make_tasks(spark, tmp_path)
    folder = tmp_path / "flat"
    folder.mkdir()
    (folder / "t01.docx").write_bytes(docx(para("good")))
    calls()
    total, cost = flat.run(spark, tasks, folder, "alpha", "rubric", Scripted(), tmp_path / "r")
    assert round(total, 3) == 3.333 and round(cost, 6) == 0.04 and calls() == 2
    assert flat.run(spark, tasks, folder, "alpha", "rubric", Scripted(), tmp_path / "r") == (total, 0.0) and calls() == 0
    experts = packet.expert_texts(spark, tasks, tmp_path / "e", fetch)
    rate, _ = flat.run(spark, tasks, folder, "alpha", "pairwise", Scripted(), tmp_path / "r", experts=experts)
    assert rate == 0.5
    (folder / "t01.pdf").write_bytes(b"x")
    assert flat.run(spark, tasks, folder, "alpha", "rubric", Scripted(), tmp_path / "r", limit=1)[0] == 0.0

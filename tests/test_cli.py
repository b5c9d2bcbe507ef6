import pytest
from makers import docx, para
from test_packet import make_tasks, statuses, write_metrics

from assayer import cli
from assayer.operators.validation import Invalid
from assayer.plans import packet, reports
from assayer.sources import files, records
from assayer.sources.listing import listed


def test_commands_and_exit_codes(spark, tmp_path, monkeypatch, capsys):
    make_tasks(spark, tmp_path)
    common = ["--bank", str(tmp_path / "bank"), "--ids", str(tmp_path / "ids.txt"), "--root", str(tmp_path / "root"), "--data", str(tmp_path / "data")]
    real = packet.download.fetched
    monkeypatch.setattr(packet.download, "fetched", lambda requests, folder, fetch: real(requests, folder, lambda u, p: p.write_bytes(b"reference")))
    assert cli.main(["prepare", *common, "--products", "alpha, beta,gamma"], spark) == 0
    judged = [*common, "--products", "alpha,beta,gamma", "--mode", "rubric", "--results", str(tmp_path / "results")]
    write_metrics(tmp_path / "root", statuses())
    assert cli.main(["run", *judged], spark) == 0
    (tmp_path / "root/alpha/t_01/output/a.docx").write_bytes(docx(para("work")))
    write_metrics(tmp_path / "root", statuses(alpha1=("completed", "s", "", "", ""), beta1=("completed", "s", "", "", "")))
    assert cli.main(["run", *judged], spark) == 1  # beta has no deliverable
    report = next((tmp_path / "results").glob("*/report.md")).read_text()
    assert "| alpha | 1 | graded |" in report and "| beta | 1 | error | — |" in report
    write_metrics(tmp_path / "root", statuses(alpha1=("lost", "", "", "", "")))
    capsys.readouterr()
    assert cli.main(["run", *judged], spark) == 1
    assert "record 2: lost" in capsys.readouterr().err
    for bad in (["run", *common], ["run", *judged, "--limit", "0"], ["flat", *common, "--product", "a"], ["prepare", *common, "--products", "a,a"], []):
        with pytest.raises(SystemExit):
            cli.main(bad, spark)


def test_paths_and_listing(spark, tmp_path):
    assert files.safe_path(tmp_path, "./a//b.txt") == tmp_path / "a/b.txt"
    for bad in ("", "/a", "../a", "a/../b", "a\\b", "c:a", "./"):
        with pytest.raises(Invalid):
            files.safe_path(tmp_path, bad)
    (tmp_path / "a/._kept").mkdir(parents=True)
    for name in ("a/_x", "a/.y", "a/._kept/z", "a/Thumbs.db", "~$a.docx"):
        (tmp_path / name).write_text("x")
    for splits in (1, 2, 64):
        assert sorted(r["path"] for r in listed(spark, tmp_path, splits=splits).where("kind = 'file'").collect()) == ["a/._kept/z", "a/.y", "a/_x"]
    assert sorted((r["path"], r["kind"]) for r in listed(spark, tmp_path).where("kind <> 'file'").collect()) == [("a", "folder"), ("a/._kept", "folder")]
    assert [r["path"] for r in listed(spark, tmp_path, recursive=False).collect()] == ["a"]
    assert sorted(r["path"] for r in files.plain_files(spark, tmp_path).collect()) == ["a/._kept/z", "a/.y", "a/_x"]
    assert [r["kind"] for r in listed(spark, tmp_path / "none").collect()] == ["unreadable"]
    (tmp_path / "link").symlink_to(tmp_path / "a")
    with pytest.raises(Exception, match="no links"):
        files.plain_files(spark, tmp_path).collect()
    with pytest.raises(Invalid):
        files.safe_path(tmp_path, "link/_x")


def test_listing_in_many_tasks(spark, tmp_path):
    want = set()
    for a in range(7):
        for b in range(a):
            folder = tmp_path / f"f{a}" / f"_g{b}"
            folder.mkdir(parents=True)
            for c in range(3):
                (folder / f"{c}.txt").write_text("x" * c)
                want.add((f"f{a}/_g{b}/{c}.txt", c))
    for splits in (1, 3, 10, 500):
        found = listed(spark, tmp_path, splits=splits)
        assert {(r["path"], r["bytes"]) for r in found.where("kind = 'file'").collect()} == want
        assert found.count() == len(want) + 21 + 7 - 1
        assert found.rdd.getNumPartitions() <= splits


def test_one_deliverable_each(spark, tmp_path):
    for name in ("t01.docx", "t02.a", "t02.b", "t100.x", "t1.x", "t04"):
        (tmp_path / name).write_text("")
    ordinals = spark.createDataFrame([(1,), (2,), (3,), (4,), (100,)], "ordinal int")
    got = {r["ordinal"]: (r["name"], r["error"] is None) for r in files.only_matches(spark, tmp_path, ordinals).collect()}
    assert got == {1: ("t01.docx", True), 2: (None, False), 3: (None, False), 4: (None, False), 100: ("t100.x", True)}


def test_verdicts_of_an_absent_log(spark, tmp_path):
    assert records.read_verdicts(spark, f"file://{tmp_path}/none").isEmpty()


def test_percent():
    assert [reports.percent(x) for x in (None, 0.0025, 1.0)] == ["—", "0.2%", "100.0%"]

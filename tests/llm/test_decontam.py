import random
import subprocess
import sys
from pathlib import Path

import duckdb

from assayer.llm import decontam
from assayer.llm.decontam import WuManber, words

REPO = Path(__file__).resolve().parents[2]
DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def brute(text, items):
    own = words((text or "").encode())
    hit, found = set(), set()
    for item, t in items:
        w = words((t or "").encode())
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            for p in range(len(own) - m + 1):
                if own[p : p + m] == w[i : i + m]:
                    hit |= set(range(p, p + m))
                    found.add(item)
    return len(own), len(hit), found


def cases():
    r = random.Random(3)
    word = lambda: r.choice(["Apple", "berry", "çava", "D4", "eel", "f"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([12, 10, 25, 3, 1, 11, 0])] + [(7, None), (8, "zeta"), (9, "berry berry berry")]
    items.append((2, items[2][1]))
    docs = [(i, " - ".join(word() for _ in range(r.randrange(60)))) for i in range(40)]
    docs += [(50 + i, "lead " + (t or "") + " tail, " + (t or "")) for i, t in items] + [(90, None), (91, ""), (91, "..."), (92, items[0][1].upper())]
    return docs, items


def test_search_finds_every_occurrence():
    docs, items = cases()
    search = WuManber([(i, (t or "").encode()) for i, t in items]).search
    for _, t in docs:
        own = words((t or "").encode())
        spans, found = search(own)
        assert (len(own), sum(z - a for a, z in spans), found) == brute(t, items)


def test_blocks_and_sql_agree(spark):
    docs, items = cases()
    d, i = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)
    one = decontam.contamination_digest(decontam.contamination(d, i)).collect()
    many = decontam.contamination_digest(decontam.contamination(d, i, block_bytes=150)).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, many), key=repr)
    con = duckdb.connect()
    for name, rows, schema in (("documents", docs, "doc_id BIGINT, text VARCHAR"), ("benchmark", items, "item_id BIGINT, text VARCHAR")):
        con.execute(f"CREATE TABLE {name} ({schema})")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    sql = con.execute(decontam.OP4_SQL)
    names = [c[0] for c in sql.description]
    assert sorted(map(repr, sql.fetchall())) == sorted(repr(tuple(r[n] for n in names)) for r in one)


def test_empty_tables_nulls_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "alpha beta", "x"), (None, "alpha", None)], DOC + ", n_words string")
    none = spark.createDataFrame([], ITEM)
    got = decontam.contamination_digest(decontam.contamination(docs, none)).collect()
    assert sorted(r.n_words for r in got) == [1, 2] and not any(r.contaminated for r in got)
    null_id = spark.createDataFrame([(None, "alpha")], ITEM)
    got = decontam.contamination_digest(decontam.contamination(docs, null_id)).collect()
    assert all(r.contaminated and r.n_hit == 1 and r.n_items == 0 for r in got)
    assert decontam.contamination(docs.limit(0), null_id).count() == 0


MEASURED = """
import random, psutil
from assayer.llm.decontam import BLOCK_BYTES, WuManber
r = random.Random(1)
vocabulary = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(2, 9))).encode() for _ in range(200_000)]
items, n = [], 0
while n < BLOCK_BYTES:
    items.append((len(items), b" ".join(r.choice(vocabulary) for _ in range(300))))
    n += len(items[-1][1]) + 16
before = psutil.Process().memory_info().rss
held = WuManber(items)
print((psutil.Process().memory_info().rss - before) >> 20)
"""


def test_tables_of_a_whole_block_are_small():
    got = subprocess.run([sys.executable, "-c", MEASURED], cwd=REPO, capture_output=True, text=True, check=True, timeout=120)
    assert int(got.stdout) < 110


def test_a_block_is_fetched_when_the_pass_before_it_is_written(spark, monkeypatch):
    docs, items = cases()
    log, blocks, keeps = [], decontam.benchmark_blocks, decontam.written

    def told(*own):
        for n, block in blocks(*own):
            log.append("block")
            yield n, block

    monkeypatch.setattr(decontam, "benchmark_blocks", told)
    monkeypatch.setattr(decontam, "written", lambda df: log.append("pass") or keeps(df))
    decontam.contamination(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), block_bytes=100)
    assert log == ["block", "pass"] * (len(log) // 2) and len(log) > 6

import duckdb
import pandas as pd

from assayer.llm import quotes

ROWS = [
    (1, 0, "user", "Hello there.\nHow do I fold a map?"),
    (1, 1, "assistant", "> How do I  FOLD a map?\nAlong the creases.\n\nThen press it."),
    (1, 2, "user", "> > How do I fold a map?\n> Along the creases.\nThat fails."),
    (1, 3, "user", ">> How do I fold a map?\nI mean the first."),
    (1, 4, "assistant", "> nobody wrote this\n>> Then press it.\nOk"),
    (1, 5, "user", "> That fails.\nYes"),
    (1, 5, "user", "> That fails.\nYes"),
    (2, 0, "user", "How do I fold a map?"),
    (2, 1, "assistant", None),
    (2, 2, "user", ""),
    (2, 3, None, ">\n> \nempty quotes"),
    (None, 0, "user", "alone"),
    (None, 1, "user", "> alone\r\n\r\nindeed"),
    (3, None, "user", "> How do I fold a map?\nno turn"),
    (3, 2, "user", "\n".join(f"line {i}" for i in range(3000))),
    (3, 5, "user", "> line 7\n> line 8\nx\n> line 9\ny"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows):
    got = quotes.link_quotes(spark.createDataFrame(rows, SCHEMA))
    return {tuple(got.columns): sorted(map(repr, (tuple(r) for r in got.collect())))}


def test_against_sql(spark):
    con = duckdb.connect()
    frame = pd.DataFrame(ROWS, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", frame)
    sql = con.execute(quotes.OP2_SQL)
    names = [c[0] for c in sql.description]
    want = sorted(map(repr, sql.fetchall()))
    got = quotes.link_quotes(spark.createDataFrame(ROWS, SCHEMA)).select(*names)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == want


def test_links(spark):
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotes(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert got[1, 1].reply_to == 0 and got[1, 1].body == "Along the creases.\n\nThen press it."
    assert got[1, 2].reply_to == 1 and got[1, 2].depth == 2 and got[1, 2].thread == 0 and got[1, 2].n_quotes == 2
    assert got[1, 3].reply_to == 0
    assert got[1, 4].reply_to == 1 and got[1, 4].n_quotes == 2 and got[1, 4].n_linked == 1
    assert got[1, 5].reply_to == 2 and got[1, 5].depth == 3
    assert got[2, 3].reply_to is None and got[2, 3].body == "empty quotes"
    assert got[None, 1].reply_to == 0
    assert got[3, 5].reply_to is None or got[3, 5].reply_to == 2
    assert got[3, 5].n_quotes == 2 and got[3, 5].n_linked == 2 and got[3, 5].reply_to == 2
    order = [r.turn for r in sorted((r for r in quotes.link_quotes(spark.createDataFrame(ROWS, SCHEMA)).collect() if r.conv_id == 1), key=lambda r: r.position)]
    assert order == [0, 1, 3, 2, 4, 5, 5]


def test_empty_and_extra(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quotes.link_quotes(empty).count() == 0
    extra = spark.createDataFrame([(1, 0, "user", "hi", 3, "x")], SCHEMA + ", position int, body string")
    (row,) = quotes.link_quotes(extra).collect()
    assert row.body == "hi" and row.position == 0


def test_runs_between_quotes_and_paragraphs_of_quotes(spark):
    rows = [
        (1, 0, "user", "q1\n\nq2"),
        (1, 1, "assistant", "> q1\nr1a\nr1b\n> q2\nr2a\nr2b"),
        (1, 2, "user", "> r1a\n> r1b\nnot so"),
        (2, 0, "user", "first one\n\nsecond one\n\nthe third"),
        (2, 1, "assistant", "> first one\n>\n> second one\nyes"),
        (2, 2, "assistant", "> nobody's\n>\n> nor this\nno"),
    ]
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1, 2].n_quotes, got[1, 2].n_linked, got[1, 2].reply_to, got[1, 2].thread) == (1, 1, 1, 0)
    assert (got[2, 1].n_quotes, got[2, 1].n_linked, got[2, 1].reply_to) == (1, 1, 0)
    assert (got[2, 2].n_quotes, got[2, 2].n_linked, got[2, 2].reply_to) == (1, 0, None)


def test_consecutive_lines_of_a_longer_paragraph(spark):
    rows = [
        (1, 0, "user", "alpha one\nBeta  two\ngamma three\n\ndelta four"),
        (1, 1, "assistant", "> beta two\n> gamma three\nyes"),
        (1, 2, "user", "> gamma three\n>\n> delta four\n> > beta two\n> > gamma three\nno"),
        (1, 3, "user", "> beta two\n> delta four\nnot consecutive"),
        (1, 4, "user", "> gamma three\n> delta four\n> nothing\nlonger than the rest"),
        (None, 0, "user", "same\nsame\nsame\nend"),
        (None, 1, "user", "> same\n> same\n> end\nx"),
        (2, 0, "user", "> beta two\n> gamma three\nanother conversation"),
        (3, 0, "user", "> later one\n> later two\nx"),
        (3, 1, "user", "before\nlater one\nlater two\nafter"),
    ]
    rows += [(4, t, "user", "hot line\nhot line\n" * 200 + f"own {t}") for t in range(40)] + [(4, 40 + t, "user", f"> hot line\n> own {t}\nlast") for t in range(40)]
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.reply_to) for r in quotes.link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1, 1] == (1, 1, 0) and got[1, 2] == (2, 2, 0)
    assert got[1, 3] == got[1, 4] == (1, 0, None) and got[None, 1] == (1, 1, 0)
    assert got[2, 0] == got[3, 0] == (1, 0, None)
    assert all(got[4, 40 + t] == (1, 1, t) for t in range(40))
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(f"SELECT conv_id, turn, n_quotes, n_linked, reply_to FROM ({quotes.OP2_SQL})").fetchall()
    assert {(c, t): tuple(x) for c, t, *x in want} == got


def test_derived_replies_are_all_linked(spark):
    own = spark.createDataFrame([(c, t, "user", f"line {c} {t}\n\nmore of {c} {t}") for c in range(3) for t in range(6)], SCHEMA)
    got = quotes.link_quotes(quotes.with_quotes(own)).collect()
    assert len(got) == 18
    for r in got:
        assert r.n_quotes == r.n_linked == min(r.turn, 2) and r.reply_to == (r.turn - 1 if r.turn else None) and r.depth == r.turn == r.position
        assert r.body == f"line {r.conv_id} {r.turn}\n\nmore of {r.conv_id} {r.turn}"

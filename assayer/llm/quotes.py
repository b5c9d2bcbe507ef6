r"""Chat formatting by quotation linking, in DataFrame operations only.

A line that begins with one or more ">" (white space between them allowed) is quoted, its level their number.
Consecutive lines of one level are a passage. Passages are normalised (lower case, white space collapsed) and
hashed, and joined to the message of the same conversation that holds them first: as its whole own text, as a
paragraph of it, as a line of it, quotes excluded, or as a run of its lines between quotes. A passage of several lines
that nobody holds so is looked for as just as many consecutive lines of a message, blank lines and quotes left out.
A passage of several paragraphs that isn't found then has the origin of the longest of its paragraphs that has one (of
these, the first's). OP2_SQL knows neither runs between quotes nor paragraphs of quotes: there its links are fewer. A message replies to the message that its outermost
linked passage (of these the longest, then the first) comes from; a message without one starts a thread.

Conversations are rebuilt without quotes in reply order: by thread, by depth in the thread, by turn. `position`
numbers a conversation's messages gaplessly from 0 in that order.

The first holder of a passage is a minimum with partial aggregation, so a passage that stands in very many
messages gives one row, and every quote at most one link. Positions come from one range partitioning of all
messages, which splits a conversation of any length over tasks.

Defined results: a null text is an empty body; a null conv_id is a conversation of its own; null turns come
first and neither reply nor are replied to; messages of one turn are in the order of role and text; repeated
rows stay, each in its place; a passage without any word links to nothing; an empty table gives no rows. Other
columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, written

QUOTED = r"^(?:[ \t]*>)+"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\r\n\f]+", " "))


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _lines(text: Column) -> Column:
    """Lines as structs of level and body."""
    mark = lambda x: F.regexp_extract(x, QUOTED, 0)
    return F.transform(
        F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n"),
        lambda x: F.struct((F.length(mark(x)) - F.length(F.replace(mark(x), F.lit(">")))).alias("level"), F.regexp_replace(x, QUOTED, "").alias("body")),
    )


def body(text: Column) -> Column:
    """A text without its quoted lines, and without white space around what is left."""
    own = F.array_join(F.transform(F.filter(_lines(text), lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    return F.regexp_replace(own, r"^[ \t\r\n\f]+|[ \t\r\n\f]+$", "")


def quoted_passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, mid, at, level, passage): the quoted passages of messages(conv_id, turn, mid, text)."""
    own = messages.where(F.col("text").rlike("(?m)" + QUOTED))
    lines = own.select("conv_id", "turn", "mid", F.posexplode(_lines(F.col("text"))).alias("at", "x")).select("conv_id", "turn", "mid", "at", "x.*")
    message = Window.partitionBy("conv_id", "turn", "mid").orderBy("at")  # the lines of one message
    new = (F.col("level") != F.lag("level", 1, -1).over(message)).cast("int")
    runs = lines.withColumn("new", new).withColumn("run", F.sum("new").over(message)).where("level > 0")
    joined = runs.groupBy("conv_id", "turn", "mid", "run", "level").agg(F.array_sort(F.collect_list(F.struct("at", "body"))).alias("b"))
    text = F.array_join(F.transform("b", lambda x: x["body"]), "\n")
    paragraphs = F.filter(F.transform(F.split(text, r"\n[ \t]*\n"), lambda x: normalised(x)), lambda x: x != "")
    worded = _worded(F.transform("b", lambda x: x["body"]))
    return joined.select(
        "conv_id", "turn", "mid", F.get("b", F.lit(0))["at"].alias("at"), "level", normalised(text).alias("passage"), paragraphs.alias("paragraphs"),
        _hash(F.get(worded, F.lit(0))).alias("first_line"), F.size(worded).alias("n_lines"),
    )


def _worded(lines: Column) -> Column:
    return F.filter(F.transform(lines, normalised), lambda x: x != "")


def lines_holding(messages: DataFrame, lost: DataFrame) -> DataFrame:
    """(c, h, held_by): the hashes of runs of consecutive lines of messages(conv_id, turn, mid, body) that begin as a passage of
    lost(conv_id, first_line, n_lines) does and are as long, and the first turn that holds each.

    A line meets each pair of first line and length once, however many passages share it. The runs of a message are hashed
    beside its body, so no text is carried by its lines.
    """
    wanted = lost.select(F.col("conv_id").alias("wc"), F.col("first_line").alias("wh"), "n_lines").distinct()
    lines = _worded(F.split("body", "\n"))
    known = messages.where("turn is not null")
    each = known.select("conv_id", "turn", "mid", F.posexplode(lines).alias("k", "line")).select("conv_id", "turn", "mid", "k", _hash(F.col("line")).alias("line"))
    met = each.join(wanted, F.col("conv_id").eqNullSafe(F.col("wc")) & (F.col("line") == F.col("wh")))
    starts = met.groupBy(F.col("conv_id").alias("sc"), F.col("turn").alias("st"), F.col("mid").alias("sm")).agg(F.collect_set(F.struct("k", "n_lines")).alias("starts"))
    same = F.col("conv_id").eqNullSafe(F.col("sc")) & (F.col("turn") == F.col("st")) & (F.col("mid") == F.col("sm"))
    listed = known.join(starts, same).select("conv_id", "turn", lines.alias("lines"), "starts")
    run = lambda s: _hash(F.array_join(F.slice("lines", s["k"] + 1, s["n_lines"]), " "))
    runs = F.transform(F.filter("starts", lambda s: s["k"] + s["n_lines"] <= F.size("lines")), run)
    return listed.select("conv_id", "turn", F.explode(runs).alias("h")).groupBy(F.col("conv_id").alias("c"), "h").agg(F.min("turn").alias("held_by"))


def own_runs(text: Column) -> Column:
    """The maximal runs of lines without quotes, as texts."""
    marked = F.transform(_lines(text), lambda x: F.when(x["level"] == 0, x["body"]).otherwise(F.lit("\0")))
    return F.split(F.array_join(marked, "\n"), "\0")


def original_passages(messages: DataFrame) -> DataFrame:
    """(conv_id, hash, origin): of every own passage of messages(conv_id, turn, text, body), the first turn that holds it."""
    runs = F.when(F.col("text").rlike("(?m)" + QUOTED), own_runs(F.col("text"))).otherwise(F.array().cast("array<string>"))
    pieces = F.array_distinct(
        F.transform(F.concat(F.array("body"), F.split("body", r"\n[ \t]*\n"), F.split("body", "\n"), runs, F.flatten(F.transform(runs, lambda x: F.split(x, r"\n[ \t]*\n")))), lambda x: normalised(x))
    )
    each = messages.where("turn is not null").select("conv_id", "turn", F.explode(pieces).alias("p")).where(F.col("p") != "")
    return each.groupBy("conv_id", _hash(F.col("p")).alias("hash")).agg(F.min("turn").alias("origin"))


def _threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth) of turns that reply, from parents(conv_id, turn, parent), by pointer doubling.

    A parent's turn is smaller than its child's, so there are no cycles; each step doubles the distance looked
    back, and a chain of n replies takes about log2(n) steps.
    """
    now = written(parents.select("conv_id", "turn", F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")))
    while True:
        up = now.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("above"), F.col("depth").alias("more"))
        step = now.join(up, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("thread") == F.col("t")), "left")
        moved = written(step.select("conv_id", "turn", F.coalesce("above", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("m")))
        now = moved.drop("m")
        if moved.where("m").isEmpty():
            return now


def link_quotes(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, body, n_quotes, n_linked, reply_to, thread, depth, position and the formatted message."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    messages = conversations.select("conv_id", "turn", "role", text.alias("text"), body(text).alias("body"), F.unhex(F.md5(F.concat(F.coalesce("role", F.lit("")), F.lit("\0"), text).cast("binary"))).alias("mid"))
    # equal rows share an id, and with it their links
    once = messages.dropDuplicates(["conv_id", "turn", "mid"])
    quotes = quoted_passages(once).withColumn("hash", _hash(F.col("passage")))
    origins = original_passages(once).withColumnRenamed("conv_id", "c").withColumnRenamed("hash", "h")
    held = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("hash") == F.col("h")) & (F.col("origin") < F.col("turn"))
    whole = written(quotes.join(origins, held, "left").drop("c", "h"))
    lost = whole.where(F.col("origin").isNull() & (F.col("n_lines") > 1))
    if not lost.isEmpty():
        of_lines = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("hash") == F.col("h")) & (F.col("held_by") < F.col("turn"))
        whole = written(whole.join(lines_holding(once, lost), of_lines, "left").withColumn("origin", F.coalesce("origin", "held_by")).drop("c", "h", "held_by"))
    # the paragraphs of passages that nobody holds whole
    parts = whole.where(F.col("origin").isNull() & (F.size("paragraphs") > 1)).drop("origin", "hash")
    each = parts.select("conv_id", "turn", "mid", "at", F.posexplode("paragraphs").alias("k", "part")).withColumn("hash", _hash(F.col("part")))
    longest = F.min(F.struct(-F.length("part"), "k", "origin"))["origin"]
    of_parts = each.join(origins, held).groupBy("conv_id", "turn", "mid", "at").agg(longest.alias("of_part"))
    names = ["conv_id", "turn", "mid", "at"]
    same_quote = [F.col(x).eqNullSafe(F.col(f"p_{x}")) for x in names]
    found = whole.join(of_parts.select(*[F.col(x).alias(f"p_{x}") for x in names], "of_part"), same_quote, "left").withColumn("origin", F.coalesce("origin", "of_part"))
    best = F.struct("level", -F.length("passage"), "at", "origin")
    links = written(
        found.groupBy("conv_id", "turn", "mid").agg(
            F.count(F.lit(1)).alias("n_quotes"), F.count("origin").alias("n_linked"), F.min(F.when(F.col("origin").isNotNull(), best)).alias("best")
        ).select("conv_id", "turn", "mid", "n_quotes", "n_linked", F.col("best.origin").alias("reply_to"))
    )
    # of several messages of one turn, the first reply stands for the turn where others reply to it
    parents = links.where("reply_to is not null").groupBy("conv_id", "turn").agg(F.min("reply_to").alias("parent"))
    above = _threads(parents).select(F.col("conv_id").alias("tc"), F.col("turn").alias("tt"), "thread", "depth")
    known = links.join(above, F.col("conv_id").eqNullSafe(F.col("tc")) & (F.col("reply_to") == F.col("tt")), "left").select(
        F.col("conv_id").alias("lc"), F.col("turn").alias("lt"), F.col("mid").alias("lm"), "n_quotes", "n_linked", "reply_to",
        F.coalesce("thread", "reply_to").alias("thread"), F.when(F.col("reply_to").isNotNull(), F.coalesce("depth", F.lit(0)) + 1).alias("depth"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("lc")) & F.col("turn").eqNullSafe(F.col("lt")) & (F.col("mid") == F.col("lm"))
    zero = F.lit(0).cast("long")
    placed = messages.join(known, same, "left").select(
        "conv_id", "turn", "role", "text", "body", F.coalesce("n_quotes", zero).alias("n_quotes"), F.coalesce("n_linked", zero).alias("n_linked"),
        "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", zero).alias("depth"),
    )
    return _numbered(placed, ["conv_id"], ["thread", "depth", "turn", "role", "text"]).select(
        "conv_id", "turn", "role", "body", "n_quotes", "n_linked", "reply_to", "thread", "depth", "position",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("body"), F.lit("\n<|end|>\n")).alias("formatted"),
    )


def _numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """rows with position: gapless from 0 in each group, by order. One range partitioning; no group meets in one task."""
    keys = [*group, *order]
    ranged = written(rows.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()))
    held = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = held.select(F.col("__part").alias("p"), F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = Window.partitionBy("__part").orderBy(*keys)
    counted = written(ranged.withColumn("__n", F.row_number().over(within)).join(F.broadcast(before), F.col("__part") == F.col("p")).withColumn("__n", F.col("__n") + F.col("before")).drop("__part", "p", "before"))
    first = counted.groupBy(*group).agg(F.min("__n").alias("first")).select(*[F.col(c).alias(f"__{c}") for c in group], "first")
    on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group]
    return counted.join(first, on).withColumn("position", (F.col("__n") - F.col("first")).cast("long"))


def op2_quotation_linking(spark, sf_dir):
    return link_quotes(table(spark, sf_dir, "conversations"))


def with_quotes(conversations: DataFrame) -> DataFrame:
    """conversations in which each message quotes the two before it, the older one a level deeper, above its own text."""
    turns = Window.partitionBy("conv_id").orderBy("turn")  # a window that looks back two rows holds no group
    quoted = lambda back, mark: F.concat(F.lit(f"{mark} "), F.replace(F.lag("text", back).over(turns), F.lit("\n"), F.lit(f"\n{mark} ")))
    return conversations.select("conv_id", "turn", "role", F.concat_ws("\n", quoted(2, ">>"), quoted(1, ">"), "text").alias("text"))


def op2_quoted_replies(spark, sf_dir):
    """The same operator where every message but the first of a conversation has quotes to link."""
    return link_quotes(with_quotes(table(spark, sf_dir, "conversations")))


_N = r"trim(regexp_replace(lower({}), '[ \t\r\n\f]+', ' ', 'g'))"
OP2_SQL = rf"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS r, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
l AS (SELECT r, conv_id, turn, p AS loc, x, regexp_extract(x, '^(?:[ \t]*>)+') AS k
      FROM (SELECT r, conv_id, turn, w, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x
            FROM (SELECT *, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS w FROM m))),
ll AS (SELECT r, conv_id, turn, loc, length(k) - length(replace(k, '>', '')) AS level, regexp_replace(x, '^(?:[ \t]*>)+', '') AS body FROM l),
b AS (SELECT m.*, regexp_replace(coalesce(o.t, ''), '^[ \t\r\n\f]+|[ \t\r\n\f]+$', '', 'g') AS body
      FROM m LEFT JOIN (SELECT r, string_agg(body, chr(10) ORDER BY loc) AS t FROM ll WHERE level = 0 GROUP BY r) o USING (r)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY r ORDER BY loc) AS run
         FROM (SELECT *, CASE WHEN level = lag(level, 1, -1) OVER (PARTITION BY r ORDER BY loc) THEN 0 ELSE 1 END AS new FROM ll)),
q AS (SELECT r, conv_id, turn, min(loc) AS loc, level, {_N.format("string_agg(body, chr(10) ORDER BY loc)")} AS p,
             count(*) FILTER ({_N.format("body")} <> '') AS m, arg_min({_N.format("body")}, loc) FILTER ({_N.format("body")} <> '') AS head FROM runs WHERE level > 0 GROUP BY r, conv_id, turn, run, level),
pieces AS (SELECT conv_id, turn, {_N.format("x")} AS p
           FROM (SELECT conv_id, turn, unnest(list_concat([body], list_concat(regexp_split_to_array(body, '\n[ \t]*\n'), string_split(body, chr(10))))) AS x FROM b WHERE turn IS NOT NULL)),
o AS (SELECT conv_id, p, min(turn) AS origin FROM pieces WHERE p <> '' GROUP BY conv_id, p),
f0 AS (SELECT q.*, o.origin FROM q LEFT JOIN o ON q.conv_id IS NOT DISTINCT FROM o.conv_id AND q.p = o.p AND o.origin < q.turn),
own AS (SELECT r, conv_id, turn, list_filter(list_transform(string_split(body, chr(10)), lambda x: {_N.format("x")}), lambda x: x <> '') AS xs FROM b WHERE turn IS NOT NULL),
heads AS (SELECT r, conv_id, turn, unnest(range(1, len(xs) + 1)) AS k, unnest(xs) AS x FROM own),
held AS (SELECT f0.r, f0.loc, min(heads.turn) AS held_by FROM f0 JOIN heads ON f0.conv_id IS NOT DISTINCT FROM heads.conv_id AND f0.head = heads.x AND heads.turn < f0.turn
         JOIN own ON own.r = heads.r WHERE f0.origin IS NULL AND f0.m > 1 AND k + m - 1 <= len(xs) AND array_to_string(xs[k : k + m - 1], ' ') = f0.p GROUP BY f0.r, f0.loc),
f AS (SELECT f0.* EXCLUDE (origin), coalesce(origin, held_by) AS origin FROM f0 LEFT JOIN held ON f0.r = held.r AND f0.loc = held.loc),
links AS (SELECT r, count(*) AS n_quotes, count(origin) AS n_linked,
                 arg_min(origin, (level, -length(p), loc)) FILTER (origin IS NOT NULL) AS reply_to FROM f GROUP BY r),
par AS (SELECT conv_id, turn, min(reply_to) AS parent FROM links JOIN m USING (r) WHERE reply_to IS NOT NULL GROUP BY conv_id, turn),
walk AS (SELECT r, conv_id, reply_to AS loc, 1 AS depth FROM links JOIN m USING (r) WHERE reply_to IS NOT NULL
         UNION ALL SELECT walk.r, walk.conv_id, par.parent, depth + 1 FROM walk JOIN par ON walk.conv_id IS NOT DISTINCT FROM par.conv_id AND walk.loc = par.turn),
tops AS (SELECT r, arg_max(loc, depth) AS thread, max(depth) AS depth FROM walk GROUP BY r),
placed AS (SELECT b.conv_id, b.turn, b.role, b.text, b.body, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, reply_to,
                  coalesce(tops.thread, b.turn) AS thread, coalesce(tops.depth, 0) AS depth FROM b LEFT JOIN links USING (r) LEFT JOIN tops USING (r))
SELECT conv_id, turn, role, body, CAST(n_quotes AS BIGINT) AS n_quotes, CAST(n_linked AS BIGINT) AS n_linked, reply_to, thread, CAST(depth AS BIGINT) AS depth,
       row_number() OVER (PARTITION BY conv_id ORDER BY thread NULLS FIRST, depth, turn NULLS FIRST, role NULLS FIRST, text) - 1 AS position,
       '<|' || coalesce(role, '') || '|>' || chr(10) || body || chr(10) || '<|end|>' || chr(10) AS formatted
FROM placed
"""

OP2_QUOTED_SQL = OP2_SQL.replace(
    "FROM conversations)",
    """FROM (SELECT conv_id, turn, role, concat_ws(chr(10), '>> ' || replace(lag(text, 2) OVER t, chr(10), chr(10) || '>> '),
        '> ' || replace(lag(text, 1) OVER t, chr(10), chr(10) || '> '), text) AS text FROM conversations WINDOW t AS (PARTITION BY conv_id ORDER BY turn)))""",
)

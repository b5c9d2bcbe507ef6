"""The operators applied to star-schema tables, each with the SQL that gives the same rows.

A customer stands for a product, an order for a task attempt, a line item for a judged rubric item: an order's
status F is a graded attempt, O a failed one (score 0), P a pending one. `documents`, `events` and
`conversations` stand for deliverables, the verdict log and judges' replies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import digests, numbers, prompts, text, verdicts
from ..operators import bundles, leaderboard, routing, scoring, validation
from ..sources import bank

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- the bound model


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    score = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("bigint")
    return li.select(
        F.col("l_orderkey").alias("task"), score.alias("score"), (F.col("l_linestatus") == "F").alias("met"), F.col("l_tax").cast("decimal(12,4)").alias("cost"),
        F.col("l_returnflag").alias("flag"), (F.col("l_linenumber") % 2 == 1).alias("product_is_a"),
    )


_ITEMS = """items AS (SELECT l_orderkey AS task, CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS score,
    l_linestatus = 'F' AS met, CAST(l_tax AS DECIMAL(12,4)) AS cost, l_returnflag AS flag, l_linenumber % 2 = 1 AS product_is_a FROM lineitem)"""
_SUMS = """sums AS (SELECT task, count(*) AS items, CAST(coalesce(sum(CASE WHEN score > 0 THEN score END), 0) AS BIGINT) AS total,
    CAST(coalesce(sum(CASE WHEN met THEN score END), 0) AS BIGINT) AS earned, sum(cost) AS cost FROM items GROUP BY task)"""
_SCORE = "CASE WHEN total <= 0 THEN 0 ELSE round_even(5 * greatest(0, earned) / total, 6) END"


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product, task, human status and scores of every order, routed and settled."""
    sums = scoring.with_task_score(scoring.item_sums(items(spark, sf_dir), ["task"], cost="cost"))
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "failed").otherwise("pending")
    o = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("product"), F.col("o_orderkey").alias("task"), status.alias("status"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("decimal(18,2)")).alias("elapsed_seconds"), F.lit("").alias("notes"),
    )
    joined = o.join(sums, "task", "left").withColumn("rubric_score", F.coalesce("rubric_score", F.lit(0.0)))
    routed = joined.select(
        "*", routing.route(F.col("status")).alias("route"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("double").alias("pairwise_score"),
        F.coalesce(F.col("cost").cast("double"), F.lit(0.0)).alias("judge_cost_usd"), F.lit("").alias("output_sha256"), F.lit(None).cast("bigint").alias("tokens"),
    )
    return routing.settle(routed, ("rubric",))


_ATTEMPTS = f"""{_ITEMS}, {_SUMS},
attempts AS (SELECT o_custkey AS product, o_orderkey AS task,
    CASE o_orderstatus WHEN 'F' THEN 'graded' WHEN 'O' THEN 'failed' ELSE 'pending' END AS status,
    CASE o_orderstatus WHEN 'F' THEN coalesce({_SCORE}, 0) WHEN 'O' THEN 0 END AS rubric_score,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS elapsed_seconds
    FROM orders LEFT JOIN sums ON o_orderkey = task)"""
_BOARD = f"""{_ATTEMPTS},
board AS (SELECT product, count(*) FILTER (status IN ('graded', 'failed')) AS scored_tasks, count(*) AS total_tasks, sum(rubric_score) AS s,
    count(elapsed_seconds) AS elapsed_seconds_recorded, sum(elapsed_seconds) AS e FROM attempts GROUP BY product)"""


@query(
    "flagship_leaderboard",
    f"""WITH {_BOARD}, r AS (SELECT product, scored_tasks, total_tasks, CASE WHEN scored_tasks = total_tasks THEN round_even(s, 3) END AS rubric_total FROM board)
    SELECT CASE WHEN rubric_total IS NOT NULL THEN rank() OVER (ORDER BY rubric_total DESC NULLS LAST) END AS rank, product,
    CASE WHEN scored_tasks = total_tasks THEN 'complete' ELSE 'incomplete' END AS status, scored_tasks, total_tasks, rubric_total FROM r""",
)
def flagship_leaderboard(spark, sf_dir):
    totals = leaderboard.product_totals(attempts(spark, sf_dir), ("rubric",))
    return leaderboard.competition_ranks(totals, "rubric_total").select("rank", "product", "status", "scored_tasks", "total_tasks", "rubric_total")


# ---------------------------------------------------------------- sources


@query("s1_projected_scan", "SELECT doc_id, lang, source FROM documents")
def s1(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", "lang", "source")


_WS = r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]"
_LINES = rf"list_filter(list_transform(regexp_split_to_array(text, '\r\n|[\n\r\x0b\f\x1c-\x1e\x85\x{{2028}}\x{{2029}}]'), lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '')"


@query("s2_ordered_id_list", rf"SELECT doc_id, unnest(range(1, len(w) + 1)) AS ordinal, unnest(w) AS id FROM (SELECT doc_id, {_LINES} AS w FROM documents)")
def s2(spark, sf_dir):
    return bank.ordered_lines(read(spark, sf_dir, "documents"), ["doc_id"], "text").withColumnRenamed("line", "id").withColumn("ordinal", F.col("ordinal").cast("bigint"))


@query(
    "s3_json_items",
    """SELECT event_id, unnest(['k', 'cut']) AS item_id, unnest([event_type || ' twice', 'b']) AS criterion,
    unnest([CAST(json_extract_string(props, '$.k') AS BIGINT), -2]) AS score FROM events""",
)
def s3(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    item = F.concat(F.lit('[{"rubric_item_id": "k", "criterion": "  '), "event_type", F.lit('  twice ", "score": "'), k, F.lit('"}, {"rubric_item_id": "cut", "criterion": "b", "score": -2.7}]'))
    rubrics = bank.with_rubric(read(spark, sf_dir, "events").select("event_id", item.alias("rubric_json")))
    return bank.task_items(rubrics, ["event_id"])


@query("s9_content_digest", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def s9(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", digests.sha256_hex(F.col("text")).alias("sha256"))


# ---------------------------------------------------------------- projections and predicates


@query("p1_nonblank_lines", rf"SELECT doc_id, len({_LINES}) AS lines FROM documents")
def p1(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(text.nonblank_lines(F.col("text"))).cast("bigint").alias("lines"))


@query("p2_collapsed_white_space", rf"SELECT doc_id, sha256(trim(regexp_replace(text, '{_WS}+', ' ', 'g'))) AS digest FROM documents")
def p2(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", digests.sha256_hex(text.collapse(F.col("text"))).alias("digest"))


@query("p3_positive_scores", f"WITH {_ITEMS} SELECT task, CAST(sum(score) AS BIGINT) AS total FROM items WHERE score > 0 GROUP BY task")
def p3(spark, sf_dir):
    return scoring.item_sums(items(spark, sf_dir), ["task"]).where("total > 0").select("task", "total")


@query("p4_met_scores", f"WITH {_ITEMS} SELECT task, flag, CAST(coalesce(sum(score) FILTER (met), 0) AS BIGINT) AS earned FROM items GROUP BY task, flag")
def p4(spark, sf_dir):
    return scoring.item_sums(items(spark, sf_dir), ["task", "flag"]).select("task", "flag", "earned")


@query("p5_limit_mask", "SELECT o_orderkey AS task, CASE WHEN o_orderkey > 5000 THEN 'not_evaluated' WHEN o_orderstatus = 'O' THEN 'failed' WHEN o_orderstatus = 'F' THEN 'judge' ELSE 'left' END AS route FROM orders")
def p5(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "failed").otherwise("pending")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task"), routing.route(status, F.col("o_orderkey"), 5000).alias("route"))


@query("p6_status_routing", f"WITH {_ATTEMPTS} SELECT product, task, status, rubric_score FROM attempts")
def p6(spark, sf_dir):
    return attempts(spark, sf_dir).select("product", "task", "status", "rubric_score")


@query("p7_suffix_whitelist", r"SELECT page_id, lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/]*$')) LIKE '%.html' AS allowed FROM pages")
def p7(spark, sf_dir):
    path = F.regexp_replace("url", r"[?#].*$", "")
    return read(spark, sf_dir, "pages").select("page_id", F.coalesce(text.suffix(path).isin("html"), F.lit(False)).alias("allowed"))


@query("p8_metadata_exclusion", r"SELECT page_id FROM pages WHERE NOT regexp_matches(split_part(url, '/', -1), '^(\._|~\$)') AND split_part(url, '/', -1) NOT IN ('.DS_Store', 'Thumbs.db')")
def p8(spark, sf_dir):
    return read(spark, sf_dir, "pages").where(~text.is_metadata_file(F.col("url"))).select("page_id")


@query("p9_scored_predicate", f"WITH {_ATTEMPTS} SELECT product, count(*) FILTER (status IN ('graded', 'failed')) AS scored FROM attempts GROUP BY product")
def p9(spark, sf_dir):
    return attempts(spark, sf_dir).groupBy("product").agg(F.count_if(F.col("status").isin("graded", "failed")).alias("scored"))


@query("p10_known_metric", f"WITH {_ATTEMPTS} SELECT product, count(elapsed_seconds) AS known FROM attempts GROUP BY product")
def p10(spark, sf_dir):
    return leaderboard.product_totals(attempts(spark, sf_dir), ("rubric",)).select("product", F.col("elapsed_seconds_recorded").alias("known"))


@query("p11_prefix_filter", "SELECT page_id, url FROM pages WHERE starts_with(url, 'http://the')")
def p11(spark, sf_dir):
    return read(spark, sf_dir, "pages").where(text.under(F.col("url"), "http://the")).select("page_id", "url")


@query("p12_row_merge", f"WITH {_ITEMS}, {_SUMS} SELECT o_orderkey AS task, coalesce(total, 0) AS total, coalesce(earned, 0) AS earned, o_orderstatus AS status FROM orders LEFT JOIN sums ON task = o_orderkey")
def p12(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task"), F.col("o_orderstatus").alias("status"))
    merged = o.join(scoring.item_sums(items(spark, sf_dir), ["task"]), "task", "left")
    return merged.select("task", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("earned", F.lit(0)).alias("earned"), "status")


@query("p15_notes", "SELECT o_orderkey AS task, concat_ws('；', CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, CASE WHEN o_orderstatus = 'F' THEN 'late' END) AS notes FROM orders")
def p15(spark, sf_dir):
    note, reason = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).otherwise(""), F.when(F.col("o_orderstatus") == "F", "late").otherwise("")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task"), text.joined_notes(note, reason).alias("notes"))


# ---------------------------------------------------------------- joins


@query(
    "j1_list_join_bank",
    """SELECT doc_id AS ordinal, CAST(doc_id AS VARCHAR) AS task_id, lang AS occupation, source AS prompt, 'i' AS item_id, lang AS criterion, doc_id AS score
    FROM (SELECT DISTINCT doc_id FROM labels) JOIN documents USING (doc_id)""",
)
def j1(spark, sf_dir):
    none = F.array().cast("array<string>")
    rubric = F.concat(F.lit('[{"rubric_item_id": "i", "criterion": " '), "lang", F.lit(' ", "score": "'), "doc_id", F.lit('"}]'))
    questions = read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("task_id"), rubric.alias("rubric_json"), F.col("lang").alias("occupation"), F.col("source").alias("prompt"),
        *[none.alias(c) for c in ("deliverable_file_urls", "deliverable_files", "reference_files", "reference_file_urls")],
    )
    ids = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("ordinal"), F.col("doc_id").cast("string").alias("task_id")).distinct()
    return bank.task_items(bank.tasks(ids, questions), ["ordinal", "task_id", "occupation", "prompt"])


@query("j2_products_by_tasks", "SELECT r_name AS product, n_nationkey AS task FROM region CROSS JOIN nation")
def j2(spark, sf_dir):
    return bank.packets(read(spark, sf_dir, "region").select(F.col("r_name").alias("product")), read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("task")))


@query("j3_strict_zip", "SELECT c_nationkey AS nation, CAST(row_number() OVER (PARTITION BY c_nationkey, c_mktsegment, c_custkey // 100 ORDER BY c_custkey) - 1 AS INTEGER) AS ordinal, c_name AS name, c_custkey AS url FROM customer")
def j3(spark, sf_dir):
    # the customers of a nation, segment and hundred: short lists, over the whole table
    own = read(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment", F.expr("c_custkey div 100")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))).alias("x"))
    both = own.select(F.transform("x", lambda x: F.struct(F.col("c_nationkey").alias("nation"), x["c_name"].alias("name"))).alias("names"), F.transform("x", lambda x: x["c_custkey"]).alias("urls"))
    return bank.strict_zip(both, "names", "urls").select("left.nation", F.col("ordinal").cast("int").alias("ordinal"), "left.name", F.col("right").alias("url"))


@query("j3_strict_zip_lines", "SELECT l_orderkey AS task, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS INTEGER) AS ordinal, l_linenumber AS line, l_partkey AS part FROM lineitem")
def j3_lines(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("x"))
    both = lines.select(F.transform("x", lambda x: F.struct(F.col("l_orderkey").alias("task"), x["l_linenumber"].alias("line"))).alias("lines"), F.transform("x", lambda x: x["l_partkey"]).alias("parts"))
    return bank.strict_zip(both, "lines", "parts").select("left.task", F.col("ordinal").cast("int").alias("ordinal"), "left.line", F.col("right").alias("part"))


@query("j4_metrics_lookup", "SELECT o_custkey AS product, o_orderkey AS task, c_name AS session FROM orders JOIN customer ON o_custkey = c_custkey")
def j4(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("product"), F.col("c_name").alias("session"))
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("product"), F.col("o_orderkey").alias("task"))
    return bank.with_metrics(o, c, ["product"]).select("product", "task", "session")


@query("j5_cache_misses", "SELECT doc_id AS key FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j5(spark, sf_dir):
    return scoring.unjudged(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("key")), read(spark, sf_dir, "labels").select(F.col("doc_id").alias("key")))


@query("j5_cache_hits", "SELECT d.doc_id AS key, l.quality FROM documents d JOIN labels l USING (doc_id)")
def j5_hits(spark, sf_dir):
    return scoring.reused(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("key")), read(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), "quality"))


@query("j6_task_items", f"WITH {_ITEMS} SELECT task, flag AS item_id, score, met AS criterion FROM items")
def j6(spark, sf_dir):
    # an order's rubric is its lines, a few for each
    item = F.struct(F.col("flag").alias("item_id"), F.col("met").alias("criterion"), "score")
    rubrics = items(spark, sf_dir).groupBy("task").agg(F.collect_list(item).alias("rubric"))
    return bank.task_items(rubrics, ["task"])


@query("j7_changed_files", "SELECT CAST(doc_id AS VARCHAR) AS task, source AS path FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 1")
def j7(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    task, path = F.col("doc_id").cast("string").alias("task"), F.col("source").alias("path")
    recorded = d.select(task, path, digests.sha256_hex(F.col("text")).alias("sha256"))
    # of every third file nothing is left; every fifth has other contents
    now = d.where("doc_id % 3 <> 0").select(task, path, digests.sha256_hex(F.concat("text", F.when(F.col("doc_id") % 5 == 1, "!").otherwise(""))).alias("sha256"))
    return validation.changed_files(recorded, now, ["task"])


@query("j8_rows_of_product", "SELECT o_custkey AS product, count(*) AS rows FROM orders GROUP BY o_custkey")
def j8(spark, sf_dir):
    return leaderboard.product_totals(attempts(spark, sf_dir), ("rubric",)).select("product", F.col("total_tasks").alias("rows"))


_DIFF = "SELECT '{r}: missing' AS rule, CAST(doc_id AS VARCHAR) AS key, NULL AS detail FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT '{r}: unexpected', CAST(doc_id AS VARCHAR), NULL FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)"


@query("j9_u1_set_equality", _DIFF.format(r="labels"))
def j9(spark, sf_dir):
    return validation.set_difference(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels").select("doc_id"), ["doc_id"], "labels")


# ---------------------------------------------------------------- aggregates


@query("a1_a2_item_sums", f"WITH {_ITEMS}, {_SUMS} SELECT task, items, total, earned, cost FROM sums")
def a1(spark, sf_dir):
    return scoring.item_sums(items(spark, sf_dir), ["task"], cost="cost")


@query("a3_task_score", f"WITH {_ITEMS}, {_SUMS} SELECT task, {_SCORE} AS rubric_score FROM sums")
def a3(spark, sf_dir):
    return scoring.with_task_score(scoring.item_sums(items(spark, sf_dir), ["task"])).select("task", "rubric_score")


@query("a4_judge_cost", f"WITH {_ITEMS} SELECT task, sum(cost) AS cost FROM items GROUP BY task")
def a4(spark, sf_dir):
    return scoring.item_sums(items(spark, sf_dir), ["task"], cost="cost").select("task", "cost")


@query("a5_a7_completeness", f"WITH {_BOARD} SELECT product, scored_tasks, total_tasks, CASE WHEN scored_tasks = total_tasks THEN round_even(s, 3) END AS rubric_total FROM board")
def a5(spark, sf_dir):
    return leaderboard.product_totals(attempts(spark, sf_dir), ("rubric",)).select("product", "scored_tasks", "total_tasks", "rubric_total")


@query("a8_win_rate", f"WITH {_ITEMS}, p AS (SELECT task, CASE flag WHEN 'N' THEN 0.5 ELSE CASE WHEN (flag = 'A') = product_is_a THEN 1.0 ELSE 0.0 END END AS s FROM items) SELECT task, round_even(CAST(sum(s) AS DOUBLE) / count(*), 6) AS win_rate FROM p GROUP BY task")
def a8(spark, sf_dir):
    choice = F.when(F.col("flag") == "N", "TIE").when(F.col("flag") == "A", "A").otherwise("B")
    scored = items(spark, sf_dir).select("task", verdicts.pairwise_score(choice, F.col("product_is_a")).alias("s"))
    return scored.groupBy("task").agg(F.bround(F.sum("s") / F.count(F.lit(1)), 6).alias("win_rate"))


@query("a9_metric_totals", f"WITH {_BOARD} SELECT product, elapsed_seconds_recorded, CASE WHEN elapsed_seconds_recorded = total_tasks THEN e END AS elapsed_seconds_total FROM board")
def a9(spark, sf_dir):
    return leaderboard.product_totals(attempts(spark, sf_dir), ("rubric",)).select("product", "elapsed_seconds_recorded", "elapsed_seconds_total")


@query("a10_ordered_bundle", "SELECT conv_id, sha256(string_agg('[文件 ' || p || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY p)) AS digest FROM (SELECT conv_id, text, printf('%04d', turn) || '/' || role AS p FROM conversations) GROUP BY conv_id")
def a10(spark, sf_dir):
    files = read(spark, sf_dir, "conversations").select("conv_id", F.format_string("%04d/%s", "turn", "role").alias("path"), "text")
    return bundles.bundle(files, ["conv_id"]).select("conv_id", digests.sha256_hex(F.col("bundle")).alias("digest"))


@query(
    "a11_output_digest",
    """WITH f AS (SELECT conv_id, printf('%04d', turn) AS p, sha256(text) AS h FROM conversations),
    m AS (SELECT conv_id, '{' || string_agg('"' || p || '": "' || h || '"', ', ' ORDER BY p) || '}' AS files FROM f GROUP BY conv_id)
    SELECT conv_id, sha256('[' || files || ']') AS digest, files FROM m""",
)
def a11(spark, sf_dir):
    files = read(spark, sf_dir, "conversations").select("conv_id", F.format_string("%04d", "turn").alias("path"), F.sha2("text", 256).alias("sha256"))
    return bundles.files_digest(files, ["conv_id"])


@query("a12_flat_totals", f"WITH {_ITEMS}, {_SUMS}, t AS (SELECT o_custkey AS product, CAST(CASE WHEN coalesce(total, 0) <= 0 THEN 0 ELSE round_even(5 * greatest(0, earned) / total, 3) END AS DECIMAL(18,3)) AS s FROM orders LEFT JOIN sums ON task = o_orderkey) SELECT product, sum(s) AS total, count(*) * 5 AS most FROM t GROUP BY product")
def a12(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("product"), F.col("o_orderkey").alias("task"))
    joined = o.join(scoring.item_sums(items(spark, sf_dir), ["task"]), "task", "left").na.fill(0, ["total", "earned"])
    return scoring.flat_totals(scoring.with_task_score(joined, 3, "s").withColumn("task_score", F.col("s").cast("decimal(18,3)")))


@query("a13_flat_win_rate", "SELECT c_custkey AS product, round_even(coalesce(avg(CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 0.5 ELSE 0.0 END), 0.0), 6) AS win_rate FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def a13(spark, sf_dir):
    s = F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "O", 0.5)
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("product"), s.alias("s"))
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("product")).join(o, "product", "left").groupBy("product").agg(F.bround(scoring.win_rate(F.col("s")), 6).alias("win_rate"))


@query("a14_distinctness", "SELECT 'texts are distinct' AS rule, sha256(text) AS key, CAST(count(*) AS VARCHAR) AS detail FROM documents GROUP BY text HAVING count(*) > 1")
def a14(spark, sf_dir):
    return validation.repeated(read(spark, sf_dir, "documents"), "texts are distinct", F.sha2("text", 256))


@query("a15_any_error", "SELECT o_custkey AS product, bool_or(o_orderstatus = 'P') AS failed FROM orders GROUP BY o_custkey")
def a15(spark, sf_dir):
    return leaderboard.any_error(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("product"), F.col("o_orderstatus").alias("status")), ["product"], error="P")


@query("a16_cell_limit", "SELECT l_orderkey AS book, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 7")
def a16(spark, sf_dir):
    return bundles.over_count(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("book")), ["book"], 7)


@query("a17_s6_last_record", "SELECT user_id || ':' || event_type AS key, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def a17(spark, sf_dir):
    log = read(spark, sf_dir, "events").select(F.concat_ws(":", "user_id", "event_type").alias("key"), "ts", "event_id", "value")
    return scoring.latest_records(log, "key", ["ts", "event_id"]).select("key", "event_id", "value")


# ---------------------------------------------------------------- windows, sorts, sets


@query("w1_competition_rank", f"WITH {_BOARD}, r AS (SELECT product, CASE WHEN scored_tasks = total_tasks THEN round_even(s, 3) END AS t FROM board) SELECT product, rank() OVER (ORDER BY t DESC) AS rank FROM r WHERE t IS NOT NULL")
def w1(spark, sf_dir):
    totals = leaderboard.product_totals(attempts(spark, sf_dir), ("rubric",))
    return leaderboard.competition_ranks(totals.where("rubric_total is not null"), "rubric_total").select("product", "rank")


@query("w2_row_numbers", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ordinal FROM conversations")
def w2(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).alias("ordinal"))


@query("w4_running_cutoff", "SELECT conv_id, turn FROM (SELECT conv_id, turn, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM conversations) WHERE b <= 1000")
def w4(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").withColumn("kept", bundles.kept_before_cap(F.length("text"), ["conv_id"], ["turn"], 1000))
    return c.where("kept").select("conv_id", "turn")


@query("w5_session_reuse", "SELECT 'a session belongs to one row' AS rule, o_custkey || '/' || strftime(o_orderdate, '%Y-%m-%d') AS key, CAST(count(*) AS VARCHAR) AS detail FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1")
def w5(spark, sf_dir):
    return validation.repeated(read(spark, sf_dir, "orders"), "a session belongs to one row", F.col("o_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("o1_leaderboard_order", f"WITH {_BOARD}, r AS (SELECT product, CASE WHEN scored_tasks = total_tasks THEN round_even(s, 3) END AS t FROM board) SELECT product, t AS rubric_total FROM r ORDER BY t DESC NULLS LAST, product")
def o1(spark, sf_dir):
    return leaderboard.product_totals(attempts(spark, sf_dir), ("rubric",)).select("product", "rubric_total").orderBy(F.col("rubric_total").desc_nulls_last(), "product")


@query("o2_path_order", "SELECT page_id, url, len(string_split(url, '/')) AS depth FROM pages ORDER BY string_split(url, '/')")
def o2(spark, sf_dir):
    return read(spark, sf_dir, "pages").orderBy(text.path_key(F.col("url"))).select("page_id", "url", F.size(text.path_key(F.col("url"))).cast("bigint").alias("depth"))


@query("o5_prefix_limit", "SELECT o_orderkey AS task FROM orders WHERE o_orderkey <= 20")
def o5(spark, sf_dir):
    return bank.first_tasks(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task")), 20, "task")


#: Rows of a partition in which a table's keys are compared.
PART_ROWS = 1 << 21
_PATHS = "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '/' || l_linenumber AS key FROM lineitem WHERE l_linestatus = '{s}'"


@query(
    "u2_attachment_sets",
    f"""WITH f AS ({_PATHS.format(s="F")}), o AS ({_PATHS.format(s="O")})
    SELECT 'attachments: missing' AS rule, key, NULL AS detail FROM (SELECT key FROM f EXCEPT SELECT key FROM o)
    UNION ALL SELECT 'attachments: unexpected', key, NULL FROM (SELECT key FROM o EXCEPT SELECT key FROM f)""",
)
def u2(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    # the count is read from the files' footers; a task holds PART_ROWS keys or so, however many there are
    parts = max(spark.sparkContext.defaultParallelism, lines.count() // PART_ROWS + 1)
    paths = lambda s: lines.where(F.col("l_linestatus") == s).select("l_orderkey", "l_linenumber")
    return validation.set_difference(paths("F"), paths("O"), ["l_orderkey", "l_linenumber"], "attachments", once=True, parts=parts)


@query("u5_product_rows", "SELECT o_orderkey AS task, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def u5(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task"), F.col("o_orderstatus").alias("status"))
    return o.where("status = 'F'").unionByName(o.where("status = 'O'"))


# ---------------------------------------------------------------- functions


@query("f2_f4_cache_key", """SELECT item_id, sha256('["' || item_id || '", "m", "rubric", {"only": ["p"]}, "x", "é \\\\ \\"", [' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ', ' || length(text) || ']]') AS key FROM benchmark""")
def f4(spark, sf_dir):
    key = digests.cache_key(F.col("item_id").cast("string"), "m", "rubric", {"only": ["p"]}, ("x", 'é \\ "'), digests.json_text(F.col("text")), digests.json_whole(F.length("text")))
    return read(spark, sf_dir, "benchmark").select("item_id", key.alias("key"))


_REPLY = "CASE turn % 4 WHEN 0 THEN text || chr(10) || 'met ' WHEN 1 THEN text || chr(10) || ' NOT_MET' || chr(10) WHEN 2 THEN text || ' MET' ELSE 'TIE' END"


def _replies(spark, sf_dir):
    nl, k = F.lit("\n"), F.col("turn") % 4
    reply = F.when(k == 0, F.concat("text", nl, F.lit("met "))).when(k == 1, F.concat("text", nl, F.lit(" NOT_MET"), nl)).when(k == 2, F.concat("text", F.lit(" MET"))).otherwise("TIE")
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", reply.alias("reply"))


@query("f5_rubric_verdict", "SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN TRUE END AS met FROM conversations")
def f5(spark, sf_dir):
    # " NOT_MET" keeps its leading blank, so it isn't a verdict
    return _replies(spark, sf_dir).select("conv_id", "turn", verdicts.rubric_met(F.col("reply")).alias("met"))


@query("f6_f7_pairwise_score", "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN CASE WHEN turn % 2 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE CASE WHEN turn % 2 = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END END AS score FROM conversations")
def f6(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    k = F.col("turn") % 3
    choice = verdicts.pairwise_choice(F.concat("text", F.lit("\n"), F.when(k == 0, "tie").when(k == 1, "a").otherwise("b")))
    return c.select("conv_id", "turn", verdicts.pairwise_score(choice, F.col("turn") % 2 == 0).alias("score"))


@query("f8_coin", "SELECT doc_id, instr('01234567', sha256(text)[1]) > 0 AS product_is_a FROM documents")
def f8(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", digests.coin(F.sha2("text", 256)).alias("product_is_a"))


@query("f9_safe_path", r"SELECT page_id, url <> '' AND NOT starts_with(url, '/') AND NOT contains(url, ':') AND NOT contains(url, '\') AND NOT list_contains(string_split(url, '/'), '..') AS safe FROM pages")
def f9(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.is_safe_path(F.col("url")).alias("safe"))


@query("f11_f12_folded_basename", "SELECT page_id, lower(split_part(url, '/', -1)) AS name FROM pages")
def f11(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.folded(text.basename(F.col("url"))).alias("name"))


@query("f12_folded_texts", "SELECT doc_id, sha256(replace(lower(text), 'ß', 'ss')) AS folded FROM documents UNION ALL SELECT -doc_id - 1, sha256(replace(lower(upper(text)), 'ß', 'ss')) FROM documents")
def f12(spark, sf_dir):
    """The whole texts of four languages, and the same in upper case."""
    docs = read(spark, sf_dir, "documents")
    every = docs.select("doc_id", "text").union(docs.select(-F.col("doc_id") - 1, F.upper("text")))
    return every.select("doc_id", F.sha2(text.folded(F.col("text")), 256).alias("folded"))


@query("f13_padded_names", "SELECT o_orderkey AS task, printf('t_%02d', o_orderkey) AS packet, printf('t%02d', o_orderkey) AS deliverable FROM orders")
def f13(spark, sf_dir):
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(key.alias("task"), text.packet_name(key).alias("packet"), text.deliverable_name(key).alias("deliverable"))


@query("f14_f16_f17_metric_values", r"SELECT o_orderkey AS task, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS elapsed, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS tokens FROM orders")
def f16(spark, sf_dir):
    k = F.col("o_orderkey")
    seconds = text.strip(F.concat(F.lit(" "), F.when(k % 5 == 0, "nan").otherwise(F.col("o_totalprice").cast("string")), F.lit("\t")))
    tokens = F.concat(F.when(k % 3 == 0, "-").otherwise(""), F.col("o_custkey").cast("string"))
    return read(spark, sf_dir, "orders").select(k.alias("task"), numbers.parse_seconds(seconds).alias("elapsed"), numbers.parse_tokens(tokens).cast("bigint").alias("tokens"))


@query("f15_ordinals", "SELECT o_orderkey AS task, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS ordinal FROM orders")
def f15(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task"), numbers.parse_ordinal(F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("+0"), k)).otherwise(F.concat(k, F.lit("x")))).alias("ordinal"))


@query("f18_f19_caps", "SELECT doc_id, length(substr(text, 1, 1000)) AS kept, length(text) >= 1000 AS full, length(text) > 1000 AS over FROM documents")
def f18(spark, sf_dir):
    t = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", F.length(text.cut(t, 1000)).cast("bigint").alias("kept"), text.reaches(t, 1000).alias("full"), (F.length(t) > 1000).alias("over"))


@query("f20_blank_texts", rf"SELECT doc_id, text IS NULL OR regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g') = '' AS blank FROM documents")
def f20(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.is_blank(F.col("text")).alias("blank"))


@query("f21_prompt", "SELECT item_id, sha256('[Task]' || chr(10) || text || chr(10) || chr(10) || '[Reference material, evidence only]' || chr(10) || chr(10) || chr(10) || '[Material]' || chr(10) || 'doc' || chr(10) || chr(10) || '[Condition]' || chr(10) || 'c' || chr(10) || chr(10) || 'Does the condition hold for the material?') AS digest FROM benchmark")
def f21(spark, sf_dir):
    p = prompts.rubric_prompt(F.col("text"), F.lit(None).cast("string"), F.lit("doc"), F.lit("c"))
    return read(spark, sf_dir, "benchmark").select("item_id", digests.sha256_hex(p).alias("digest"))


@query("f21_pairwise_prompt", "SELECT item_id, sha256('[Task]' || chr(10) || 't' || chr(10) || chr(10) || '[Reference material, evidence only]' || chr(10) || 'r' || chr(10) || chr(10) || '[Deliverable A]' || chr(10) || CASE WHEN item_id % 2 = 0 THEN text ELSE 'gold' END || chr(10) || chr(10) || '[Deliverable B]' || chr(10) || CASE WHEN item_id % 2 = 0 THEN 'gold' ELSE text END || chr(10) || chr(10) || 'Which is better as a whole?') AS digest FROM benchmark")
def f21_pairwise(spark, sf_dir):
    p = prompts.pairwise_prompt(F.lit("t"), F.lit("r"), F.col("text"), F.lit("gold"), F.col("item_id") % 2 == 0)
    return read(spark, sf_dir, "benchmark").select("item_id", digests.sha256_hex(p).alias("digest"))


def _form(x: str) -> str:
    return f"CAST(to_json({x}) AS VARCHAR)"


@query(
    "f3_task_signature",
    f"""SELECT p_partkey AS ordinal, sha256('[{{"gold_names": [], "gold_urls": [' || {_form("p_name")} || '], "occupation": ' || {_form("p_brand")} || ', "ordinal": ' || p_partkey
    || ', "prompt": ' || {_form("p_type")} || ', "reference_names": [' || {_form("p_type")} || ', ' || {_form("p_brand")} || '], "reference_urls": null, "rubric": [{{"criterion": '
    || {_form("p_brand")} || ', "item_id": "i", "score": ' || p_size || '}}], "task_id": ' || {_form("p_name")} || '}}]') AS signature FROM part""",
)
def f3(spark, sf_dir):
    item = F.struct(F.lit("i").alias("item_id"), F.col("p_brand").alias("criterion"), F.col("p_size").alias("score"))
    tasks = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ordinal"), F.col("p_name").alias("task_id"), F.col("p_brand").alias("occupation"), F.col("p_type").alias("prompt"),
        F.array(item).alias("rubric"), F.array("p_name").alias("gold_urls"), F.array().cast("array<string>").alias("gold_names"),
        F.array("p_type", "p_brand").alias("reference_names"), F.lit(None).cast("array<string>").alias("reference_urls"),
    )
    return tasks.select("ordinal", digests.task_signature().alias("signature"))


@query(
    "f23_exact_halves",
    """SELECT l_orderkey, l_linenumber, k / 8.0::DOUBLE AS value, CASE WHEN (k * 25) % 2 = 0 THEN k * 25 // 2 WHEN (k * 25 // 2) % 2 = 0 THEN k * 25 // 2 ELSE k * 25 // 2 + 1 END / 100.0::DOUBLE AS rounded
    FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) * 1000 + l_linenumber + l_orderkey * 8 AS k FROM lineitem)""",
)
def f23(spark, sf_dir):
    """Eighths, which binary numbers hold exactly: half of the odd ones lie in the middle between two hundredths."""
    k = F.col("l_quantity").cast("bigint") * 1000 + F.col("l_linenumber") + F.col("l_orderkey") * 8
    value = k.cast("double") / 8
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", value.alias("value"), numbers.round_exact(value, 2).alias("rounded"))


@query("f24_https_urls", "SELECT page_id, starts_with(lower(url), 'https://') AND length(url) > 8 AS https FROM pages")
def f24(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.is_https(F.col("url")).alias("https"))


# ---------------------------------------------------------------- validation


@query("v3_contiguous_ordinals", "SELECT 'ordinals must be 1..N' AS rule, 'tasks' AS key, CAST(count(*) AS VARCHAR) AS detail FROM nation")
def v3(spark, sf_dir):
    return validation.not_contiguous(read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ordinal")))


@query("v5_attachment_collisions", "SELECT 'attachments of a task need different names' AS rule, lang || '/' || source AS key, CAST(count(*) AS VARCHAR) AS detail FROM documents GROUP BY lang, source HAVING count(*) > 1")
def v5(spark, sf_dir):
    names = read(spark, sf_dir, "documents").select(F.col("lang").alias("ordinal"), F.concat(F.lit("a/"), F.upper("source")).alias("name"))
    return validation.attachment_collisions(names)


@query("v1_id_list", "SELECT 'task ids are distinct' AS rule, source AS key, CAST(count(*) AS VARCHAR) AS detail FROM documents GROUP BY source HAVING count(*) > 1")
def v1(spark, sf_dir):
    return bank.id_violations(read(spark, sf_dir, "documents").select(F.col("source").alias("task_id")))


@query("v2_listed_ids", "SELECT 'every listed task is in the bank' AS rule, CAST(doc_id AS VARCHAR) AS key, NULL AS detail FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def v2(spark, sf_dir):
    ids = lambda name: read(spark, sf_dir, name).select(F.col("doc_id").cast("string").alias("task_id"))
    return bank.unlisted(ids("documents"), ids("labels"))


@query("v6_covered_inputs", "SELECT 'an input of a task lies over another' AS rule, l_orderkey || '/reference_files/' || l_linenumber AS key, CAST(count(*) AS VARCHAR) AS detail FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def v6(spark, sf_dir):
    return validation.covered_inputs(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ordinal"), F.concat(F.lit("reference_files/"), F.col("l_linenumber").cast("string")).alias("path")))


@query(
    "v11_text_limits",
    rf"""WITH c AS (SELECT *, '[文件 ' || printf('%04d', turn) || ']' || chr(10) || text AS chunk,
        CASE WHEN text IS NULL OR regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g') = '' THEN 'a file has no text' WHEN length(text) >= 400 THEN 'a file''s text reaches the limit' END AS wrong FROM conversations)
    SELECT conv_id, coalesce(arg_min(wrong, turn) FILTER (wrong IS NOT NULL), CASE WHEN sum(length(chunk)) + 2 * (count(*) - 1) > 400 THEN 'the files'' text exceeds the limit' END) AS error FROM c GROUP BY conv_id""",
)
def v11(spark, sf_dir):
    files = read(spark, sf_dir, "conversations").select("conv_id", F.format_string("%04d", "turn").alias("path"), "text")
    return bundles.bundle(files, ["conv_id"], max_chars=400).select("conv_id", "error")


@query(
    "v8_metrics_rules",
    """WITH m AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'lost' END AS status,
        strftime(o_orderdate, '%Y-%m-%d') AS session FROM orders)
    SELECT 'status must be known' AS rule, o_custkey || '/' || o_orderkey AS key, status AS detail FROM m WHERE status = 'lost'
    UNION ALL SELECT 'elapsed_seconds must be finite and at least 0', o_custkey || '/' || o_orderkey, '-1' FROM m WHERE o_orderkey % 50 = 0
    UNION ALL SELECT 'tokens must be digits', o_custkey || '/' || o_orderkey, '1.5' FROM m WHERE o_orderkey % 70 = 0
    UNION ALL SELECT 'rows: unexpected', o_custkey || '/' || o_orderkey, NULL FROM m WHERE o_orderkey % 90 = 0
    UNION ALL SELECT 'a session belongs to one row', o_custkey || '/' || session, CAST(count(*) AS VARCHAR) FROM m GROUP BY o_custkey, session HAVING count(*) > 1""",
)
def v8(spark, sf_dir):
    o, k = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    staged = o.select(
        F.col("o_custkey").cast("string").alias("product"), k.cast("string").alias("task"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "failed").otherwise("lost").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("session"), F.when(k % 50 == 0, "-1").otherwise("2.5").alias("elapsed_seconds"),
        F.when(k % 70 == 0, "1.5").otherwise("").alias("tokens"), F.lit("").alias("notes"),
    )
    expected = o.where(k % 90 != 0).select(F.col("o_custkey").cast("string").alias("product"), k.alias("task"))
    return validation.metrics_violations(staged, expected)

"""The operators on files and judges, applied to folders made from the star schema's dimensions, and what a written and
re-read folder must hold, in SQL.

Regions stand for products and nations for tasks; customers for files, addresses and requests to the judge. Folders lie in the shared
folder, which must be one that the driver's file system shows.
"""

from __future__ import annotations

import io
import json
import urllib.error
import uuid
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.digests import task_signature
from ..functions.prompts import RUBRIC_SYSTEM
from ..functions.text import deliverable_name, packet_name
from ..operators.validation import Invalid
from ..sources import bank, download, files, office, records, verdict_log
from ..sources.judge import ChatJudge, DeterministicJudge, Reply, ask_all
from ..sources.listing import listed
from ..sources.shared import materialised, shared_base
from . import judging, packet, reports
from .bound import query, read

_QUOTED = lambda text: "'" + text.replace("'", "''") + "'"


def workspace(spark: SparkSession) -> Path:
    path = Path(shared_base(spark).removeprefix("file://").removeprefix("file:")) / f"folder-{uuid.uuid4().hex}"
    path.mkdir(parents=True)
    return path


def products(spark: SparkSession, sf_dir: str) -> list[str]:
    return [r["r_name"] for r in read(spark, sf_dir, "region").orderBy("r_regionkey").collect()]


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task a nation, with one attachment."""
    name, none = F.col("n_name"), F.array().cast("array<string>")
    rows = read(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).alias("ordinal"), name.alias("task_id"), F.lit("clerk").alias("occupation"), F.concat(F.lit("Write about "), name).alias("prompt"),
        F.array(F.struct(F.lit("i").alias("item_id"), F.lit("c").alias("criterion"), F.lit(1).cast("bigint").alias("score"))).alias("rubric"),
        none.alias("gold_urls"), none.alias("gold_names"), F.array(F.concat(F.lit("reference_files/deep/"), name, F.lit(".txt"))).alias("reference_names"),
        F.array(F.concat(F.lit("https://h/"), name)).alias("reference_urls"),
    )
    return rows.withColumn("signature", task_signature())


def _fetched(url: str, to: Path) -> None:
    to.write_bytes(url.encode())


def _unreachable(url: str, to: Path) -> None:
    raise AssertionError("what is there isn't fetched again")


def prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Path, list[str]]:
    own, at, names = tasks(spark, sf_dir), workspace(spark), products(spark, sf_dir)
    packet.prepare(spark, own, at / "packets", names, at / "downloads", _fetched)
    return own, at / "packets", names


def packed(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with ZipFile(out, "w") as package:
        for name, xml in parts.items():
            package.writestr(name, xml)
    return out.getvalue()


def _named(prefix: str, space: str) -> str:
    return f'xmlns:{prefix}="{space.strip("{}")}"'


def docx(lines: list[str], row: list[str] = ()) -> bytes:
    p = lambda x: f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>"
    grid = "<w:tbl><w:tr>" + "".join(f"<w:tc>{p(x)}</w:tc>" for x in row) + "</w:tr></w:tbl>" if row else ""
    return packed({"word/document.xml": f"<w:document {_named('w', office.W)}><w:body>{''.join(map(p, lines))}{grid}</w:body></w:document>"})


def _linked(main: str, folder: str, root: str, parts: list[str], refer: str, names: str) -> dict[str, str]:
    """An office package whose main part refers to numbered parts by relationships."""
    links = "".join(f'<Relationship Id="r{i}" Target="{folder}/{i}.xml"/>' for i in range(len(parts)))
    at, name = main.rsplit("/", 1)
    body = "".join(refer.format(i=i) for i in range(len(parts)))
    return {main: f"<{root} {names}>{body}</{root}>", f"{at}/_rels/{name}.rels": f"<Relationships>{links}</Relationships>"} | {f"{at}/{folder}/{i}.xml": x for i, x in enumerate(parts)}


def xlsx(sheet: str, values: list[str]) -> bytes:
    rows = "".join(f'<x:row><x:c r="A{i}" t="inlineStr"><x:is><x:t>{v}</x:t></x:is></x:c></x:row>' for i, v in enumerate(values, 1))
    part = f"<x:worksheet {_named('x', office.X)}><x:sheetData>{rows}</x:sheetData></x:worksheet>"
    names = f"{_named('x', office.X)} {_named('r', office.R)}"
    return packed(_linked("xl/workbook.xml", "sheets", "x:workbook", [part], f'<x:sheet name="{sheet}" r:id="r{{i}}"/>', names))


def pptx(slides: list[str]) -> bytes:
    spaces = f"{_named('p', office.P)} {_named('a', office.A)}"
    parts = [f"<p:sld {spaces}><p:cSld><p:spTree><p:sp><p:txBody><a:p><a:r><a:t>{x}</a:t></a:r></a:p></p:txBody></p:sp></p:spTree></p:cSld></p:sld>" for x in slides]
    return packed(_linked("ppt/presentation.xml", "slides", "p:presentation", parts, '<p:sldId r:id="r{i}"/>', f"{_named('p', office.P)} {_named('r', office.R)}"))


# ---------------------------------------------------------------- records


@query("s4_manifest", "SELECT n_nationkey + 1 AS ordinal, 'prompt.txt' AS path, sha256(n_name) AS sha256 FROM nation")
def s4(spark, sf_dir):
    root, names = workspace(spark), products(spark, sf_dir)
    rows = read(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).alias("ordinal"), "n_name", F.sha2("n_name", 256).alias("h")).orderBy("ordinal").collect()
    records.write_manifest(root, names, [{"ordinal": r["ordinal"], "signature": r["n_name"], "files": {"prompt.txt": r["h"]}} for r in rows])
    return records.read_manifest(spark, root, names, [(r["ordinal"], r["n_name"]) for r in rows])


@query(
    "s5_metrics_file",
    """SELECT r_name AS product, CAST(n_nationkey + 1 AS BIGINT) AS task, CASE n_nationkey % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'failed' ELSE 'pending' END AS status,
    r_name || '-' || n_nationkey AS session, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 1.5 END AS elapsed_seconds,
    CAST(n_nationkey * 10 AS DECIMAL(38,0)) AS tokens, 'a "quoted", ' || chr(10) || n_name AS notes FROM region CROSS JOIN nation""",
)
def s5(spark, sf_dir):
    k = F.col("n_nationkey")
    text = lambda *x: F.concat(*[c if not isinstance(c, str) else F.lit(c) for c in x])
    rows = bank.packets(read(spark, sf_dir, "region").select(F.col("r_name").alias("product")), read(spark, sf_dir, "nation")).select(
        "product", (k + 1).cast("string").alias("task"), F.when(k % 3 == 0, " completed").when(k % 3 == 1, "failed").otherwise("pending ").alias("status"),
        text(F.col("product"), "-", k.cast("string")).alias("session"), F.when(k % 2 == 0, (k * 1.5).cast("string")).otherwise("").alias("elapsed_seconds"),
        (k * 10).cast("string").alias("tokens"), text('a "quoted", \n', F.col("n_name")).alias("notes"),
    )
    path = workspace(spark) / "metrics.csv"
    reports.write_csv(rows, path)
    return records.read_metrics(spark, path, rows.select("product", F.col("task").cast("int").alias("ordinal")))


@query("s6_k5_verdict_log", "SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS seq, c_custkey % 2 = 0 AS met FROM customer")
def s6(spark, sf_dir):
    log = f"{shared_base(spark)}/log-{uuid.uuid4().hex}"
    assert records.read_verdicts(spark, log).isEmpty()
    none = F.lit(None)
    told = lambda seq, met: read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.lit(seq).cast("bigint").alias("seq"), F.lit(met).alias("met"), none.cast("double").alias("score"),
        none.cast("string").alias("a_side"), F.lit(0.0).alias("cost"),
    )
    records.append_verdicts(told(2, True).where("cast(key as bigint) % 2 = 0"), log)
    records.append_verdicts(told(1, False), log)
    return records.read_verdicts(spark, log).select("key", F.col("seq").cast("int").alias("seq"), "met")


@query(
    "k5_compacted_log",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 3 = 0 THEN 3 WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS seq, c_custkey % 3 <> 0 AND c_custkey % 2 = 0 AS met
    FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
)
def k5(spark, sf_dir):
    """Batches, two snapshots, later batches with older and newer records; probed by the keys of the customers with orders."""
    log, none = f"{shared_base(spark)}/log-{uuid.uuid4().hex}", F.lit(None)
    told = lambda seq, met: read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.lit(seq).cast("bigint").alias("seq"), F.lit(met).alias("met"), none.cast("double").alias("score"),
        none.cast("string").alias("a_side"), F.lit(0.0).alias("cost"),
    )
    verdict_log.append_verdicts(told(2, True).where("cast(key as bigint) % 2 = 0"), log)
    verdict_log.compact(spark, log)
    verdict_log.append_verdicts(told(1, False), log)
    verdict_log.compact(spark, log)
    verdict_log.append_verdicts(told(3, False).where("cast(key as bigint) % 3 = 0"), log)
    asked = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("key"))
    return verdict_log.probe_verdicts(asked, log).select("key", F.col("seq").cast("int").alias("seq"), "met")


def numbered_lines(spark: SparkSession, path: Path, ends: str) -> DataFrame:
    """(text, at) of one file's lines, numbered from 0. The file is read in splits: a line's number is its place in its
    split and the lines of the splits before, of which there is a row each."""
    raw = spark.read.text(f"file://{path}", lineSep=ends)
    each = raw.select(F.col("value").alias("text"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"))
    splits = each.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return each.join(F.broadcast(splits.select("split", "first", before.alias("before"))), "split").select("text", (F.col("before") + F.col("id") - F.col("first")).alias("at"))


@query("k4_csv_file", "SELECT o_orderkey, 'a \"b\", ' || o_orderpriority AS o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS line FROM orders")
def k4(spark, sf_dir):
    """One file of all orders by price; `line` is a row's place in it, found by reading the file."""
    path, price = workspace(spark) / "table.csv", F.col("o_totalprice")
    rows = read(spark, sf_dir, "orders").orderBy(price, "o_orderkey")
    reports.write_csv(rows.select("o_orderkey", F.concat(F.lit('a "b", '), "o_orderpriority").alias("o_orderpriority"), F.when(F.col("o_orderkey") % 2 == 0, price).alias("o_totalprice")), path)
    lines = numbered_lines(spark, path, "\r\n").where("at > 0")
    own = F.from_csv("text", "o_orderkey bigint, o_orderpriority string, o_totalprice double", {"escape": '"'}).alias("x")
    return lines.select((F.col("at") - 1).alias("line"), own).select("x.*", "line")


# ---------------------------------------------------------------- files


def _put(rows: DataFrame, root: Path, path: Column, content: Column) -> None:
    """Writes a file a row below root, in tasks."""
    own = rows.select(path.alias("path"), content.cast("binary").alias("content"), F.lit(None).cast("string").alias("source"))
    failed = files.stored(own, root, []).where("error is not null").select("error").first()
    if failed:
        raise Invalid(failed["error"])


@query(
    "s7_file_listing",
    """SELECT c_mktsegment || '/' || c_nationkey || '/' || CASE WHEN c_custkey % 2 = 0 THEN '_' ELSE '' END || c_name || '.TXT' AS path, 'txt' AS suffix, sha256(c_name) AS sha256 FROM customer""",
)
def s7(spark, sf_dir):
    root, own = workspace(spark), read(spark, sf_dir, "customer")
    folder = F.concat("c_mktsegment", F.lit("/"), F.col("c_nationkey").cast("string"), F.lit("/"))
    marked = F.concat(F.when(F.col("c_custkey") % 2 == 0, "_").otherwise(""), "c_name")
    _put(own, root, F.concat(folder, marked, F.lit(".TXT")), F.col("c_name"))
    _put(own.select("c_mktsegment", "c_nationkey").distinct(), root, F.concat(folder, F.lit(".DS_Store")), F.lit("x"))
    _put(own, root, F.concat(folder, F.lit("._"), F.col("c_name")), F.lit("x"))
    _put(own, root, F.concat(folder, F.lit("~$"), F.col("c_name"), F.lit(".docx")), F.lit("x"))
    files.discard_staged(root)
    return files.with_digests(files.plain_files(spark, root), []).select("path", "suffix", "sha256")


@query(
    "s8_one_deliverable",
    """SELECT c_custkey AS ordinal, CASE c_custkey % 4 WHEN 0 THEN printf('t%02d.docx', c_custkey) WHEN 1 THEN printf('t%02d.pdf', c_custkey) END AS name,
    CASE WHEN c_custkey % 4 = 2 THEN printf('task %d: 2 files match t%02d.*, not one', c_custkey, c_custkey) WHEN c_custkey % 4 = 3 THEN printf('task %d: 0 files match t%02d.*, not one', c_custkey, c_custkey) END AS error FROM customer""",
)
def s8(spark, sf_dir):
    root, own = workspace(spark), read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ordinal"))
    for kind, rest in (("docx", (0, 2)), ("pdf", (1, 2))):
        _put(own.where((F.col("ordinal") % 4).isin(*rest)), root, F.concat(deliverable_name(F.col("ordinal")), F.lit(f".{kind}")), F.lit(""))
    return files.only_matches(spark, root, own).select("ordinal", "name", "error")


@query(
    "s10_s15_office_text",
    """WITH n AS (SELECT r_name AS region, n_name, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS k FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT region, 'a.docx' AS path, string_agg(n_name, chr(10) ORDER BY k) || chr(10) || '[表格] ' || region || ' | ' || count(*) AS text, NULL AS error FROM n GROUP BY region
    UNION ALL SELECT region, 'b.xlsx', '[工作表] ' || region || chr(10) || string_agg(region || '!A' || k || ': ' || n_name, chr(10) ORDER BY k), NULL FROM n GROUP BY region
    UNION ALL SELECT region, 'c.pptx', string_agg('第' || k || '页: ' || n_name, chr(10) ORDER BY k), NULL FROM n GROUP BY region
    UNION ALL SELECT region, 'd.txt', string_agg(n_name, chr(10) ORDER BY k), NULL FROM n GROUP BY region
    UNION ALL SELECT DISTINCT region, 'e.exe', '', 'unsupported format: ''exe''' FROM n
    UNION ALL SELECT DISTINCT region, 'f.docx', '', 'docx: can''t be parsed (BadZipFile)' FROM n""",
)
def s10(spark, sf_dir):
    by: dict[str, list[str]] = {}
    for r in read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").collect():
        by.setdefault(r["r_name"], []).append(r["n_name"])
    rows = []
    for region, names in by.items():
        own = {"a.docx": docx(names, [region, str(len(names))]), "b.xlsx": xlsx(region, names), "c.pptx": pptx(names), "d.txt": b"\xef\xbb\xbf" + "\n".join(names).encode(), "e.exe": b"", "f.docx": b"no archive"}
        rows += [(region, path, path.rsplit(".")[-1], bytearray(raw)) for path, raw in own.items()]
    return office.extract(spark.createDataFrame(rows, "region string, path string, suffix string, content binary"), ["region"])


# ---------------------------------------------------------------- packets and judging


@query(
    "k1_packet_files",
    f"""SELECT r_name AS product, CAST(n_nationkey + 1 AS INTEGER) AS ordinal, unnest(['START.txt', 'prompt.txt', 'reference_files/' || n_name || '.txt']) AS path,
    unnest([sha256({_QUOTED(packet.START)}), sha256('Write about ' || n_name), sha256('https://h/' || n_name)]) AS sha256 FROM region CROSS JOIN nation""",
)
def k1(spark, sf_dir):
    own, root, names = prepared(spark, sf_dir)
    nested = bank.packets(spark.createDataFrame(list(enumerate(names)), "k int, product string"), own).where("k = 0 or k % (1 + ordinal % 2) = 0")
    at = F.concat("product", F.lit("/"), packet_name(F.col("ordinal")), F.lit("/reference_files/deep/"), "task_id", F.lit(".txt"))
    _put(nested, root, at, F.get("reference_urls", F.lit(0)))  # packets of an older layout: the attachment in a folder of its own
    packet.prepare(spark, own, root, names, root.parent / "downloads", _unreachable)
    found, _ = files.packet_paths(materialised(listed(spark, root)), packet._expected(spark, own, names), "")
    return files.with_digests(found, packet.KEYS).select("product", "ordinal", "path", "sha256")


@query(
    "v9_v10_evidence",
    """SELECT r_name AS product, CAST(n_nationkey + 1 AS INTEGER) AS ordinal, CASE WHEN n_nationkey % 6 = 0 THEN '[文件 a.docx]' || chr(10) || 'about ' || n_name END AS document,
    CASE WHEN n_nationkey % 6 = 0 THEN '[文件 reference_files/' || n_name || '.txt]' || chr(10) || 'https://h/' || n_name END AS reference,
    CASE n_nationkey % 6 WHEN 1 THEN 'output/ holds no deliverable' WHEN 2 THEN 'output/ may hold XLSX, DOCX, PPTX and PDF files only' WHEN 3 THEN 'a file has no text'
        WHEN 4 THEN 'an input isn''t what was prepared' WHEN 5 THEN 'the attachments aren''t those prepared' END AS error FROM region CROSS JOIN nation""",
)
def v9(spark, sf_dir):
    own, root, names = prepared(spark, sf_dir)
    listed = [(r["ordinal"], r["signature"], r["task_id"]) for r in own.orderBy("ordinal").collect()]
    for product in names:
        for ordinal, _, name in listed:
            at, kind = root / product / f"t_{ordinal:02d}", (ordinal - 1) % 6
            if kind != 1:
                (at / "output" / ("a.exe" if kind == 2 else "a.docx")).write_bytes(docx([] if kind == 3 else [f"about {name}"]))
            if kind == 4:
                (at / "prompt.txt").write_text("changed")
            if kind == 5:
                (at / "reference_files" / "more.txt").write_text("more")
    manifest = records.read_manifest(spark, root, names, [(o, s) for o, s, _ in listed])
    asked = packet._expected(spark, own, names).select("product", "ordinal").join(own.select("ordinal", "signature", "prompt", "rubric"), "ordinal")
    texts, errors = packet.evidence(spark, asked, manifest, root)
    return texts.select("product", "ordinal", "document", "reference").unionByName(errors.select("product", "ordinal", "error"), allowMissingColumns=True)


@query(
    "v12_judged_verdicts",
    f"SELECT CAST(c_custkey AS VARCHAR) AS key, CAST('0x' || substr(sha256({_QUOTED(RUBRIC_SYSTEM)} || chr(0) || c_name), 1, 2) AS INTEGER) % 2 = 0 AS met, NULL AS error FROM customer",
)
def v12(spark, sf_dir):
    asked = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("prompt"), F.lit(RUBRIC_SYSTEM).alias("system"))
    return judging.judged(asked, "rubric", DeterministicJudge(), f"{shared_base(spark)}/log-{uuid.uuid4().hex}").select("key", "met", "error")


@query(
    "s16_s20_downloads",
    """SELECT c_name || x.y AS name, CAST(least(c_custkey % 5 + 1, 3) AS INTEGER) AS attempts, CASE WHEN c_custkey % 5 < 3 THEN 0 ELSE 3 END AS again, CASE WHEN c_custkey % 5 < 3 THEN sha256('https://h/' || c_custkey) END AS sha256,
    CASE WHEN c_custkey % 5 >= 3 THEN 'an attachment can''t be fetched (HTTP 503)' END AS error FROM customer CROSS JOIN (VALUES ('a'), ('b')) x(y)""",
)
def s16(spark, sf_dir):
    """Two names an address, which is fetched once; the first tries fail; a second run fetches only what isn't there."""
    folder, url = workspace(spark), F.concat(F.lit("https://h/"), F.col("c_custkey").cast("string"))
    names = F.explode(F.array(*[F.concat("c_name", F.lit(x)) for x in "ab"])).alias("name")
    asked = read(spark, sf_dir, "customer").select(url.alias("url"), names)
    tried: dict[str, int] = {}

    def fetch(own: str, to: Path) -> None:
        tried[own] = tried.get(own, 0) + 1
        if tried[own] <= int(own.rsplit("/", 1)[-1]) % 5:
            raise urllib.error.HTTPError(own, 503, "busy", None, None)
        _fetched(own, to)

    def busy(own: str, to: Path) -> None:
        raise urllib.error.HTTPError(own, 503, "busy", None, None)

    first = download.fetched(asked, folder, fetch, sleep=lambda _: None)
    again = download.fetched(asked, folder, busy, sleep=lambda _: None).select("url", F.col("attempts").alias("again"))
    digests = files.with_digests(first.where("full is not null").select("url", F.lit("x").alias("path"), "full"), ["url"]).select("url", "sha256")
    return asked.join(first.join(again, "url").join(digests, "url", "left"), "url").select("name", "attempts", "again", "sha256", "error")


@query(
    "s17_j10_expert_texts",
    """SELECT n_nationkey + 1 AS ordinal, CASE n_nationkey % 4 WHEN 0 THEN 'one of ' || n_name WHEN 3 THEN 'one of ' || n_name || chr(10) || chr(10) || 'two of ' || n_name END AS expert,
    CASE n_nationkey % 4 WHEN 1 THEN 'there is no expert deliverable' WHEN 2 THEN 'a file has no text' END AS error FROM nation""",
)
def s17(spark, sf_dir):
    name, k = F.col("task_id"), F.col("ordinal") - 1
    url = lambda word: F.concat(F.lit(f"https://h/{word}/"), name)
    urls = F.when(k % 4 == 0, F.array(url("one"))).when(k % 4 == 1, F.array().cast("array<string>")).when(k % 4 == 2, F.array(url("none"))).otherwise(F.array(url("one"), url("two")))
    own = tasks(spark, sf_dir).withColumn("gold_urls", urls).withColumn("gold_names", F.transform(urls, lambda u, i: F.concat(F.lit("deep/"), i.cast("string"), F.lit(".docx"))))

    def fetch(address: str, to: Path) -> None:
        word, of = address.removeprefix("https://h/").split("/")
        to.write_bytes(docx([] if word == "none" else [f"{word} of {of}"]))

    return packet.expert_texts(spark, own, workspace(spark), fetch)


class ScriptedChat(ChatJudge):
    """A chat endpoint that answers by the last digit of a prompt, for the reading of replies and the tries."""

    def ask(self, prompt: str, system: str) -> Reply:
        kind, tried = int(prompt[-1]) % 5, []

        def opened(request, timeout):
            tried.append(1)
            if kind == 2 or kind == 1 and len(tried) < 3:
                raise urllib.error.HTTPError(self.url, 500 + len(tried), "busy", None, None)
            text = " " if kind == 4 and len(tried) < self.attempts else f"for {prompt}\nMET"
            body = {"choices": [{"message": {"content": text}}], "provider": "Other" if kind == 3 else "PINNED", "usage": {"cost": 0.25 * len(tried)}}
            return io.BytesIO(json.dumps(body).encode())

        return super().ask(prompt, system, sleep=lambda _: None, opened=opened)


@query(
    "s18_p16_chat_replies",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 5 IN (0, 1, 4) THEN 'for ' || c_custkey || chr(10) || 'MET' END AS reply,
    CASE c_custkey % 5 WHEN 0 THEN 0.25 WHEN 1 THEN 0.75 WHEN 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS cost, CASE WHEN c_custkey % 5 IN (0, 1, 4) THEN 'PINNED' END AS provider,
    CASE c_custkey % 5 WHEN 2 THEN 'the judge didn''t answer (HTTP 504)' WHEN 3 THEN 'another provider answered than the one named' END AS error FROM customer""",
)
def s18(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    asked = read(spark, sf_dir, "customer").select(key.alias("key"), key.alias("prompt"), F.lit("system").alias("system"))
    return ask_all(asked, ScriptedChat("https://h/chat", "model", "pinned", "key"))


@query(
    "k6_p14_report",
    """SELECT '| ' || r_name || ' | ' || (n_nationkey + 1) || ' | ' || CASE WHEN n_nationkey % 2 = 0 THEN 'graded | 2.5 | — | 0.0 | 12 |' ELSE 'pending | — | — | — | — |' END AS line FROM region CROSS JOIN nation""",
)
def k6(spark, sf_dir):
    even = F.col("n_nationkey") % 2 == 0
    scores = bank.packets(read(spark, sf_dir, "region").select(F.col("r_name").alias("product")), read(spark, sf_dir, "nation")).select(
        "product", (F.col("n_nationkey") + 1).alias("task"), F.when(even, "graded").otherwise("pending").alias("status"), F.when(even, 2.5).alias("rubric_score"),
        F.lit(None).cast("double").alias("pairwise_score"), F.when(even, 0.0).alias("elapsed_seconds"), F.when(even, F.lit(12).cast("decimal(38,0)")).alias("tokens"),
    )
    path = workspace(spark) / "report.md"
    reports.markdown(path, [], scores.collect(), 25, ("rubric",), "digest")
    lines = spark.read.text(f"file://{path}").withColumnRenamed("value", "line")
    return lines.where("line like '| %' and line not like '| product %' and line not like '| --- %'")

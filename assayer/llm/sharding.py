"""Sharding by a minimax contiguous partition, in DataFrame operations only.

Rows with equal texts form atomic groups. The groups lie in the order of their text's hash. A binary search over the
shard capacity, each candidate checked by filling shards greedily in order, finds the smallest capacity with which the
groups fit the shards; the shards are cut there.

The groups' order is giants first, then by hash. A giant is a group larger than a fair share of what is left (a group
of copies may hold a third of all rows): it would set the capacity for all others, so it is cut off into a shard of its
own, and the contiguous partition goes on behind it with the remaining shards.

The list that is searched has a fixed bound, whatever the corpus holds: groups are first taken together in `buckets` by
their hash's leading digits. The smallest capacity for buckets is an upper bound of that for groups, a fair share or the
largest group a lower one; between the places where the greedy filling cuts with the one and with the other lie all
places where it can cut with the right one. Buckets that hold such a place are split by the hash's next digit, and so on
until only single groups do. Then the capacity and the cuts are those of the groups themselves. Each cut adds a bucket or
so to the next one's range, so some 2 x 39 x 20 buckets are split in a round. Equal rows are numbered in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, table, written

SHARDS = 40
BUCKETS = 1 << 16
CHUNKS = 256
ROW_BYTES = 16


def _greedy(sizes: Column, cap: Column) -> Column:
    """Fills shards in order up to cap: n shards used, and the positions at which a shard opens."""
    start = F.struct(
        cap.cast("long").alias("cap"), F.lit(0).cast("long").alias("full"), F.lit(0).alias("at"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("cuts")
    )

    def step(acc: Column, size: Column) -> Column:
        opens = (acc["n"] == 0) | (acc["full"] + size > acc["cap"])
        opened = F.struct(acc["cap"].alias("cap"), size.alias("full"), (acc["at"] + 1).alias("at"), (acc["n"] + 1).alias("n"), F.concat(acc["cuts"], F.array(acc["at"])).alias("cuts"))
        filled = F.struct(acc["cap"].alias("cap"), (acc["full"] + size).alias("full"), (acc["at"] + 1).alias("at"), acc["n"].alias("n"), acc["cuts"].alias("cuts"))
        return F.when(opens, opened).otherwise(filled)

    return F.aggregate(sizes, start, step)


def _search(sizes: Column, shards: Column) -> Column:
    """Binary search for the smallest capacity at which the greedy filling needs no more than `shards`.

    A fair share plus the largest atom always fits, so the search starts with that as its upper bound.
    """
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)
    most = F.coalesce(F.array_max(sizes), F.lit(0).cast("long"))
    share = F.ceil(total / shards).cast("long")
    bounds = F.struct(F.greatest(most, share).alias("lo"), (share + most).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("long")
        lower = F.struct(acc["lo"].alias("lo"), mid.alias("hi"))
        upper = F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))
        return F.when(acc["lo"] >= acc["hi"], acc).when(_greedy(sizes, mid)["n"] <= shards, lower).otherwise(upper)

    return F.aggregate(F.sequence(F.lit(1), F.lit(62)), bounds, halve)["hi"]


def _straddled(atoms: Column, cap: Column) -> Column:
    """The positions of the atoms that the k-th cut of a capacity falls into at most, by k: an atom of several groups may be
    cut anywhere, a single group only before it."""
    start = F.struct(F.lit(0).cast("long").alias("before"), cap.cast("long").alias("limit"), F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        over = acc["before"] + x["size"] > acc["limit"]
        limit = F.when(~over, acc["limit"]).when(x["groups"] == 1, acc["before"] + cap).otherwise(acc["limit"] + cap)
        found = F.when(over, F.concat(acc["found"], F.array(acc["at"]))).otherwise(acc["found"])
        return F.struct((acc["before"] + x["size"]).alias("before"), limit.alias("limit"), (acc["at"] + 1).alias("at"), found.alias("found"))

    return F.aggregate(atoms, start, step)["found"]


def _open_atoms(atoms: DataFrame, shards: int) -> DataFrame:
    """(bucket, wide): the atoms of several groups that must be split before the cuts are known, from one row with `rest`,
    the atoms in order, and `largest`, the size of the largest group. No rows: the atoms' cuts are those of the groups.

    Atoms larger than the lower bound (wide) are split first and alone, as they would hide the cuts within them.
    """
    several = lambda x: x["groups"] > 1
    sizes = F.transform("rest", lambda x: x["size"])
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)
    least = F.greatest(F.ceil(total / shards).cast("long"), F.coalesce(F.col("largest"), F.lit(0)))
    bounded = written(atoms.select("rest", least.alias("least"), _search(sizes, F.lit(shards)).alias("most")))
    low, high = F.slice(_greedy(sizes, F.col("least"))["cuts"], 2, max(shards - 1, 0)), _straddled(F.col("rest"), F.col("most"))
    cut = written(bounded.select("rest", "least", low.alias("low"), high.alias("high")))
    ranges = F.transform("low", lambda x, k: F.struct(x.alias("from"), F.coalesce(F.get("high", k), F.size("rest") - 1).alias("to")))
    wide = F.filter("rest", lambda x: several(x) & (x["size"] > F.col("least")))
    placed = written(cut.select("rest", ranges.alias("ranges"), wide.alias("wide")))
    first = placed.select(F.explode("wide").alias("x")).select("x.bucket", F.lit(True).alias("wide"))
    within = placed.where(F.size("wide") == 0).select("ranges", F.posexplode("rest").alias("at", "x")).where("x.groups > 1")
    hit = within.where(F.exists("ranges", lambda r: (r["from"] <= F.col("at")) & (F.col("at") <= r["to"])))
    return first.union(hit.select("x.bucket", F.lit(False).alias("wide")))


def giant_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(bucket, giant) of groups(bucket, size): the largest, as long as each has at least a fair share of what is left."""
    largest = Window.orderBy(F.desc("size"), "bucket")  # over at most `shards` rows
    total = groups.agg(F.sum("size").alias("total"))
    return (
        groups.orderBy(F.desc("size"), "bucket").limit(shards)
        .join(F.broadcast(total), F.lit(True))  # one row
        .select("bucket", "size", "total", (F.row_number().over(largest) - 1).alias("k"), F.sum("size").over(largest.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
        .where((F.col("k") < shards - 1) & (F.col("size") * (F.lit(shards) - F.col("k")) >= F.col("total") - F.col("upto") + F.col("size")))
        .select("bucket", F.col("k").alias("giant"))
    )


def cut_points(groups: DataFrame, shards: int = SHARDS, buckets: int = BUCKETS) -> tuple[list[str], list[str]]:
    """Of groups(hash, size), hash in hexadecimal digits and different in each: the giants' hashes, whose shards are 0, 1
    and so on, and the prefix of the first hash of each shard behind them, in order; no more than `shards` together."""
    digits = len(f"{buckets - 1:x}")
    if 16**digits != buckets:
        raise ValueError("buckets must be a power of 16")
    giants = giant_groups(groups.select(F.col("hash").alias("bucket"), "size"), shards)
    big = [r["bucket"] for r in sorted(giants.collect(), key=lambda r: r["giant"])]  # fewer than `shards` rows
    live = groups.where(~F.col("hash").isin(big)).select("hash", "size", F.substring("hash", 1, digits).alias("bucket"))
    sums = [F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"), F.max("size").alias("largest")]
    atoms = written(live.groupBy("bucket").agg(*sums))
    item = F.struct("bucket", "size", "groups")
    left = shards - len(big)
    while True:
        listed = written(atoms.agg(F.array_sort(F.collect_list(item)).alias("rest"), F.max("largest").alias("largest")))
        split = written(_open_atoms(listed, left))
        kind = split.select("wide").first()
        if kind is None:
            break
        some = F.broadcast(split.select("bucket"))  # a part of the bounded list
        finer = written(live.join(some, "bucket", "left_semi").withColumn("bucket", F.substring("hash", F.lit(1), F.length("bucket") + 1)))
        atoms = written(atoms.join(some, "bucket", "left_anti").unionByName(finer.groupBy("bucket").agg(*sums)))
        # but for wide atoms, what is split later is a part of what is split now
        live = written(live.join(some, "bucket", "left_anti").unionByName(finer)) if kind["wide"] else finer
    sizes = F.transform("rest", lambda x: x["size"])
    solved = listed.select("rest", _greedy(sizes, _search(sizes, F.lit(left)))["cuts"].alias("at"))
    return big, solved.select(F.transform("at", lambda k: F.get("rest", k)["bucket"]).alias("cuts")).first()["cuts"]


def shard_rows(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, chunks: int = CHUNKS
) -> DataFrame:
    """Puts every row into one of `shards` shards of nearly equal bytes.

    Returns id_col, size (UTF-8 bytes plus 16), text_crc32, shard and slot (gapless from 0 in each shard, in an
    order that depends on the rows alone). Null texts count as empty ones; equal texts share a shard; repeated
    rows take a slot each; an empty table gives no rows; other columns are not used. `buckets` is where the search
    for the cuts starts (a power of 16; the result doesn't hang on it), `chunks` splits the numbering of each shard's
    rows over tasks.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    narrow = written(
        docs.select(
            col(id_col).alias("__id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("hash"),
            F.pmod(F.xxhash64(col(id_col), F.crc32(text.cast("binary"))), F.lit(chunks)).cast("int").alias("chunk"),
        )
    )
    big, cuts = cut_points(written(narrow.groupBy("hash").agg(F.sum("size").alias("size"))), shards, buckets)
    literal = lambda own: F.array(*map(F.lit, own)).cast("array<string>")
    giant = F.array_position(literal(big), F.col("hash"))
    behind = len(big) - 1 + F.size(F.filter(literal(cuts), lambda c: c <= F.col("hash")))
    placed = narrow.withColumn("shard", F.when(giant > 0, giant - 1).otherwise(behind).cast("int")).drop("hash")
    counted = placed.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # offsets has at most shards x chunks rows
    within = Window.partitionBy("shard", "chunk").orderBy("__id", "text_crc32", "size")
    numbered = placed.withColumn("rn", F.row_number().over(within)).join(F.broadcast(offsets), ["shard", "chunk"])
    return numbered.select(
        F.col("__id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("start") + F.col("rn") - 1).cast("long").alias("slot")
    )


def op5_sharding(spark, sf_dir):
    got = shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

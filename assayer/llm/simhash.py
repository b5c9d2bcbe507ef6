"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within `RADIUS` = 3 bits are linked. Every distinct fingerprint emits all variants within half
the radius, the variants are shuffled, and fingerprints that meet on one are linked.

Half of 3 isn't whole, so the ball's radius is 1, which meets every pair within 2 bits: those in one bucket
of whole-fingerprint variants differ in at most 2 bits, so they need no proof and are linked to the least of
them (a bucket holds 65 fingerprints at most, the ball around the variant). For pairs at 3 bits the
fingerprint is projected: one of `BLOCKS` blocks of bits is left out and again all variants within 1 bit of
the rest are emitted. Such a pair differs in 1 bit inside some block and 2 outside it, or in 3 bits of one block.
Buckets whose members are linked already can tell nothing new; only those in which several groups meet are opened:

- 1 bit inside: the bucket's members meet again on their bits inside less each one in turn. What meets differs in
  at most 2 bits outside and 1 inside, which proves it; and as members with equal bits inside are one group
  already, two groups at most meet, so the least and the greatest tell it.
- 3 bits inside: the rest is equal; the bits inside meet by balls again, of radius 1 from one side and 2 from the
  other. All that meet from the first side are one group; each of the second is linked to it.

No bucket gives its pairs: every member gives a bounded number of rows, however dense a group of near copies is.
Tables that grow with the input are joined by shuffles alone, so that none of them passes the driver.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import bitmap, col, map_text, perhaps_in, shuffled, table, written
from .components import connected_components

RADIUS = 3
SEED = 42
SHINGLE = 3
BLOCKS = 3
ALL = (1 << 64) - 1
#: Fingerprints whose variants (65 each, and again about 43 for each block) one task emits, as long as that
#: takes no more than MOST_TASKS tasks.
PER_TASK, MOST_TASKS = 1 << 14, 20_000

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    own = _WORDS.findall(text.lower()) if text else []
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in own])
        starts = [0, *ends[: -shingle].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:z], SEED) for a, z in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(np.array(hashes[at : at + (1 << 16)], dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """keep and fp, the fingerprint as a signed long, of every whole text (null: as empty)."""

    def make():
        def f(texts: list) -> dict:
            return {"fp": np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)}

        return f

    return map_text(docs, make, [T.StructField("fp", T.LongType())], keep, text_col, binary=True)


def _signed(x: int) -> int:
    """A 64-bit pattern as a long."""
    return x - (1 << 64) if x >> 63 else x


def _flips(bits: list[int]) -> Column:
    return F.array(*[F.lit(_signed(1 << b)).cast("long") for b in bits])


def _masks(bits: list[int]) -> list[int]:
    """The flips of at most one of these bits, as signed longs."""
    return [0, *(np.array([1 << b for b in bits], dtype=np.uint64).view(np.int64).tolist())]


def _variants(fp: Column, bits: list[int], drop: int) -> Column:
    """All values within 1 bit of fp in these bits, with the bits of drop cleared."""
    kept = _signed(~drop & ALL)
    return F.transform(F.array(*[F.lit(m).cast("long") for m in _masks(bits)]), lambda m: fp.bitwiseAND(F.lit(kept).cast("long")).bitwiseXOR(m))


def _spread(fps: DataFrame) -> DataFrame:
    """fps over as many tasks as the rows that they are about to become need; file splits go by bytes read."""
    return fps.repartition(min(MOST_TASKS, max(1, -(-fps.count() // PER_TASK))), "fp")


def near_links(distinct: DataFrame) -> DataFrame:
    """distinct(fp long, each once) -> links (a, b) that join fingerprints within 3 bits.

    Not every pair within 3 bits is a row, but each is joined by a path of rows. A row joins two fingerprints
    within 2 bits, or the roots of two groups of which two members are within 3 bits.
    """
    whole = _variants(F.col("fp"), list(range(64)), 0)
    distinct = _spread(distinct)
    balls = distinct.select("fp", F.explode(whole).alias("v")).groupBy("v").agg(F.collect_set("fp").alias("s")).where(F.size("s") > 1)
    proven = balls.select(F.array_sort("s").alias("s")).select(F.explode(F.slice("s", 2, 64)).alias("a"), F.get("s", F.lit(0)).alias("b"))
    near = written(proven.distinct())
    roots = connected_components(near).withColumnRenamed("node", "fp")
    grouped = _spread(written(distinct.join(shuffled(roots), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))))

    cut = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    long = lambda x: F.lit(_signed(x)).cast("long")
    emitted = members = flips = None
    for k in range(BLOCKS):
        block = [*range(cut[k], cut[k + 1])]
        drop, rest = sum(1 << b for b in block), [b for b in range(64) if b not in block]
        own = grouped.select("root", F.lit(k).alias("k"), F.explode(_variants(F.col("fp"), rest, drop)).alias("v"))
        plain = grouped.select("fp", "root", F.lit(k).alias("k"), F.col("fp").bitwiseAND(long(drop)).alias("inside"), F.col("fp").bitwiseAND(long(~drop & ALL)).alias("rest"))
        emitted = own if emitted is None else emitted.unionByName(own)
        members = plain if members is None else members.unionByName(plain)
        flips = F.when(F.col("k") == k, _flips(block)) if flips is None else flips.when(F.col("k") == k, _flips(block))
    several = lambda df, *key: df.groupBy(*key).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    members = written(members)

    # 1 bit inside: back from the buckets in which groups meet to their members
    mixed = written(several(emitted, "k", "v").select("k", "v"))
    around = F.when(F.lit(False), F.array().cast("array<bigint>"))
    for k in range(BLOCKS):
        around = around.when(F.col("k") == k, _variants(F.col("v"), [b for b in range(64) if not cut[k] <= b < cut[k + 1]], 0))
    opened = shuffled(mixed.select("k", "v", F.explode(around).alias("rest"))).join(shuffled(members.select("k", "rest", "inside", "root")), ["k", "rest"]).select("k", "v", "inside", "root").distinct()
    less_one = opened.select("k", "v", "inside", "root", F.explode(flips).alias("bit")).select("k", "v", "root", "bit", F.col("inside").bitwiseAND(F.bitwise_not("bit")).alias("left"))
    one = several(less_one, "k", "v", "bit", "left").select(F.col("lo").alias("a"), F.col("hi").alias("b"))

    # 3 bits inside
    alike = members.join(shuffled(several(members, "k", "rest").select("k", "rest")), ["k", "rest"]).withColumn("flips", flips)
    xor = lambda m: F.col("inside").bitwiseXOR(m)
    once = F.concat(F.array("inside"), F.transform("flips", xor))
    twice = F.flatten(F.transform("flips", lambda m, i: F.transform(F.slice("flips", i + 2, F.size("flips")), lambda n: xor(m).bitwiseXOR(n))))
    near_side = alike.select("k", "rest", F.col("root").alias("a"), F.explode(once).alias("x")).distinct()
    far_side = alike.select("k", "rest", F.col("root").alias("b"), F.explode(twice).alias("x"))
    three = far_side.join(shuffled(near_side), ["k", "rest", "x"]).where("a <> b").select("a", "b")
    return near.unionByName(one.unionByName(three).distinct())


def near_duplicates(docs: DataFrame, keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """id_col, keep, fingerprint (16 hex digits) and component_id: the least id that near-duplicate links reach.

    Null and wordless texts have the fingerprint zero and are linked like any other. Ids that are null take
    part but never name a component unless it has no other; equal rows stay as they are; an empty table gives
    no rows. A kept column that is named as a result gives way to it.
    """
    names = [c for c in dict.fromkeys((id_col, *keep)) if c not in ("fingerprint", "component_id")]
    own = docs.select(*[col(c).alias(f"__{i}") for i, c in enumerate(names)], col(id_col).alias("__id"), col(text_col).alias("__text"))
    fps = written(fingerprints(own, tuple(c for c in own.columns if c != "__text"), "__text", shingle))
    distinct = written(fps.groupBy("fp").agg(F.min("__id").alias("least")))
    links = near_links(distinct.select("fp"))
    roots = connected_components(links).withColumnRenamed("node", "fp")
    rooted = written(distinct.join(shuffled(roots), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.select("fp", "root").join(shuffled(least), "root").select("fp", "component_id")
    return fps.join(shuffled(of), "fp").select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(names)], F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """docs with one row of each near-duplicate group, its columns as they were: the row of the least id.

    Of rows with equal ids the one of least text hash stays, of equal rows one. Rows without an id stay only
    in groups that have no other, again one for each group.

    Rows are chosen by id and text hash. Only rows that a bitmap of the keys that go, or occur more than once, can't
    tell from these are shuffled whole; all others stay where they are.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    marked = docs.select(F.struct("*").alias("__row"), col(id_col).alias("__id"), F.xxhash64(text).alias("__h"), text.alias("__t"))
    found = near_duplicates(marked.select("__id", "__h", "__t"), ("__h",), "__id", "__t", shingle)
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("f")]
    keys = written(found.groupBy("__id", "__h").agg(F.count(F.lit(1)).alias("n"), F.first("component_id").alias("component_id"), F.first("fingerprint").alias("fingerprint")))
    least = F.min(F.struct(F.col("__id").isNull(), "__id", "__h")).alias("k")
    stay = keys.groupBy(*group).agg(least).select(F.col("k.__id").alias("k_id"), F.col("k.__h").alias("k_h"))
    same = F.col("__id").eqNullSafe(F.col("k_id")) & (F.col("__h") == F.col("k_h"))
    gone = written(keys.join(shuffled(stay), same, "left_anti").select(F.col("__id").alias("k_id"), F.col("__h").alias("k_h")))
    key = F.xxhash64("__id", "__h")
    odd = gone.select("k_id", "k_h").unionByName(keys.where("n > 1").select(F.col("__id").alias("k_id"), F.col("__h").alias("k_h")))
    told = perhaps_in(marked.drop("__t"), key, bitmap(odd, F.xxhash64("k_id", "k_h")), "__odd")
    once = Window.partitionBy("__id", "__h").orderBy(F.lit(0))
    met = told.where("__odd").join(shuffled(gone), same, "left_anti").withColumn("__n", F.row_number().over(once)).where("__n = 1")
    return told.where("not __odd").select("__row").unionByName(met.select("__row")).select("__row.*")


def op10_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))

"""What the operators of this subpackage share: table access, the shared folder, row-wise Arrow maps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.shared import shared_base

TEXT = "__text"
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def shared_dir(spark: SparkSession) -> str:
    """A fresh path in the folder that driver and executors share (spark.checkpoint.dir)."""
    return f"{shared_base(spark)}/assayer-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: its lineage ends there and it is computed once.

    The folder stays, as later reads and lost executors need it; discard() or discard_all() removes it."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    got = df.sparkSession.read.schema(df.schema).parquet(path)
    got.written_to = path
    _WRITTEN.add(path)
    return got


_WRITTEN: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(own, True)
    _WRITTEN.discard(path)


def discard(*tables: DataFrame) -> None:
    """Removes what written() stored for these tables. Only for tables that no result to come is read from."""
    for t in tables:
        _delete(t.sparkSession, t.written_to)


def discard_all(spark: SparkSession) -> None:
    """Removes all that written() has stored in this process; for the end of a job, when its results are saved."""
    for path in list(_WRITTEN):
        _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Has the driver's JVM collect garbage, after which Spark's cleaner removes shuffle files that no plan refers to any
    more. Spark does so by itself every spark.cleaner.periodicGC.interval, half an hour; a step that leaves a large
    shuffle behind needn't keep it on disk for so long."""
    spark.sparkContext._jvm.java.lang.System.gc()


#: Cells of a bitmap(): 2 MB of bits, in at most 262,144 rows.
CELLS = 1 << 24


def _cell(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(CELLS))


def _bit(cell: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(F.lit(63)).cast("int"))


def bitmap(keys: DataFrame, key: Column) -> DataFrame:
    """(word, mask): a bit for the hash of every key, in a table of fixed size whatever the number of keys."""
    cells = keys.where(key.isNotNull()).select(_cell(key).alias("c"))
    return cells.groupBy(F.shiftright("c", 6).alias("__word")).agg(F.bit_or(_bit(F.col("c"))).alias("__mask"))


def perhaps_in(df: DataFrame, key: Column, bits: DataFrame, name: str) -> DataFrame:
    """df with a boolean column: false if key is surely none of the bitmap's keys. The bitmap's size is bounded and it is broadcast."""
    joined = df.withColumn("__cell", _cell(key)).join(F.broadcast(bits), F.shiftright("__cell", 6) == F.col("__word"), "left")
    held = F.col("__mask").bitwiseAND(_bit(F.col("__cell"))) != 0
    return joined.withColumn(name, F.coalesce(held, F.lit(False))).drop("__cell", "__word", "__mask")


def small_batches(df: DataFrame) -> None:
    """From now on the session's rows cross to Python in batches of BATCH_ROWS at most: a batch of ten thousand whole
    texts, Spark's default, is built twice outside the heap by every task. The setting is read when a plan runs, so it
    stays; one that is smaller already is left alone."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))


def map_text(
    df: DataFrame,
    make: Callable[[], Callable[[list], dict[str, object]]],
    fields: Sequence[T.StructField],
    keep: Iterable[str],
    text_col: str = "text",
    binary: bool = False,
    rows: int = 1000,
) -> DataFrame:
    """Row-wise map over whole texts in Arrow batches.

    make() is called once a task and returns a function from a list of texts (str, or bytes with binary;
    None for null) to one list or array per field. keep names the columns carried along; a kept column
    with the name of a new field gives way to it. rows bounds the slice handed over at once.

    A text that is kept too crosses to Python once.
    """
    new = {f.name for f in fields}
    keep = [c for c in dict.fromkeys(keep) if c not in new]
    small_batches(df)
    kinds_of = dict(df.dtypes)
    shared = text_col in keep and kinds_of[text_col] in ("string", "binary")
    extra = [] if shared else [(col(text_col) if kinds_of[text_col] == "binary" else col(text_col).cast("string")).alias(TEXT)]
    source = df.select(*[col(c) for c in keep], *extra)
    schema = T.StructType([*source.schema.fields[: len(keep)], *fields])
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in fields]
    at_text = keep.index(text_col) if shared else len(keep)
    wanted = pa.binary() if binary else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                got = f(batch.column(at_text).cast(wanted).to_pylist())
                arrays = [batch.column(i) for i in range(len(keep))]
                arrays += [pa.array(got[name], kind) for name, kind in kinds]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *(name for name, _ in kinds)])

    return source.mapInArrow(run, schema)


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of a join that is shuffled, however small Spark takes it to be. It takes exploded rows for as many
    as they were before, and rows for no larger than their compressed files; what it broadcasts passes the driver whole."""
    return df.hint("merge")


def most_frequent(df: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of the greatest counts, `most` at most: those from a bound on, so that equal counts stay or go together.

    The bound comes from the counts of counts, in bins of a 64th of a doubling (some four thousand at most); no rows are
    sorted or brought together."""
    bin_ = F.floor(F.log2(count) * 64)
    held = sorted((r["b"], r["n"]) for r in df.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
    if sum(n for _, n in held) <= most:
        return df
    total, least = 0, held[-1][0] + 1
    while held and total + held[-1][1] <= most:
        least, n = held.pop()
        total += n
    return df.where(bin_ >= least)


#: A side of a semi join with at most so many keys is broadcast, after they are counted.
BROADCAST_KEYS = 1 << 20


def semi_join(df: DataFrame, keys: DataFrame, key: str, most: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of df whose key is among the different keys of keys(key), a stored table; null is none of them.

    Few keys are broadcast, so that whole texts stay where they are. Otherwise a bitmap of fixed size first drops most
    rows of other keys, and what is left meets the keys in a shuffle.
    """
    if keys.count() <= most:
        return df.join(F.broadcast(keys), key, "left_semi")
    return perhaps_in(df, F.col(key), bitmap(keys, F.col(key)), "__perhaps").where("__perhaps").drop("__perhaps").join(keys, key, "left_semi")


_SPREAD = 0x9E3779B97F4A7C15


class ProbeTable:
    """Different unsigned 64-bit keys in an array with linear probing: 16 to 32 bytes a key, for single and vectorised
    look-ups. spread() lays values out in the order of the slots."""

    def __init__(self, keys: np.ndarray):
        keys = keys.astype(np.uint64)
        self.bits = max(4, (2 * len(keys) - 1).bit_length()) if len(keys) else 4
        home = (keys * np.uint64(_SPREAD)) >> np.uint64(64 - self.bits)
        self.order = np.argsort(home, kind="stable")
        step = np.arange(len(keys))
        # each key lies in its home slot or, if that is taken, behind the key before it
        self.at = np.maximum.accumulate(home[self.order].astype(np.int64) - step) + step if len(keys) else np.empty(0, dtype=np.int64)
        size = max(1 << self.bits, int(self.at[-1]) + 1 if len(keys) else 0) + 1
        self.held = np.zeros(size, dtype=bool)
        self.held[self.at] = True
        self.keys = np.zeros(size, dtype=np.uint64)
        self.keys[self.at] = keys[self.order]
        self._keys, self._held = memoryview(self.keys), memoryview(self.held)

    def spread(self, values: np.ndarray, fill: object) -> np.ndarray:
        out = np.full(len(self.keys), fill, dtype=values.dtype)
        out[self.at] = values[self.order]
        return out

    def __getstate__(self) -> tuple:
        """The slots alone: what spread() needs stays behind."""
        return self.bits, self.keys, self.held

    def __setstate__(self, state: tuple) -> None:
        self.bits, self.keys, self.held = state
        self._keys, self._held = memoryview(self.keys), memoryview(self.held)

    def find(self, key: int) -> int:
        """The slot of a key, -1 if it isn't held."""
        at = (key * _SPREAD & 0xFFFFFFFFFFFFFFFF) >> 64 - self.bits
        keys, held = self._keys, self._held
        while held[at]:
            if keys[at] == key:
                return at
            at += 1
        return -1

    def find_all(self, keys: np.ndarray) -> np.ndarray:
        """The slots of many keys, -1 for those that aren't held."""
        at = ((keys * np.uint64(_SPREAD)) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = np.where(self.held[at] & (self.keys[at] == keys), at, -1)
        rest = np.flatnonzero((found < 0) & self.held[at])
        while len(rest):
            at[rest] += 1
            spot, own = at[rest], keys[rest]
            live = self.held[spot]
            same = live & (self.keys[spot] == own)
            found[rest[same]] = spot[same]
            rest = rest[live & ~same]
        return found


_RESIDENT: dict = {}


def resident(key: object, build: Callable[[], object]) -> object:
    """What build() makes, kept in a Python worker for its later tasks until another key is asked for: a worker that
    serves several operators in turn holds the tables of the last one alone."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = build()
    return _RESIDENT[key]


def crc_of_id(id_col: str) -> Column:
    """crc32 of an id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary"))

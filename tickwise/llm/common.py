"""Helpers the training-data operators share: table reads, staged tables, word rules."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space that separates words, \x20 and \x09-\x0D.
SPACE = " \t\n\x0b\f\r"
#: The same class for Java regular expressions.
SPACE_RE = "[ \\t-\\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where it is unset, a session whose master is this very machine (``local[...]``, as in
    tests) gets a folder of its own; anywhere else that is an error, as executors could
    not see each other's files.
    """
    value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        value = tempfile.mkdtemp(prefix="tickwise-llm-")
        spark.conf.set("spark.checkpoint.dir", value)
    return value.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage and survives lost executors.  The reader knows the table's size, so
    Spark broadcasts it in a join only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tickwise-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Memory(dict):
    """Values made on first use.  When ``room`` are held, all become old; old ones that are used
    again are kept, the others go the next time.  Long keys are not held."""

    def __init__(self, make, room: int, longest: int = 64):
        super().__init__()
        self.make, self.room, self.longest, self.old = make, room, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def bodies_of(column) -> Iterator[bytes | None]:
    """The bytes of an Arrow column of texts, as they are: they need not be valid UTF-8."""
    import pyarrow as pa

    return (body.as_py() for body in column.cast(pa.binary()))


def texts_of(column) -> Iterator[str | None]:
    """The texts of an Arrow column; each ill-formed part of one is U+FFFD."""
    return (None if body is None else body.decode("utf-8", "replace") for body in bodies_of(column))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for null or blank text."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(
        F.split(body, SPACE_RE + "+"))


def hash01(*columns: Column) -> Column:
    """A uniform number in [0, 1), a fixed function of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)).cast("double") / float(1 << 52)

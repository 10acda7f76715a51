"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir
from vigil.streaming.scorer import ship_package

#: The separators of words in every contract of this package (fixed values).
WORD_GAPS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of one batch that Spark sends to a Python worker, unless the session sets it.
BATCH_BYTES = 2 << 20


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: the package on the executors,
    batches to Python bounded by bytes as well as by rows (texts vary from empty
    to very long), and shuffle files that go when the job that made them ends
    (the operators read tables of earlier steps, not their exchanges)."""
    ship_package(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # Spark's default
        spark.conf.set(key, f"{BATCH_BYTES}b")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigil-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts the
    lineage, survives lost executors, and carries no partitioning."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, keep: Iterable[str], made: Iterable[str]) -> list[str]:
    """The input columns to carry along. A column with the name of a column
    that the operator makes is left out (the operator's column wins)."""
    taken = {c.lower() for c in made}
    return [c for c in keep if c in df.columns and c.lower() not in taken]


def schema_of(df: DataFrame, cols: Iterable[str]) -> str:
    """DDL of some columns of ``df``."""
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


def slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths add up to about ``most`` (a longer single row
    is a range of its own): bounds the memory of a vectorised step."""
    at, total = 0, 0
    for k, n in enumerate(lengths):
        if k > at and total + n > most:
            yield at, k
            at, total = k, 0
        total += n
    if at < len(lengths):
        yield at, len(lengths)


def words(text) -> F.col:
    """Array of the words of a text column (null text: no words)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAPS), "")


#: Parts a key's rows are dealt into before a join that a hot key could skew.
SALTS = 16


def salted_join(rows: DataFrame, keyed: DataFrame, key: str | list[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """Joins ``keyed`` (at most one row per key) to ``rows``. Rows of one key
    are dealt over ``salts`` tasks by a hash of all their columns, the keyed
    rows are repeated once for each salt. Rows with a null key are dealt the
    same way and match nothing."""
    keys = [key] if isinstance(key, str) else key
    salt = F.pmod(F.xxhash64(*[rows[c] for c in rows.columns]), F.lit(salts)).cast("int")
    each = keyed.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in keyed.columns if c not in keys],
                        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    # The salt of ``rows`` is an expression of the join, not a column that is moved along.
    on = each["_salt"] == salt
    for k in keys:
        on = on & (rows[k] == each[f"_key_{k}"])
    return rows.join(each.hint("merge"), on, how).drop("_salt", *[f"_key_{k}" for k in keys])

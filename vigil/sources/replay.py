"""An ordered streaming source: staged wire rows by position.

``stage`` numbers the rows in an order (ties and nulls are cut by position like
any others) and writes them in bins of positions. ``ReplaySource`` streams them: its
offset is a position, each trigger takes the next ``rows`` of them, and tasks read
bins in parallel. One query replays everything, in order, and resumes from its
checkpoint. The tasks open the staged files with pyarrow, so the shared folder
must be on a file system it knows (local or mounted, HDFS, S3, GCS, ABFS); on any other,
``streaming.scorer.replay`` publishes chunk by chunk through Spark alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from vigil.operators.sequence import row_positions
from vigil.session import scratch_dir

SCHEMA = "key string, value string, partition int, seq long"
#: The same of enriched wire rows.
ENRICHED = "key string, value string, seq long, record_number long, reason string"
#: Positions of a bin (a folder of the staged rows), and rows that a task reads at most.
BIN_ROWS, TASK_ROWS = 1 << 16, 1 << 14
#: Rows of a row group, the least that is read of a file, and tasks that a batch of less than
#: ``TASK_ROWS`` for each is dealt over.
GROUP_ROWS, BATCH_TASKS = 1 << 12, 16


def columns(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def stage(wire: DataFrame, order: str = "seq", schema: str = SCHEMA) -> tuple[str, int]:
    """(folder, number of rows): the wire rows by position in ``order``, nulls
    first. One range exchange; only the number of rows comes to the driver."""
    folder = scratch_dir(wire.sparkSession, "staged")
    rows = row_positions(wire, [order], "position", keep=columns(schema))
    own = [F.col(c).cast(t).alias(c) for c, t in (f.split() for f in schema.split(", "))]
    (rows.select(*own, "position", F.floor(F.col("position") / BIN_ROWS).alias("bin"))
     .write.option("parquet.block.row.count.limit", GROUP_ROWS).partitionBy("bin").parquet(folder))
    return folder, wire.sparkSession.read.schema(schema).parquet(folder).count()


def batch_rows(total: int, least: int, batches: int) -> int:
    """Rows of a micro-batch: ``least``, or more where that would make more than ``batches`` of them."""
    return max(least, -(-total // batches))


class Positions(InputPartition):
    def __init__(self, low: int, high: int):
        self.low = low
        self.high = high


class ReplayReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.rows = int(options["rows"])
        self.total = int(options["total"])
        self.at = int(options.get("at", 0))
        self.columns = columns(options.get("columns", SCHEMA))

    def initialOffset(self) -> dict:
        return {"position": 0}

    def latestOffset(self) -> dict:
        self.at = min(self.at + self.rows, self.total)
        return {"position": self.at}

    def partitions(self, start: dict, end: dict) -> list[Positions]:
        low, high = start["position"], end["position"]
        self.at = max(self.at, high)
        step = max(GROUP_ROWS, min(TASK_ROWS, (high - low) // BATCH_TASKS))
        cuts = sorted({low, high, *range(low, high, step), *range(low - low % BIN_ROWS + BIN_ROWS, high, BIN_ROWS)})
        return [Positions(a, b) for a, b in zip(cuts, cuts[1:])]

    def read(self, partition: Positions) -> Iterator:
        import pyarrow.dataset as ds
        from pyarrow import fs
        path = re.sub(r"^file:/+", "/", self.folder) + f"/bin={partition.low // BIN_ROWS}"
        files, path = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        at = ds.field("position")
        own = ds.dataset(path, format="parquet", filesystem=files, exclude_invalid_files=True)
        yield from own.to_batches(columns=self.columns, filter=(at >= partition.low) & (at < partition.high))


class ReplaySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vigil_replay"

    def schema(self) -> str:
        return self.options.get("columns", SCHEMA)

    def streamReader(self, schema) -> ReplayReader:
        return ReplayReader(dict(self.options))


def last_position(spark: SparkSession, checkpoint: str) -> int:
    """The position up to which the checkpoint has planned batches (0 without one)."""
    from pyspark.errors import AnalysisException
    try:
        log = spark.read.text(f"{checkpoint}/offsets")
    except AnalysisException:
        return 0
    found = log.select(F.max(F.get_json_object("value", "$.position").cast("long"))).first()[0]
    return found or 0


def read_replay(spark: SparkSession, folder: str, total: int, rows: int, checkpoint: str, schema: str = SCHEMA) -> DataFrame:
    """The staged rows as a stream, ``rows`` of them per trigger, from where ``checkpoint`` is."""
    from vigil.streaming.scorer import ship_package
    ship_package(spark)
    spark.dataSource.register(ReplaySource)
    return (spark.readStream.format("vigil_replay").option("rows", rows).option("total", total).option("columns", schema)
            .option("at", last_position(spark, checkpoint)).load(folder))

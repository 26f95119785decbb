"""Session settings and stored intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS = {}
#: Spark's setting by which a query's shuffle files are removed when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores=8, shuffle_partitions=8, app="tillroll", **conf):
    """Single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local session, where every task sees the same disk, may fall back to a
    temporary folder, which goes away with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.TemporaryDirectory(prefix="tillroll-")
    return _LOCAL_FOLDERS[application].name


def spread(df: DataFrame, *keys, waves: int = 4) -> DataFrame:
    """Deal rows that are small but take long, by their keys, to a few tasks for each slot.

    A named number of partitions is left alone by adaptive execution, which sees only their few bytes.
    """
    spark = df.sparkSession
    slots = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(waves * slots, *keys)


def new_path(spark: SparkSession, kind: str = "settled") -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Store a table that several steps read, and go on from the stored copy.

    Its lineage ends there: a lost executor costs a re-read, and the steps that use it do
    not compute it again. Unlike a cached table it keeps sizes and column pruning.
    """
    spark = df.sparkSession
    path = new_path(spark)
    store(df, path)
    return spark.read.schema(df.schema).parquet(path)


def store(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write a table; the shuffle files of its making go away as soon as it is written.

    The setting is only on while the write is planned: a write plans its own exchanges, so nothing else reads them.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        conf.unset(CLEAN_UP) if before is None else conf.set(CLEAN_UP, before)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a stored table through Spark's own file systems."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Settled tables of an iteration, removed as soon as the next one has been stored.

    `with Scratch(spark) as scratch:` removes what is left at the end, so the result has to
    be settled outside of it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths = {}

    def settle(self, df: DataFrame) -> DataFrame:
        path = new_path(self.spark, "scratch")
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(stored)] = (path, stored)
        return stored

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path, _ = self.paths.pop(id(table), (None, None))
            if path:
                remove_path(self.spark, path)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        for path, _ in self.paths.values():
            remove_path(self.spark, path)
        self.paths = {}

"""Session helpers: a local session for tests, the shared folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ENTRY = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}  # own folder of each local application


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fathomline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder, because there every task runs on this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get(_ENTRY, None) or context.getConf().get(_ENTRY)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_ENTRY} to a folder that every executor can reach")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="fathomline-")
    return _LOCAL[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    A written table outlives the executor that computed it, is computed once, and starts
    the next plan with nothing but its own size: plans of an iteration stay equally small.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class AlternatingTables:
    """Written states of an iteration: each goes to the folder that the last but one left, so an iteration of any length takes two."""

    def __init__(self, spark: SparkSession) -> None:
        self._paths = [scratch_path(spark, "state"), scratch_path(spark, "state")]

    def write(self, df: DataFrame) -> DataFrame:
        """The rows, read from their folder. They may depend on the last state, not on an earlier one."""
        self._paths.reverse()
        df.write.mode("overwrite").parquet(self._paths[0])
        return df.sparkSession.read.schema(df.schema).parquet(self._paths[0])


class AlternatingBuckets:
    """As ``AlternatingTables``, with the rows dealt by ``by`` into ``parts`` buckets: a join on it with rows split alike moves neither side."""

    def __init__(self, spark: SparkSession, by: str, parts: int) -> None:
        name = f"state_{uuid.uuid4().hex}"
        self._spark, self._by, self._parts = spark, by, parts
        self._tables = [(f"{name}_{k}", scratch_path(spark, "state")) for k in range(2)]

    def write(self, df: DataFrame) -> DataFrame:
        """The rows, read from their buckets. They may depend on the last state, not on an earlier one."""
        self._tables.reverse()
        name, path = self._tables[0]
        df.write.mode("overwrite").format("parquet").bucketBy(self._parts, self._by).option("path", path).saveAsTable(name)
        return self._spark.table(name)

    def close(self) -> None:
        """Take the tables out of the catalog; their files stay in the shared folder."""
        for name, _ in self._tables:
            self._spark.sql(f"drop table if exists {name}")


class DealtOut:
    """Rows written once into as many buckets as there are shuffle partitions: rows split alike are joined with them where they lie."""

    def __init__(self, df: DataFrame, *by: str) -> None:
        self._spark, self._name = df.sparkSession, f"dealt_{uuid.uuid4().hex}"
        parts = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.format("parquet").bucketBy(parts, *by).option("path", scratch_path(self._spark, "dealt")).saveAsTable(self._name)
        self.rows = self._spark.table(self._name)

    def close(self) -> None:
        """Take the table out of the catalog; its files stay in the shared folder."""
        self._spark.sql(f"drop table if exists {self._name}")

"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of other characters than these.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Working columns start with this, so that they do not meet a caller's column.
OWN = "__q_"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; only where none is named (tests on one machine), a temporary one."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(made := tempfile.mkdtemp(prefix="quire-checkpoint-"))
    return made


#: Spark removes a query's shuffle files when the query has ended.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _asked(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def settle(df: DataFrame, partitioned: bool = False) -> DataFrame:
    """Computes df once and cuts its lineage: the rows are in the shared checkpoint folder, so a lost executor loses none.

    The shuffle files that led to them go at once. Spark removes the checkpoint's files when nothing refers to them any more
    (spark.cleaner.referenceTracking.cleanCheckpoints). partitioned: later plans know how the rows are dealt out, and do not
    shuffle them again for that; an adaptive plan would not tell.
    """
    checkpoint_dir(df.sparkSession)
    with _asked(df.sparkSession, {_FREED: "true"} | ({"spark.sql.adaptive.enabled": "false"} if partitioned else {})):
        return df.checkpoint(eager=True)


def with_columns(df: DataFrame, made: dict[str, Column]) -> DataFrame:
    """df with these columns at the end; a caller's columns of the same names (in any case) give way."""
    taken = {k.lower() for k in made}
    return df.select(*(df[f"`{c}`"] for c in df.columns if c.lower() not in taken), *(v.alias(k) for k, v in made.items()))


def partitions(spark: SparkSession, rows: int, per_partition: int) -> int:
    """So many partitions that none has more than about per_partition rows, and no fewer than the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-rows // per_partition))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def stored(df: DataFrame) -> DataFrame:
    """Like settle, for tables of whole documents or blocks: Parquet in the shared folder, of which later scans read only some columns.

    The files stay until the folder is emptied, as those of reliable checkpoints do by default, or until discard() is called.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/quire-{uuid.uuid4().hex}"
    with _asked(spark, {_FREED: "true"}):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, n: int) -> DataFrame:
    """Like stored, in n buckets of a key, which are not shuffled when the table meets others by it. No shuffle writes them either.

    Spark keeps buckets for tables of its catalog alone, so the folder has a name there until discard().
    """
    spark = df.sparkSession
    name = f"quire_{uuid.uuid4().hex}"
    with _asked(spark, {_FREED: "true"}):
        df.write.format("parquet").option("compression", "zstd").option("path", f"{checkpoint_dir(spark)}/{name}").bucketBy(n, key).saveAsTable(name)
    return spark.table(name)


def discard(*tables: DataFrame) -> None:
    """Deletes the files of stored() and bucketed() tables that no plan reads any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            name = folder.rsplit("/", 1)[-1]
            if not name.startswith("quire"):
                continue
            if name.startswith("quire_"):
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)

"""Session helpers: where shared scratch tables go."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session without the setting gets a temporary folder; on a cluster a
    machine-local folder would lose data with its machine, so there it is an error.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder")
    folder = spark.conf.get("spark.hearthline.local.folder", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="hearthline-")
        spark.conf.set("spark.hearthline.local.folder", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


HUGE_METHOD_CONF = "spark.sql.codegen.hugeMethodLimit"
JIT_LIMIT = "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Keep wide projections compiled.

    The JVM runs methods over 8000 bytes of bytecode in its interpreter. With this limit
    Spark evaluates such a stage operator by operator in small methods instead. A limit
    set by the user stays.
    """
    if spark.conf.get(HUGE_METHOD_CONF) == "65535":
        spark.conf.set(HUGE_METHOD_CONF, JIT_LIMIT)
    return spark

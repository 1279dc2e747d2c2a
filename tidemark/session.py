"""The few things the library needs from the caller's session."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the session at the shared checkpoint folder and return it.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local session that
    names none gets a temporary folder: on a cluster a machine-local folder would be lost with its
    machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, which all executors can reach."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, uri: str) -> None:
    """Delete a folder, given as an encoded URI, on the file system it belongs to."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "gridframe", **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; cluster settings given by spark-submit stay."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; there a temporary folder is taken.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridframe-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and continue from there, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote for its own use."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(target)) if system.exists(target) else []


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file with its whole content, unless there is one of its name: of several writers one succeeds.

    A local file appears by a link, others by a rename, which must fail on a file that is there (as in HDFS)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    begun = f"{path}.{uuid.uuid4().hex}.tmp"
    if system.getUri().getScheme() == "file":
        local = lambda p: unquote(urlparse(p).path) if p.startswith("file:") else p
        with open(local(begun), "x") as out:
            out.write(text)
        try:
            os.link(local(begun), local(path))
        except FileExistsError:
            return False
        finally:
            os.unlink(local(begun))
        return True
    out = system.create(spark._jvm.org.apache.hadoop.fs.Path(begun), False)
    out.write(text.encode())
    out.close()
    done = not system.exists(target) and system.rename(spark._jvm.org.apache.hadoop.fs.Path(begun), target)
    if not done:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(begun), False)
    return done

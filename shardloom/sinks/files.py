"""The few file operations that a commit needs and a DataFrame does not offer.

All go through the file system of the path (Hadoop's API in the driver's JVM), so
they reach whatever Spark reaches.  None of them touches data files one by one.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    at, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all it holds (one call to the file system)."""
    at, fs = _fs(spark, path)
    return fs.delete(at, True)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path`` with ``text`` unless there is one; whether it was made.

    The file appears at once and whole: it is written under a name of its own and then
    given its name, which fails if the name is taken, also when two try at the same
    time.  On a local disk a hard link does that (a rename would replace the file);
    elsewhere a rename without the right to overwrite.
    """
    jvm = spark._jvm
    at, fs = _fs(spark, path)
    fs.mkdirs(at.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{at.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = [jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (at, draft)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            context.rename(draft, at, spark.sparkContext._gateway.new_array(option, 0))
    except Py4JJavaError as failed:
        if "FileAlreadyExistsException" not in failed.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(draft, False)
    return True


__all__ = ["exists", "names", "read_text", "delete", "put_if_absent"]

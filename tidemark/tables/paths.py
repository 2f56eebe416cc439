"""Existence checks and deletes on whatever file system a table path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return fs.exists(jpath)


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _open(spark, path)
    fs.delete(jpath, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; the target must not exist, its parent is made."""
    fs, jpath = _open(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(jpath, goal):
        raise OSError(f"{source} could not be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: readers see the old text, the new one, or for a moment none."""
    fs, jpath = _open(spark, f"{path}.new")
    stream = fs.create(jpath, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    delete(spark, path)
    move(spark, f"{path}.new", path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or its finished replacement; null if there is neither."""
    for name in (path, f"{path}.new"):
        fs, jpath = _open(spark, name)
        if fs.exists(jpath):
            stream = fs.open(jpath)
            try:
                return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
    return None


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a directory; none if there is no such directory."""
    fs, jpath = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition directories ``a=1/b=2`` of ``depth`` levels below a path; hidden ones are left out."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{parent}/{name}".lstrip("/") for parent in found for name in names(spark, f"{path}/{parent}".rstrip("/"))
            if "=" in name and name[0] not in "._"
        ]
    return found


def unescaped(spark: SparkSession, text: str) -> str | None:
    """The partition value a directory name stands for."""
    if text == "__HIVE_DEFAULT_PARTITION__":
        return None
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(text)


def partition_name(spark: SparkSession, column: str, value: object) -> str:
    """The directory Spark writes rows of one partition value to."""
    catalog = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    text = "__HIVE_DEFAULT_PARTITION__" if value is None else catalog.escapePathName(str(value))
    return f"{column}={text}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path as the file system spells it, scheme included."""
    fs, jpath = _open(spark, path)
    return fs.makeQualified(jpath).toString()

"""The few things Spark's readers and writers leave to the file system; any Hadoop path works."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out; none if it is absent."""
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def files_below(spark: SparkSession, path: str) -> Iterator[str]:
    """Paths, relative to ``path``, of all files below it but hidden ones."""
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return
    root = fs.makeQualified(at).toUri().getPath().rstrip("/") + "/"
    found = fs.listFiles(at, True)
    while found.hasNext():
        relative = found.next().getPath().toUri().getPath().removeprefix(root)
        if not any(part.startswith(("_", ".")) for part in relative.split("/")):
            yield relative


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another name, whose parent folders are made; the name must be free."""
    fs, old = _at(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def move_into(spark: SparkSession, source: str, target: str) -> None:
    """Move everything below ``source``, hidden files left out, to the same places below ``target``.

    A folder that ``target`` lacks is moved as a whole, files of others one by one, as a commit does.
    """
    fs, at = _at(spark, source)
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if status.isDirectory() and exists(spark, f"{target}/{name}"):
            move_into(spark, f"{source}/{name}", f"{target}/{name}")
        else:
            move(spark, f"{source}/{name}", f"{target}/{name}")


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def creator(spark: SparkSession, folder: str) -> Callable[[str], bool]:
    """``create_new`` for many names in one folder, which is made."""
    fs, at = _at(spark, folder)
    fs.mkdirs(at)
    local = spark._jvm.java.io.File if fs.getUri().getScheme() == "file" else None
    root = at.toUri().getPath()

    def create(name: str) -> bool:
        if local:
            # The local file system of Hadoop looks first and creates then; this call does both at once.
            return local(f"{root}/{name}").createNewFile()
        path = spark._jvm.org.apache.hadoop.fs.Path(at, name)
        try:
            fs.create(path, False).close()
        except Exception as error:
            if fs.exists(path):
                return False
            raise error
        return True

    return create


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists. Of several callers exactly one gets True."""
    folder, _, name = path.rpartition("/")
    return creator(spark, folder)(name)

"""Listing of files by executors.

A frontier of folders is a table; tasks list their folders and return files and subfolders; the
subfolders are the next frontier. A round is a level of the tree. Nothing but the paths that were asked
for, and whether a frontier is empty, is in the driver. What a folder holds is asked of the file system by
its address; where no such client is to be had on the executors, the driver's file system is asked for
each frontier, and hands over no list but that of the files of no bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.session import materialize

_KINDS = "path string, size long, folder boolean"


def pattern(glob: str, within: str = "") -> str:
    """A whole-text regular expression for a pattern of names (``* ? [..] {a,b}``). ``within``: characters
    that a star does not match."""
    out, depth, i = "", 0, 0
    any_ = f"[^{re.escape(within)}]" if within else "."
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out += f"{any_}*"
        elif c == "?":
            out += any_
        elif c == "[" and "]" in glob[i:]:
            end = glob.index("]", i)
            out += "[" + glob[i + 1 : end].replace("!", "^", 1) + "]"
            i = end
        elif c == "{":
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        else:
            out += re.escape(c)
        i += 1
    return f"^{out}$"


def _split(path: str) -> tuple[str, str | None]:
    """The folder above the first part with a pattern, and a regular expression of the rest."""
    parts = path.rstrip("/").split("/")
    first = next((i for i, p in enumerate(parts) if re.search(r"[*?{\[]", p)), None)
    if first is None:
        return path.rstrip("/"), None
    rest = pattern("/".join(parts[first:]), "/")
    return "/".join(parts[:first]), rest[:-1] + "(/.*)?$"


def _address(path: str) -> str:
    return path if urlsplit(path).scheme else f"file:{path}"


def _lister():
    """Made here, so that it goes to the executors whole and this package need not be there."""

    def client(path: str) -> tuple[fs.FileSystem, str, str]:
        """The file system of a path, the path in it, and what stands before that."""
        if path.startswith("file:"):
            inside = "/" + path[len("file:") :].lstrip("/")
            return fs.LocalFileSystem(), inside, "file:"
        system, inside = fs.FileSystem.from_uri(path)
        return system, inside, path[: len(path) - len(inside)]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(path, size, folder) of what is in each folder, or of a file itself."""
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inside, before = client(path)
                what = system.get_file_info(inside)
                if what.type == fs.FileType.Directory:
                    found = system.get_file_info(fs.FileSelector(inside))
                else:
                    found = [what] if what.type == fs.FileType.File else []
                shown = [x for x in found if not re.match(r"[._]", x.base_name) or "=" in x.base_name]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([before + x.path for x in shown], pa.string()),
                        pa.array([x.size or 0 for x in shown], pa.int64()),
                        pa.array([x.type == fs.FileType.Directory for x in shown], pa.bool_()),
                    ],
                    names=["path", "size", "folder"],
                )

    return client, listed


def _by_executors(path: str) -> bool:
    try:
        _lister()[0](path)
    except (OSError, ValueError, ImportError):
        return False
    return True


def _by_driver(spark: SparkSession, path: str) -> DataFrame:
    """Files of no bytes below a path, by the driver's file system; others are passed over one by one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = []
    if system.exists(folder):
        found = system.listFiles(folder, True)
        while found.hasNext():
            status = found.next()
            if status.getLen() == 0 and not re.match(r"[._]", status.getPath().getName()):
                rows.append((status.getPath().toString(), 0, False))
    return spark.createDataFrame(rows, _KINDS)


def _below(spark: SparkSession, path: str) -> DataFrame:
    if not _by_executors(path):
        return _by_driver(spark, path)
    frontier, found = spark.createDataFrame([(path,)], "path string"), []
    while True:
        level = materialize(frontier.mapInArrow(_lister()[1], _KINDS), "listing")
        found.append(level.where("NOT folder"))
        folders = level.where("folder").select("path")
        if folders.isEmpty():
            return reduce(DataFrame.unionByName, found)
        frontier = folders.repartition("path")


def files(spark: SparkSession, *paths: str) -> DataFrame:
    """``src_file, src_path, size`` of the files below paths or patterns, with files whose name begins
    with a dot or underscore left out, as by a scan. Of file systems that only the driver reaches, those of
    no bytes. Paths that do not exist give no rows."""
    kept = []
    for path in paths:
        base, rest = _split(_address(path))
        found = _below(spark, base)
        if rest is not None:
            relative = F.substring("path", F.lit(len(base) + 2), F.length("path"))
            found = found.where(relative.rlike(rest))
        kept.append(found)
    every = reduce(DataFrame.unionByName, kept).distinct()
    path = F.regexp_replace("path", r"^(\w+):/+(?=[^/]*/)", "$1:/")
    return every.select(F.substring_index("path", "/", -1).alias("src_file"), path.alias("src_path"), "size")

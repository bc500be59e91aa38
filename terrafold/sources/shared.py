"""Places that every executor can reach."""

from __future__ import annotations

import atexit
import json
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Only a session without one that runs in a single machine gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="terrafold-")


_working: list[str] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder, removed when the driver ends.

    Plans that read it may run any time before.
    """
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _working.append(path)
    return path


@atexit.register
def _remove_working() -> None:
    for path in _working:
        try:
            files, place = open_fs(path)
            if files.get_file_info(place).type == fs.FileType.Directory:
                files.delete_dir(place)
        except OSError:
            # The folder's owner clears what an ending driver cannot.
            pass


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a written table, so that what a plan reads twice is the same twice."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path for a local path or any URI pyarrow knows."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = path[len("file:") :]
    return fs.LocalFileSystem(), path


def list_files(path: str, suffixes: tuple[str, ...], version: str | None = None) -> list[tuple[str, int]]:
    """Data files of a folder, or the file itself, with sizes; hidden files are left out, and none are where nothing is.

    Of an output with versions, the files of the current one, or of the one named.
    """
    listed = data_paths(path, version)
    if listed != [path]:
        listed = sorted(p for p in listed if p.endswith(suffixes))
        places = [open_fs(p)[1] for p in listed]
        sizes = open_fs(path)[0].get_file_info(places) if places else []
        return [(p, info.size) for p, info in zip(listed, sizes)]
    root, _, pattern = path.rpartition("/") if "*" in path else (path, "", "")
    files, place = open_fs(root)
    scheme = root[: len(root) - len(place)] if root.endswith(place) else ""
    info = files.get_file_info(place)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    if info.type == fs.FileType.NotFound:
        return []
    found = files.get_file_info(fs.FileSelector(place, recursive=not pattern))
    out = []
    for item in found:
        inner = item.path[len(place) :].strip("/")
        hidden = any(part.startswith((".", "_")) for part in inner.split("/"))
        if item.type != fs.FileType.File or hidden or not inner.endswith(suffixes):
            continue
        if pattern and not _matches(item.base_name, pattern):
            continue
        out.append((scheme + item.path, item.size))
    return sorted(out)


def _matches(name: str, pattern: str) -> bool:
    from fnmatch import fnmatch

    return fnmatch(name, pattern)


#: Folders of a versioned output begin like this, which hides them from listings of the output itself.
VERSION_PREFIX = "_v-"
_CURRENT, _LISTING = "_current.json", "_files"


def switch_version(files: fs.FileSystem, place: str, version: str, names: list[str]) -> None:
    """Make a written version the one readers get.

    The names of its files are listed beside them, so what failed attempts left there is never
    read. Then one small file that names the version takes the place of the one before.
    """
    with files.open_output_stream(f"{place}/{version}/{_LISTING}") as out:
        out.write("".join(f"{n}\n" for n in names).encode())
    new = f"{place}/{_CURRENT}.{uuid.uuid4().hex}"
    with files.open_output_stream(new) as out:
        out.write(json.dumps({"version": version}).encode())
    files.move(new, f"{place}/{_CURRENT}")


def new_version(path: str, write) -> None:
    """Run ``write(folder)`` for a sink of Spark's own and make what it wrote the current version."""
    files, place = open_fs(path)
    version = f"{VERSION_PREFIX}{uuid.uuid4().hex[:12]}"
    files.create_dir(place, recursive=True)
    write(f"{path}/{version}")
    found = files.get_file_info(fs.FileSelector(f"{place}/{version}"))
    names = sorted(i.base_name for i in found if not i.base_name.startswith((".", "_")))
    switch_version(files, place, version, names)


def current_version(path: str) -> str | None:
    """The version readers get; None where an output has no versions."""
    files, place = open_fs(path)
    if files.get_file_info(f"{place}/{_CURRENT}").type != fs.FileType.File:
        return None
    with files.open_input_stream(f"{place}/{_CURRENT}") as raw:
        return json.loads(raw.read())["version"]


def data_paths(path: str, version: str | None = None) -> list[str]:
    """What a reader of ``path`` has to open: the files of a version, the current one if none is named, or the path as it is."""
    version = version or (None if "*" in path else current_version(path))
    if version is None:
        return [path]
    files, place = open_fs(f"{path}/{version}")
    with files.open_input_stream(f"{place}/{_LISTING}") as raw:
        return [f"{path}/{version}/{name}" for name in raw.read().decode().splitlines()]


def drop_versions(path: str) -> list[str]:
    """Delete all versions of an output but the current one; returns their names.

    For when no reader of an older one is left.
    """
    kept = current_version(path)
    files, place = open_fs(path)
    gone = []
    if kept is not None:
        for item in files.get_file_info(fs.FileSelector(place)):
            if item.base_name.startswith(VERSION_PREFIX) and item.base_name != kept:
                files.delete_dir(item.path)
                gone.append(item.base_name)
    return sorted(gone)


def replacing(write, path: str) -> None:
    """Run ``write(new path)`` and put the result in the place of ``path``.

    What was there goes only when the new output stands beside it, whole.
    """
    place_of = open_fs(path)[1]
    mark = uuid.uuid4().hex
    new, old = f"{path}.new-{mark}", f"{place_of}.old-{mark}"
    write(new)
    files, made = open_fs(new)
    had = files.get_file_info(place_of).type != fs.FileType.NotFound
    if had:
        files.move(place_of, old)
    files.move(made, place_of)
    if had:
        files.delete_dir(old)


def path_exists(path: str) -> bool:
    files, place = open_fs(path)
    return files.get_file_info(place).type != fs.FileType.NotFound

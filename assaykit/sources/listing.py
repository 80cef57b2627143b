"""Files listed and read by the executors, folder by folder; the driver sees no listing."""

from __future__ import annotations

import fnmatch
import hashlib
import itertools
import os
import posixpath
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit.session import cut

CHUNK = 8 << 20
PIECE = 10_000
MAX_DEPTH = 100
LISTED = "folder string, path string, name string, size long, modified timestamp, is_folder boolean"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it. Schemes are those of Arrow: local files,
    HDFS, S3 and GCS."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _infos(folder: str) -> Iterator[list[fs.FileInfo]]:
    """The entries of a folder, PIECE at a time. A local folder is read as it goes; the other file systems
    of Arrow hand over a folder at once."""
    system, path = opened(folder)
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(path) as found:
            while names := [f"{path.rstrip('/')}/{e.name}" for e in itertools.islice(found, PIECE)]:
                # broken links and what has gone meanwhile are no entries, as in a listing at once
                yield [i for i in system.get_file_info(names) if i.type != fs.FileType.NotFound]
    else:
        infos = system.get_file_info(fs.FileSelector(path, recursive=False))
        for low in range(0, len(infos), PIECE):
            yield infos[low : low + PIECE]


def _entries(folder: str) -> Iterator[list[tuple]]:
    for infos in _infos(folder):
        out = []
        for info in infos:
            name = posixpath.basename(info.path.rstrip("/"))
            if not name.startswith(("_", ".")):
                is_folder = info.type == fs.FileType.Directory
                out.append((folder, f"{folder.rstrip('/')}/{name}", name, info.size, info.mtime, is_folder))
        yield out


def _list_folders(folders: DataFrame) -> DataFrame:
    """The entries of each of the given folders, a folder's by the task that has it, in batches of PIECE
    entries: a task's memory does not grow with its folder."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(LISTED))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for rows in _entries(folder):
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                    if rows:
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return folders.select("path").mapInArrow(scan, LISTED)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, name, size, modified) of every file below a folder whose name fits `glob`.

    Each round lists all folders of one depth, spread over the tasks, and finds those of the next; so
    there are as many jobs as levels, and neither folders nor files pass through the driver. Names that
    start with `_` or `.` are skipped, as Spark's readers do. `*`, `?` and `[..]` in the glob fit within
    a name, with upper and lower case apart. A folder without files gives no rows; a missing root is an
    error. A single folder is listed by one task.
    """
    tasks = spark.sparkContext.defaultParallelism
    system, path = opened(root)
    if system.get_file_info(path).type != fs.FileType.Directory:
        raise FileNotFoundError(f"{root} is not a folder")
    folders = spark.createDataFrame([(root,)], "path string")
    levels = []
    for depth in range(MAX_DEPTH):
        found = cut(_list_folders(folders.repartition(tasks, "path") if depth else folders))
        levels.append(found.filter("NOT is_folder"))
        folders = found.filter("is_folder").select("path")
        if folders.isEmpty():
            break
    else:
        raise RecursionError(f"{root} is more than {MAX_DEPTH} folders deep")
    files = levels[0]
    for level in levels[1:]:
        files = files.unionByName(level)
    if glob is not None:
        pattern = fnmatch.translate(glob)[:-2]  # without its end mark, which Java spells otherwise
        files = files.filter(F.col("name").rlike(rf"^{pattern}\z"))
    return files.select("path", "name", "size", "modified")


def read_each(
    files: DataFrame, read: Callable[[pa.NativeFile, int], tuple], schema: str, parallelism: int | None = None
) -> DataFrame:
    """`read(file, size)` of every listed file, as columns beside its path. A file that cannot be opened
    or read gives nulls. Rows are spread by path, since listings come folder by folder."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(f"path string, {schema}"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    system, inner = opened(path)
                    with system.open_input_file(inner) as file:
                        rows.append((path, *read(file, file.size())))
                except (OSError, ValueError):
                    rows.append((path, *[None] * (len(arrow) - 1)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)

    tasks = parallelism or files.sparkSession.sparkContext.defaultParallelism
    return files.select("path").repartition(tasks, "path").mapInArrow(scan, f"path string, {schema}")


def digests(files: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(path, md5, sha256) of every listed file, read `chunk` bytes at a time, so its length is not
    bounded by a row or by memory."""

    def read(file: pa.NativeFile, size: int) -> tuple:
        md5, sha = hashlib.md5(), hashlib.sha256()
        while part := file.read(chunk):
            md5.update(part)
            sha.update(part)
        return md5.hexdigest(), sha.hexdigest()

    return read_each(files, read, "md5 string, sha256 string")


def write_each(rows: DataFrame, root: str, name_col: str = "name", content_col: str = "content") -> DataFrame:
    """Write every row's content to `root`/name, folders included, and return (path, size), written.
    A repeated task writes the same bytes again; two rows of one name leave one of them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        made = set()
        for batch in batches:
            paths, sizes = [], []
            # a row at a time becomes an object of Python
            for name, content in ((n.as_py(), c.as_py()) for n, c in zip(batch.column(0), batch.column(1))):
                folder = posixpath.dirname(f"{base.rstrip('/')}/{name}")
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(f"{base.rstrip('/')}/{name}") as out:
                    out.write(content or b"")
                paths.append(f"{root.rstrip('/')}/{name}")
                sizes.append(len(content or b""))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "size"])

    return cut(rows.select(name_col, F.col(content_col).cast("binary")).mapInArrow(scan, "path string, size long"))

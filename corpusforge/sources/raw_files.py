"""A Spark data source for folders of raw article files.

One JSON object per file, named ``{source}_{epoch}_{category}.json`` (T19).
Rows are ``file, source, epoch, category, value``: what the name says, and the
file's content.  The name's parts are percent-encoded, so a site or category
may hold any character, null included (an empty part; the empty text is ``%``).

* Scan: the options ``sources``, ``categories`` (JSON lists), ``since``, ``until`` and ``pattern`` are answered from
  the names, so files that they exclude are never opened.  A file with another name has null parts, which no
  option takes.  They are options and not pushed filters: Spark 4.1 keeps the filters pushed to a Python
  source in one place per load, so two filters on the same load, joined in one query, would mix.
* Sink: every task attempt writes a folder of its own, and the commit lists
  the folders of the tasks that succeeded in one manifest.  Scans follow the manifests (and read
  files that lie in the folder itself), so what a failed or repeated task left is never read; an abort deletes it.

The folder may be on any file system that pyarrow can open.
"""

from __future__ import annotations

import json
import re
import uuid
from fnmatch import fnmatchcase
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

SCHEMA = "file string, source string, epoch long, category string, value string"
NAME = re.compile(r"([^_]*)_([0-9]{1,18})_([^_]*)\.json")
MANIFESTS = "_committed"
FILES = 1000  # loose files in a partition of the scan


def part(text: str | None) -> str:
    """A source or category as a part of a file name."""
    if text is None:
        return ""
    return quote(text, safe="").replace("_", "%5F").replace(".", "%2E") or "%"


def _unpart(name: str) -> str | None:
    return {"": None, "%": ""}.get(name, unquote(name))


def parts(file: str) -> dict:
    """What a file's name says; null parts if it is named otherwise."""
    m = NAME.fullmatch(re.sub(r"\.[0-9]+\.json$", ".json", file))
    return {"source": _unpart(m[1]), "epoch": int(m[2]), "category": _unpart(m[3])} if m else dict.fromkeys(("source", "epoch", "category"))


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _files(fs: pafs.FileSystem, folder: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == pafs.FileType.File and f.base_name.endswith(".json"))


@dataclass
class Files(ds.InputPartition):
    folder: str  # below the source's folder
    names: list[str] | None  # None: all of the folder's, listed by the task


class Reader(ds.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.pattern = options["path"], options.get("pattern", "*")
        self.among = {k: set(json.loads(options[name])) for k, name in (("source", "sources"), ("category", "categories")) if name in options}
        self.since, self.until = (int(options[k]) if k in options else None for k in ("since", "until"))

    def wanted(self, named: dict) -> bool:
        """Whether a file may be read; ``since`` is included, ``until`` is not."""
        if any(named[k] is None or named[k] not in held for k, held in self.among.items()):
            return False
        if self.since is None and self.until is None:
            return True
        at = named["epoch"]
        return at is not None and (self.since is None or at >= self.since) and (self.until is None or at < self.until)

    def partitions(self) -> list[Files]:
        fs, root = _open(self.path)
        out = []
        for manifest in _files(fs, f"{root}/{MANIFESTS}"):
            with fs.open_input_stream(f"{root}/{MANIFESTS}/{manifest}") as f:
                out += [Files(folder, None) for folder in json.loads(f.read())]
        loose = [n for n in _files(fs, root) if self.wanted(parts(n))]
        out += [Files("", loose[i:i + FILES]) for i in range(0, len(loose), FILES)]
        return out or [Files("", [])]

    def content(self, fs: pafs.FileSystem, path: str) -> str:
        with fs.open_input_stream(path) as f:
            return f.read().decode("utf-8", "replace")

    def read(self, partition: Files) -> Iterator[tuple]:
        fs, root = _open(self.path)
        folder = f"{root}/{partition.folder}".rstrip("/")
        for name in _files(fs, folder) if partition.names is None else partition.names:
            named = parts(name)
            if fnmatchcase(name, self.pattern) and self.wanted(named):
                yield (f"{folder}/{name}", named["source"], named["epoch"], named["category"], self.content(fs, f"{folder}/{name}"))


@dataclass
class Written(ds.WriterCommitMessage):
    folder: str


class Writer(ds.DataSourceWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        fs, root = _open(self.path)
        task = TaskContext.get()
        folder = f"job-{self.job}/task-{task.partitionId()}-{task.taskAttemptId()}"
        fs.create_dir(f"{root}/{folder}", recursive=True)
        seen: dict[str, int] = {}
        for row in iterator:
            stem = f"{part(row.source)}_{row.epoch}_{part(row.category)}" if row.epoch is not None and row.epoch >= 0 else "unnamed"
            k = seen[stem] = seen.get(stem, -1) + 1
            with fs.open_output_stream(f"{root}/{folder}/{stem}{f'.{k}' if k else ''}.json") as f:
                f.write((row.value or "").encode())
        return Written(folder)

    def commit(self, messages: list) -> None:
        fs, root = _open(self.path)
        old = _files(fs, f"{root}/{MANIFESTS}") if self.overwrite else []
        fs.create_dir(f"{root}/{MANIFESTS}", recursive=True)
        text = json.dumps(sorted(m.folder for m in messages if m is not None))
        # the manifest appears whole: it is written beside its place and moved
        with fs.open_output_stream(f"{root}/{MANIFESTS}/{self.job}.part") as f:
            f.write(text.encode())
        fs.move(f"{root}/{MANIFESTS}/{self.job}.part", f"{root}/{MANIFESTS}/{self.job}.json")
        for name in old:  # an overwrite hides what earlier jobs committed once its own manifest stands
            fs.delete_file(f"{root}/{MANIFESTS}/{name}")

    def abort(self, messages: list) -> None:
        fs, root = _open(self.path)
        if fs.get_file_info(f"{root}/job-{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/job-{self.job}")


class RawFiles(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "raw_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], overwrite)


def scan(spark: SparkSession, path: str, sources: list[str] | None = None, categories: list[str] | None = None,
         since: int | None = None, until: int | None = None, pattern: str | None = None) -> DataFrame:
    """``file, source, epoch, category, value`` of the raw files, of these sites and categories, ``since <= epoch < until``, named like ``pattern``."""
    spark.dataSource.register(RawFiles)
    wanted = {"sources": None if sources is None else json.dumps(sources), "categories": None if categories is None else json.dumps(categories),
              "since": since, "until": until, "pattern": pattern}
    return spark.read.format("raw_files").options(**{k: v for k, v in wanted.items() if v is not None}).load(path)


def save(rows: DataFrame, path: str, mode: str = "append") -> None:
    """K1: ``source, epoch, category, value`` as one file per row; rows of one name get numbers, a null or negative epoch a name without parts."""
    rows.sparkSession.dataSource.register(RawFiles)
    rows.selectExpr("cast(source AS string) AS source", "cast(epoch AS long) AS epoch", "cast(category AS string) AS category",
                    "cast(value AS string) AS value").write.format("raw_files").mode(mode).save(path)

"""ZIP archives of delimited text as a Spark data source, planned by members.

``spark.read.format("zip_members")`` plans from the archives' central
directories, which name every member with its offset and sizes, so an archive is
read by as many tasks as it has members. Where there are many small members, a
task reads several in turn (``bundles``): starting a task costs more than a small
member. A task opens its members' ranges of the archives, inflates them as
streams and decodes them by Arrow in blocks: neither an archive nor a member is
ever whole in memory, and there is no limit on size.

Options: ``path`` (a file or a folder), ``glob`` (names in a folder),
``encoding``, ``delimiter``, ``quoted`` (false: quotes are ordinary text),
``suffix`` (members with this ending only), ``first`` (true: the first member
only), ``header_prefix`` (names that a member's header must start with,
separated by ``|``). Empty members are skipped. Bytes that are not in the
encoding fail the task. One row per record after the header, as text cells;
records of any number of cells are kept.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pricepanel.session import ship_package

SCHEMA = "path string, member string, row_no long, header array<string>, row array<string>"
BLOCK_BYTES = 4 << 20
CELLS = pa.list_(pa.string())


#: Inflated bytes of the small members that one task reads, and tasks that members are spread over first.
BUNDLE_BYTES = 16 << 20
LEAST_TASKS = 64


@dataclass
class Member:
    """One member of one archive, with its inflated size."""

    path: str
    name: str
    index: int
    size: int


@dataclass
class Bundle(InputPartition):
    """The members that one task reads."""

    members: list[Member]


def bundles(members: list[Member]) -> list[Bundle]:
    """Neighbouring members up to a task's share of the bytes; a larger member is a task of its own."""
    share = min(BUNDLE_BYTES, sum(m.size for m in members) // LEAST_TASKS)
    out: list[Bundle] = []
    held = 0
    for m in members:
        if not out or held + m.size > share:
            out.append(Bundle([]))
            held = 0
        out[-1].members.append(m)
        held += m.size
    return out


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path (a local path or a URI) and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def archive_paths(path: str, glob: str) -> list[str]:
    """The archives under a folder, or the file itself, as given by ``path``."""
    store, inner = open_store(path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [path]
    found = store.get_file_info(fs.FileSelector(inner, recursive=True))
    below = sorted(f.path for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, glob) and not f.base_name.startswith((".", "_")))
    return [path.rstrip("/") + p[len(inner.rstrip("/")):] for p in below]


def members_of(path: str, suffix: str, first: bool) -> list[Member]:
    """The members that hold rows, from the archive's central directory (a read at its end)."""
    store, inner = open_store(path)
    with store.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
        listed = list(enumerate(archive.infolist()))[:1 if first else None]
        return [Member(path, m.filename, i, m.file_size) for i, m in listed if m.file_size and m.filename.lower().endswith(suffix)]


def _clean(cell: str) -> str:
    return cell.strip().lstrip("﻿")


class MemberReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.glob = options.get("glob", "*.zip")
        self.encoding = options.get("encoding", "cp949")
        self.delimiter = options.get("delimiter", ",")
        self.quoted = options.get("quoted", "true") == "true"
        self.suffix = options.get("suffix", "").lower()
        self.first = options.get("first", "false") == "true"
        self.prefix = [p for p in options.get("header_prefix", "").split("|") if p]

    def partitions(self):
        paths = archive_paths(self.path, self.glob)
        with ThreadPoolExecutor(16) as pool:
            listed = pool.map(lambda p: members_of(p, self.suffix, self.first), paths)
            return bundles([m for ms in listed for m in ms])

    def _cells(self, lines) -> list[list[str]]:
        return list(csv.reader(lines, delimiter=self.delimiter, quoting=csv.QUOTE_MINIMAL if self.quoted else csv.QUOTE_NONE))

    def _header(self, archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> list[str] | None:
        with archive.open(info) as raw:
            text = io.TextIOWrapper(raw, encoding=self.encoding, errors="strict", newline="")
            return next(csv.reader(text, delimiter=self.delimiter, quoting=csv.QUOTE_MINIMAL if self.quoted else csv.QUOTE_NONE), None)

    def read(self, partition: Bundle) -> Iterator[pa.RecordBatch]:
        for member in partition.members:
            yield from self._read_member(member)

    def _read_member(self, partition: Member) -> Iterator[pa.RecordBatch]:
        store, inner = open_store(partition.path)
        with store.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
            info = archive.infolist()[partition.index]
            header = self._header(archive, info)
            if header is None:
                return
            if [_clean(h) for h in header[:len(self.prefix)]] != self.prefix:
                raise ValueError(f"{partition.path}!{partition.name}: the header starts with {header[:len(self.prefix)]}, not {self.prefix}")
            with archive.open(info) as member:
                yield from self._batches(partition, header, member)

    def _batches(self, partition: Member, header: list[str], member) -> Iterator[pa.RecordBatch]:
        names = [f"c{i}" for i in range(len(header))]
        other: list[str] = []  # records of more or fewer cells than the header, as text

        def keep(row) -> str:
            other.append(row.text)
            return "skip"

        blocks = pyarrow.csv.open_csv(
            member,
            pyarrow.csv.ReadOptions(use_threads=False, block_size=BLOCK_BYTES, encoding=self.encoding, column_names=names, skip_rows_after_names=1),
            pyarrow.csv.ParseOptions(delimiter=self.delimiter, quote_char='"' if self.quoted else False, newlines_in_values=self.quoted,
                                     invalid_row_handler=keep),
            pyarrow.csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False))
        done = 0
        for block in blocks:
            n, width = block.num_rows, len(names)
            order = np.arange(n * width).reshape(width, n).T.ravel()
            flat = pa.concat_arrays([block.column(i) for i in range(width)]).take(pa.array(order))
            yield self._batch(partition, header, done, pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), flat))
            done += n
            if other:
                cells, other[:] = self._cells(other), []
                yield self._batch(partition, header, done, pa.array(cells, CELLS))
                done += len(cells)
        if other:
            yield self._batch(partition, header, done, pa.array(self._cells(other), CELLS))

    def _batch(self, partition: Member, header: list[str], done: int, rows: pa.Array) -> pa.RecordBatch:
        n = len(rows)

        def same(value, kind) -> pa.Array:
            return pa.array([value], kind).take(pa.array(np.zeros(n, np.int64)))

        return pa.RecordBatch.from_arrays(
            [same(partition.path, pa.string()), same(partition.name, pa.string()), pa.array(np.arange(done + 1, done + n + 1)),
             same(header, CELLS), rows.cast(CELLS)], ["path", "member", "row_no", "header", "row"])


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MemberReader:
        return MemberReader(self.options)


def read_members(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Rows of the members of the archives at ``path`` (a file or a folder)."""
    ship_package(spark)
    spark.dataSource.register(ZipMembers)
    return spark.read.format("zip_members").options(**options).load(path)

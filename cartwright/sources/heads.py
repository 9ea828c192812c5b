"""Heads of CSV files: every file's size, first line and header.

A drop is a folder or a set of files whose parts may be empty, end their lines
in their own way, carry a byte-order mark or have headers of their own.  Spark's
CSV reader takes one header for all files of a path, so what each file really
starts with has to be known before they are read.

Spark lists the files, as it would to read them, and the first bytes of each
are fetched through its Hadoop file systems, ``THREADS`` files at a time: no
data is scanned (none of Spark's readers stops after a file's first line), and
a header a file is kept on the driver, which holds the list of files anyway.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from cartwright.sources.fs import first_bytes

BOM = b"\xef\xbb\xbf"
FIRST, LONGEST = 1 << 16, 1 << 24   # bytes fetched for a header: at first, and at most
THREADS = 16


class UnclosedQuote(ValueError):
    """A header line that ends inside a quoted name."""


@dataclass(frozen=True)
class FileHead:
    path: str
    size: int
    first_line: bytes | None = None     # the first with text in it, without its line end; None: there is none
    head_bytes: int = 0                 # up to the end of that line, byte-order mark and blank lines before it included
    error: str = ""                     # why the file could not be read

    def header(self) -> tuple[str, ...]:
        """Column names without white space around them."""
        line = (self.first_line or b"").decode("utf-8", "replace")
        if line.count('"') % 2:
            raise UnclosedQuote(f"{self.path}: the header's quotes are not closed")
        rows = list(csv.reader([line]))
        return tuple(c.strip(" \t") for c in rows[0]) if rows else ()


@dataclass(frozen=True)
class HeaderGroup:
    """Files that start with the same header."""
    header: tuple[str, ...]
    files: tuple[FileHead, ...]

    @property
    def paths(self) -> list[str]:
        return [f.path for f in self.files]

    @property
    def columns(self) -> list[int]:
        """Places of the columns that a name stands for: of a name that occurs
        more than once, the first."""
        first = {}
        for k, c in enumerate(self.header):
            first.setdefault(c, k)
        return sorted(first.values())

    @property
    def duplicates(self) -> list[str]:
        return sorted({c for c in self.header if self.header.count(c) > 1})


@dataclass
class Heads:
    """What a table's files start with."""
    groups: list[HeaderGroup] = field(default_factory=list)     # largest first
    empty: list[FileHead] = field(default_factory=list)         # without a line of text
    unreadable: dict[str, str] = field(default_factory=dict)    # path: why

    @property
    def header(self) -> list[str]:
        """The names of all groups, those of the largest first."""
        return list(dict.fromkeys(c for g in self.groups for c in g.header))

    @property
    def duplicates(self) -> list[str]:
        return sorted({c for g in self.groups for c in g.duplicates})


def first_line(prefix: bytes, whole: bool) -> tuple[bytes | None, int] | None:
    """(the first line with text in it, the bytes up to its end) of a file
    that starts with ``prefix``; (None, bytes) if it has none, None if the line
    does not end in it.  Lines end in LF, CR LF or CR."""
    at = len(BOM) if prefix.startswith(BOM) else 0
    while at < len(prefix):
        ends = [k for k in (prefix.find(b"\n", at), prefix.find(b"\r", at)) if k >= 0]
        if not ends and not whole:
            return None
        end = min(ends, default=len(prefix))
        after = end + (2 if prefix[end:end + 2] == b"\r\n" else 1 if ends else 0)
        if prefix[at:end].strip():
            return prefix[at:end], after
        at = after
    return (None, at) if whole else None


def _head(spark: SparkSession, path: str) -> FileHead:
    size, wanted = 0, FIRST
    try:
        while True:
            prefix, size = first_bytes(spark, path, wanted)
            if (found := first_line(prefix, len(prefix) < wanted)) is not None:
                return FileHead(path, size, *found)
            if wanted >= LONGEST:
                return FileHead(path, size, error=f"{path}: the first line does not end in {LONGEST} bytes")
            wanted *= 16
    except Py4JJavaError as err:
        return FileHead(path, size, error=f"{path}: {str(err.java_exception).splitlines()[0]}")


def file_heads(spark: SparkSession, path: str) -> list[FileHead]:
    """The heads of the files that Spark reads at a path (file, folder, glob);
    a file that cannot be read has an ``error``."""
    files = [unquote(f) for f in spark.read.text(path).inputFiles()]
    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(lambda f: _head(spark, f), files))


def group_heads(files: list[FileHead]) -> Heads:
    """Files by their header; of one header in order of their paths."""
    heads, groups = Heads(), {}
    for f in sorted(files, key=lambda f: f.path):
        if f.error:
            heads.unreadable[f.path] = f.error
            continue
        if f.first_line is None:
            heads.empty.append(f)
            continue
        try:
            groups.setdefault(f.header(), []).append(f)
        except (UnclosedQuote, csv.Error) as err:
            heads.unreadable[f.path] = str(err)
    heads.groups = sorted((HeaderGroup(h, tuple(fs)) for h, fs in groups.items()),
                          key=lambda g: (-sum(f.size for f in g.files), g.header))
    return heads

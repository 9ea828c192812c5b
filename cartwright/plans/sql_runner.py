"""Run report SQL files against the registered analytics views.

A ``*.sql`` file holds any number of statements, parted by ``;`` outside
quotes and comments.  Files without a query (views, settings) run first, then
the others, both in name order; statements run in the order in which they
stand.  A file's query becomes a lazy report DataFrame under the file's stem
(``stem_1``, ``stem_2``, ... where it has several).  The folder is read through
the session's Hadoop file systems; planning and execution are Spark's.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cartwright.plans.analytics import register_views
from cartwright.sources.fs import list_files, read_text

#: Report statements that come with the library, on the driver's own disk.
PACKAGED_SQL = "file://" + os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "sql")

# The words that a statement which returns rows starts with.
QUERY_WORDS = frozenset({"select", "with", "values", "from", "table", "map", "reduce", "(", "show", "describe", "desc", "explain"})

# What stands between statements' ends: line comments, openings of block
# comments, quoted text and names (a quote inside is doubled or, in text,
# escaped), the ends, and anything else.
PIECE = re.compile(r"""
    (?P<line>--[^\n]*)
  | (?P<block>/\*)
  | (?P<quoted>'(?:[^'\\]|\\.|'')*' | "(?:[^"\\]|\\.|"")*" | `(?:[^`]|``)*`)
  | (?P<end>;)
  | (?P<open>['"`])
  | (?P<word>[A-Za-z_]+|\()
  | (?P<other>\s+|.)
""", re.X | re.S)


class BrokenSql(ValueError):
    """A file whose text ends inside a quote or a comment."""


@dataclass(frozen=True)
class Statement:
    text: str
    first_word: str     # lower case; "(" where it starts with one

    @property
    def is_query(self) -> bool:
        return self.first_word in QUERY_WORDS


def _block_end(text: str, at: int) -> int:
    """Where the block comment that opens before ``at`` ends; they nest."""
    depth = 1
    for m in re.compile(r"/\*|\*/").finditer(text, at):
        depth += 1 if m[0] == "/*" else -1
        if not depth:
            return m.end()
    raise BrokenSql("a comment is not closed")


def split_statements(text: str) -> list[Statement]:
    """The statements of a file, without their ends; what has nothing but
    comments and white space is none."""
    out, start, first, at = [], 0, "", 0
    while at < len(text):
        m = PIECE.match(text, at)
        at = m.end()
        if m["block"]:
            at = _block_end(text, at)
        elif m["open"]:
            raise BrokenSql(f"a quote is not closed: {text[m.start():m.start() + 40]}")
        elif m["end"]:
            if first:
                out.append(Statement(text[start:m.start()].strip(), first))
            start, first = at, ""
        elif not first and not m["line"] and m[0].strip():
            first = m[0].lower()
    if first:
        out.append(Statement(text[start:].strip(), first))
    return out


def read_statements(spark: SparkSession, path: str) -> list[Statement]:
    try:
        return split_statements(read_text(spark, path).removeprefix("﻿"))
    except BrokenSql as err:
        raise BrokenSql(f"{path}: {err}") from None


def run_sql_files(spark: SparkSession, analytics: DataFrame, sql_dir: str = PACKAGED_SQL) -> dict[str, DataFrame]:
    register_views(spark, analytics)
    files = {os.path.splitext(os.path.basename(f))[0]: read_statements(spark, f)
             for f in list_files(spark, sql_dir, ".sql")}
    reports: dict[str, DataFrame] = {}
    for name, statements in sorted(files.items(), key=lambda x: (any(s.is_query for s in x[1]), x[0])):
        several, count = sum(s.is_query for s in statements) > 1, 0
        for s in statements:
            result = spark.sql(s.text)
            if s.is_query:
                count += 1
                reports[f"{name}_{count}" if several else name] = result
    return reports

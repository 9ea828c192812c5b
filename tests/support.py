"""Helpers that the test modules import (conftest.py holds fixtures only)."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), sorted."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)

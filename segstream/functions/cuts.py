"""Column functions for stream cuts.

A cut (one position per segment) is a ``map<bigint,bigint>`` column, or a
Python ``dict`` on the driver; its text form is canonical JSON with segment
ids as keys in numeric order, e.g. ``{"0":10,"1":20}``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CUT_TYPE = "map<bigint,bigint>"


def cut_from_json(text) -> Column:
    """Parse cut text; JSON object keys are strings, so parse those and cast."""
    c = F.col(text) if isinstance(text, str) else text
    return F.transform_keys(F.from_json(c, "map<string,bigint>"), lambda k, v: k.cast("bigint"))


def cut_to_json(cut) -> Column:
    """Canonical text of a cut column: entries sorted by segment id."""
    c = F.col(cut) if isinstance(cut, str) else cut
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c))))

"""Parse text lines that hold a printed tuple, e.g. ``('20001', '7', '2', '1999', '0.25')``.

Quotes, parentheses and blanks are deleted, the rest is split on commas and each field is cast
(ANSI-safe: a bad field gives NULL). No per-line Python evaluation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRIP_CHARS = "'() "


def parse_tuple_text(df: DataFrame, fields: Sequence[tuple[str, str]], col: str = "value",
                     cut_at_dot: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """``fields`` = ``[(name, type), ...]`` in tuple order; ``cut_at_dot`` names fields whose text
    is cut at the first dot before the cast (``'1001.0'`` -> ``'1001'``)."""
    parts = F.split(F.translate(F.col(col), STRIP_CHARS, ""), ",")
    out = []
    for i, (name, typ) in enumerate(fields):
        raw = F.get(parts, i)
        if name in set(cut_at_dot):
            raw = F.substring_index(raw, ".", 1)
        out.append((raw if typ == "string" else raw.try_cast(typ)).alias(name))
    return df.select(*keep, *out)


def read_tuple_text(spark, paths, fields, cut_at_dot=()) -> DataFrame:
    return parse_tuple_text(spark.read.text(paths), fields, cut_at_dot=cut_at_dot)

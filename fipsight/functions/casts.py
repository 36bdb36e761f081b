"""ANSI-safe casts and text flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(col, finite_only: bool = True) -> Column:
    """Number parsed from text or NULL (blank, garbage). NaN / infinity are rejected by default."""
    d = _col(col).try_cast("double")
    if not finite_only:
        return d
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def finite(name: str) -> Column:
    """A numeric (or numeric text) column as double; NaN, infinity and garbage are NULL (NaN is above infinity)."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.expr(f"CASE WHEN abs(try_cast({quoted} AS DOUBLE)) < double('infinity') THEN try_cast({quoted} AS DOUBLE) END")


def safe_long(col) -> Column:
    """Integer parsed from text, or NULL."""
    return _col(col).try_cast("bigint")


def int_code(col) -> Column:
    """Whole number of a code column of any type (12, 12.0, '12', '12.0'), or NULL."""
    d = safe_double(_col(col).cast("string"))
    return F.when(d == F.floor(d), d).try_cast("int")


def equals_flag(col, value: str) -> Column:
    """1 when the text equals ``value`` (e.g. side ``'R'``), else 0 (NULL included)."""
    return F.when(_col(col) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def bool_text_flag(col, false_text: str = "False") -> Column:
    """0 for the literal false text, 1 for anything else (NULL and other text included)."""
    return F.when(_col(col) == F.lit(false_text), F.lit(0)).otherwise(F.lit(1))


def unparsed(df: DataFrame, parsed: dict[str, Column], by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``(by, column_name, n_bad, example)``: for each column how many values are there (not blank) but are
    lost by its parsing expression, with the least of them. Columns without such values give no row. One
    aggregate over the rows, nothing is collected."""
    lost = {c: F.when((F.trim(F.col(c).cast("string")) != "") & p.isNull(), F.col(c).cast("string")) for c, p in parsed.items()}
    names = list(lost)
    table = df.groupBy(*by).agg(*[x for i, c in enumerate(names)
                                  for x in (F.count(lost[c]).alias(f"_n{i}"), F.min(lost[c]).alias(f"_e{i}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("n_bad"), F.col(f"_e{i}").alias("example"))
                     for i, c in enumerate(names)])
    return table.select(*by, F.inline(rows)).where("n_bad > 0")


def type_report(df: DataFrame, columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """``(column_name, n, n_integer, n_number, n_text, kind, example)`` of the string columns, from one aggregate:
    ``n`` values that are not blank, how many are whole numbers, other numbers, other text; ``kind`` is the
    least type that holds them all (bigint within double within string; string without any value), and
    ``example`` the least value that rules out the next narrower type."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (columns is None or f.name in set(columns))]
    if not names:
        return df.sparkSession.createDataFrame([], _REPORT)
    aggs = []
    for i, c in enumerate(names):
        there = F.trim(F.col(c)) != ""
        whole, number = F.col(c).try_cast("bigint").isNotNull(), F.col(c).try_cast("double").isNotNull()
        aggs += [F.count_if(there).alias(f"_n{i}"), F.count_if(there & whole).alias(f"_i{i}"), F.count_if(there & ~whole & number).alias(f"_d{i}"),
                 F.min(F.when(there & ~number, F.col(c))).alias(f"_t{i}"), F.min(F.when(there & ~whole & number, F.col(c))).alias(f"_f{i}")]
    rows = []
    for i, c in enumerate(names):
        n, whole, number = (F.col(f"_{x}{i}") for x in "nid")
        text = n - whole - number
        kind = F.when((n == 0) | (text > 0), "string").when(number > 0, "double").otherwise("bigint")
        rows.append(F.struct(F.lit(c).alias("column_name"), n.alias("n"), whole.alias("n_integer"), number.alias("n_number"),
                             text.alias("n_text"), kind.alias("kind"), F.coalesce(f"_t{i}", f"_f{i}").alias("example")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


_REPORT = "column_name string, n long, n_integer long, n_number long, n_text long, kind string, example string"


def cell_typed(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """The string ``columns`` as VARIANT, every cell with its own type: a whole number, another finite or
    infinite number, or the text as it is (blank text too); NULL stays NULL. Nothing is looked up in the
    data, so a column may hold numbers in one file and words in another."""
    def typed(c: str) -> Column:
        v = F.col(c)
        return F.coalesce(v.try_cast("bigint").cast("variant"), v.try_cast("double").cast("variant"), v.cast("variant"))

    return df.select(*[typed(c).alias(c) if c in set(columns) else F.col(f"`{c}`") for c in df.columns])


def try_typed(df: DataFrame, keep_text: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Give every string column a numeric type where all its values allow it.

    A string column becomes ``bigint`` if every non-NULL value parses as an integer, else
    ``double`` if every one parses as a number; otherwise it stays text. Columns in ``keep_text``
    (ids such as ``'1-0-3'`` that merely look numeric) are never converted. The decision needs one
    aggregate job over the string columns (counts only, partial aggregation, no shuffle of rows).
    """
    cand = [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in set(keep_text)]
    if not cand:
        return df
    kinds = {r.column_name: r.kind if r.n else "bigint" for r in type_report(df, cand).collect()}  # one row a column
    return df.select(*[F.col(c).try_cast(kinds[c]).alias(c) if kinds.get(c, "string") != "string" else F.col(c)
                       for c in df.columns])

"""County keys and composite ids (string building, no casts that can raise)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fipsight.functions.casts import _col, int_code, safe_double


def pad_min(col, width: int, fill: str = "0") -> Column:
    """Left-pad to ``width``; text already at least that long is kept whole.

    ``lpad`` alone truncates longer text (``lpad('12345', 3) = '123'``), so it is only applied
    to shorter values.
    """
    c = _col(col).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def fips_from_parts(state, county) -> Column:
    """Five-digit county key: state padded to 2 followed by county padded to 3."""
    return F.concat(pad_min(state, 2), pad_min(county, 3))


def fips_from_float_text(col) -> Column:
    """Key written as a float (``'1001.0'``) to integer text; one leading zero is added only when
    the integer has 4 digits (so 3-digit state-level ids stay short and can be filtered out).
    Text that is not a number gives NULL."""
    as_int = F.expr("try_cast(try_cast({} as double) as bigint)".format(_sql(col)))
    txt = as_int.cast("string")
    return F.when(F.length(txt) == 4, F.concat(F.lit("0"), txt)).otherwise(txt)


def composite_id(case_col, year_col) -> Column:
    """Accident id: integer case number followed by the integer year (``'1002' ‖ '2008'``). Numbers
    may be written as floats (``12.0``); anything else gives NULL."""
    case = F.coalesce(_col(case_col).cast("string").try_cast("bigint"),
                      safe_double(_col(case_col).cast("string")).try_cast("bigint"))
    return F.concat(case.cast("string"), int_code(year_col).cast("string"))


def year_of_id(id_col) -> Column:
    """Year encoded in the last four characters of a composite id."""
    return F.expr("try_cast(right({}, 4) as int)".format(_sql(id_col)))


def _sql(col) -> str:
    if isinstance(col, str):
        return "`" + col.replace("`", "``") + "`"
    raise TypeError("pass a column name for SQL-expression helpers")

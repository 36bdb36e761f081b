"""Column expressions: pure functions from Columns to a Column (no DataFrame, no action)."""

from fipsight.functions.casts import bool_text_flag, equals_flag, safe_double, safe_long
from fipsight.functions.clock import (day_of_year0, hours_between, parse_timestamp,
                                      response_minutes)
from fipsight.functions.keys import (composite_id, fips_from_float_text, fips_from_parts,
                                     pad_min, year_of_id)
from fipsight.functions.tails import t_tail

__all__ = [
    "bool_text_flag", "equals_flag", "safe_double", "safe_long", "day_of_year0", "hours_between",
    "parse_timestamp", "response_minutes", "composite_id", "fips_from_float_text",
    "fips_from_parts", "pad_min", "year_of_id", "t_tail",
]

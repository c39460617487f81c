"""Column expressions: all native Spark, none of them a UDF."""

from chartframes.functions.cleaning import (
    checked_label,
    currency,
    degrees,
    label_violations,
    number_or,
    safe_cast,
    strict_cast,
)
from chartframes.functions.conditions import (
    bin_label,
    choose,
    fill_from,
    first_match,
    flag,
    others,
    same_text,
    within,
)
from chartframes.functions.dates import (
    calendar_parts,
    date_of,
    iso_week,
    localize,
    parse_date,
    parse_datetime,
    weekday_number,
    year_month,
)
from chartframes.functions.numbers import (
    convert,
    floor_divide,
    mean_of,
    percent_columns,
    ratio_percent,
    sum_across,
)
from chartframes.functions.text import (
    bold_label,
    pad_end,
    replace_all,
    replace_first,
    replace_literal,
    slice_text,
    split_get,
    title_case,
    wrap_text,
    zero_pad,
)

__all__ = [name for name in dir() if not name.startswith("_")]

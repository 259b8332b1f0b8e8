"""Column factories: every function returns a Column and runs in the JVM."""

from tablewright.functions.arrays import (
    append_columns,
    append_when,
    as_list,
    fill_missing_list,
    first_element,
    list_length,
    list_of_struct,
    remove_nulls,
    zip_structs,
)
from tablewright.functions.conditional import (
    add_number,
    age_in_years,
    bucket_label,
    cast_column,
    compare,
    extract_when,
    fill_empty,
    flag_when,
    is_empty,
    is_not_empty,
    map_values,
    percent_change,
    price_difference,
    price_tier,
    replace_when,
    scale_to_priority,
    subtract_number,
)
from tablewright.functions.dates import iso_date, to_date_value, year_of
from tablewright.functions.display import display_value
from tablewright.functions.strings import (
    append_text,
    capitalize,
    collapse_whitespace,
    concat_columns,
    concat_present,
    contains_text,
    extract_pattern,
    first_character,
    lower,
    matches_pattern,
    normalise_name,
    prepend_text,
    replace_pattern,
    replace_text,
    replace_value,
    split_text,
    strip,
    title_case,
    upper,
)

__all__ = [name for name in dir() if not name.startswith("_")]

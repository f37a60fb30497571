from tripmart.functions.casts import field_type, number_text, safe_cast, to_integer, to_numeric, to_timestamp
from tripmart.functions.keys import key_text, surrogate_key
from tripmart.functions.periods import last_published_month, publication_date
from tripmart.functions.text import (
    code_label,
    coalesce_default,
    normalize_run_id,
    replace_literal,
    trip_file_name,
    url_basename,
)

__all__ = [
    "code_label",
    "coalesce_default",
    "field_type",
    "key_text",
    "last_published_month",
    "normalize_run_id",
    "number_text",
    "publication_date",
    "replace_literal",
    "safe_cast",
    "surrogate_key",
    "to_integer",
    "to_numeric",
    "to_timestamp",
    "trip_file_name",
    "url_basename",
]

"""Column functions: no function here starts a shuffle."""

from .columns import (  # noqa: F401
    date_parts,
    from_epoch,
    integer_div,
    micros,
    nan_to_null,
    parse_ts,
    seconds_between,
    sentinel_to_null,
    str_key,
)
from .text import (  # noqa: F401
    count_char,
    count_digits,
    list_to_text,
    pad_sequence,
    with_ngrams,
)

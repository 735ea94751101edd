from sellerlens.functions.columns import (
    as_of_column,
    cleaned,
    keyed_mask,
    masked,
    masked_prefix,
    open_interval,
    parsed_date,
    parsed_number,
    parsed_timestamp,
    ratio,
    trimmed,
)
from sellerlens.functions.colours import (
    complaint_colour,
    label_background,
    label_colour,
    label_text_colour,
    plot_colour,
    return_rate_colour,
    verification_colour,
)

__all__ = [
    "as_of_column",
    "cleaned",
    "complaint_colour",
    "keyed_mask",
    "label_background",
    "label_colour",
    "label_text_colour",
    "masked",
    "masked_prefix",
    "open_interval",
    "parsed_date",
    "parsed_number",
    "parsed_timestamp",
    "plot_colour",
    "ratio",
    "return_rate_colour",
    "trimmed",
    "verification_colour",
]

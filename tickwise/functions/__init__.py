from tickwise.functions.rounding import round_half_up, round_half_even
from tickwise.functions.parse import (
    parse_date, parse_integer, parse_iso_date, parse_number, is_finite, strip_text, canonical_upper,
)
from tickwise.functions.redact import redact_message

__all__ = [
    "round_half_up", "round_half_even", "parse_number", "parse_integer", "parse_date", "parse_iso_date", "is_finite",
    "strip_text", "canonical_upper", "redact_message",
]

"""Column expressions: keys, text standardisation, safe casts, metrics, calendar."""
from .keys import surrogate_key
from .text import clean, upper_clean, lower_clean, title_clean, phone_clean, join_names
from .casts import MONEY, PCT, parse_int, parse_decimal, parse_bool, parse_date, parsed_ok
from . import metrics, calendar

__all__ = [
    "surrogate_key", "clean", "upper_clean", "lower_clean", "title_clean",
    "phone_clean", "join_names", "MONEY", "PCT", "parse_int", "parse_decimal",
    "parse_bool", "parse_date", "parsed_ok", "metrics", "calendar",
]

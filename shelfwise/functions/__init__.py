from shelfwise.functions.calendar import calendar_columns, day_diff, iso_day_of_week, iso_week
from shelfwise.functions.cleaning import clean_cast
from shelfwise.functions.keys import business_key
from shelfwise.functions.masking import PRIVILEGED_ROLES, masked, nulled
from shelfwise.functions.numbers import bytes_to_gib, credits_to_money, line_amount, round_to
from shelfwise.functions.validity import quarantine_reason, sales_row_is_valid

__all__ = [
    "PRIVILEGED_ROLES",
    "business_key",
    "bytes_to_gib",
    "calendar_columns",
    "clean_cast",
    "credits_to_money",
    "day_diff",
    "iso_day_of_week",
    "iso_week",
    "line_amount",
    "masked",
    "nulled",
    "quarantine_reason",
    "round_to",
    "sales_row_is_valid",
]

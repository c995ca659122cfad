"""Calendar expressions on dates."""


def date_key(day: str) -> str:
    """20240131-style integer, by arithmetic so that it stays inside generated code."""
    return f"(YEAR({day}) * 10000 + MONTH({day}) * 100 + DAY({day}))"


def date_stamp(day: str) -> str:
    return f"DATE_FORMAT({day}, 'yyyyMMdd')"


def iso_day_of_week(day: str) -> str:
    """1 = Monday .. 7 = Sunday."""
    return f"(WEEKDAY({day}) + 1)"


def is_weekend(day: str) -> str:
    return f"(WEEKDAY({day}) >= 5)"


def is_holiday_season(day: str) -> str:
    return f"(MONTH({day}) = 12)"


def is_month_end(day: str) -> str:
    return f"({day} = LAST_DAY({day}))"


def is_quarter_end(day: str) -> str:
    return f"({is_month_end(day)} AND MONTH({day}) % 3 = 0)"


def is_year_end(day: str) -> str:
    return f"({is_month_end(day)} AND MONTH({day}) = 12)"


def fiscal_year(day: str) -> str:
    """The fiscal year starts in March and is named after the calendar year it starts in."""
    return f"YEAR(ADD_MONTHS({day}, -2))"


def fiscal_quarter(day: str) -> str:
    return f"QUARTER(ADD_MONTHS({day}, -2))"

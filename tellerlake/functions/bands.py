"""Bands and flags derived from single rows."""

# (exclusive upper bound, label) pairs, then the label above the last bound (fixed values).
AGE_BANDS = ((25, "Under 25"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"))
AGE_TOP = "65+"
AMOUNT_BANDS = (
    (100, "Under R100"),
    (500, "R100-R500"),
    (1000, "R500-R1k"),
    (5000, "R1k-R5k"),
    (20000, "R5k-R20k"),
)
AMOUNT_TOP = "Over R20k"
FRAUD_BANDS = ((0.3, "Low"), (0.6, "Medium"), (0.8, "High"))
FRAUD_TOP = "Critical"

# Transaction types that bring money in (fixed values).
CREDIT_TYPES = ("Salary Credit", "EFT Transfer In", "Reversal")
# Cities whose branches count as urban (fixed values).
MAJOR_CITIES = ("Johannesburg", "Cape Town", "Durban", "Pretoria")


def _band(value: str, bounds: tuple, top: str) -> str:
    """Label of the first bound above ``value``; nulls compare false and land in the top band."""
    cases = " ".join(f"WHEN {value} < {upper}D THEN '{label}'" for upper, label in bounds)
    return f"CASE {cases} ELSE '{top}' END"


def _listed(values: tuple) -> str:
    return ", ".join(f"'{value}'" for value in values)


def age_band(age: str) -> str:
    return _band(age, AGE_BANDS, AGE_TOP)


def amount_band(amount: str) -> str:
    return _band(amount, AMOUNT_BANDS, AMOUNT_TOP)


def fraud_risk_band(score: str) -> str:
    return _band(score, FRAUD_BANDS, FRAUD_TOP)


def is_completed(status: str) -> str:
    return f"{status} = 'Completed'"


def is_declined(status: str) -> str:
    return f"(CONTAINS({status}, 'Declined') OR {status} = 'Failed')"


def is_night(hour: str) -> str:
    return f"({hour} < 6 OR {hour} >= 22)"


def is_business_hours(hour: str) -> str:
    return f"{hour} BETWEEN 9 AND 17"


def is_debit_type(transaction_type: str) -> str:
    return f"{transaction_type} NOT IN ({_listed(CREDIT_TYPES)})"


def signed_amount(amount: str, is_debit: str) -> str:
    return f"IF({is_debit}, -{amount}, {amount})"


def branch_region(city: str) -> str:
    return f"IF({city} IN ({_listed(MAJOR_CITIES)}), 'Urban', 'Suburban')"

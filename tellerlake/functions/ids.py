"""Zero-padded business ids and their numeric part."""

import uuid

# Prefix and digits of each entity's id (fixed values).
ID_SHAPES = {
    "merchants": ("MER", 4),
    "customers": ("CUS", 6),
    "accounts": ("ACC", 7),
    "transactions": ("TXN", 9),
}


def format_id(entity: str, number: str) -> str:
    """Business id for a number; numbers wider than the padding keep all their digits."""
    prefix, digits = ID_SHAPES[entity]
    return f"FORMAT_STRING('{prefix}%0{digits}d', CAST({number} AS BIGINT))"


def id_number(business_id: str) -> str:
    """Trailing digits of an id as a number, null when there are none."""
    return f"TRY_CAST(REGEXP_EXTRACT({business_id}, '([0-9]+)$', 1) AS BIGINT)"


def short_reference(text: str) -> str:
    return f"UPPER(SUBSTRING({text}, 1, 8))"


def new_batch_id() -> str:
    """One id per run, made once on the driver and passed down as a literal."""
    return str(uuid.uuid4())

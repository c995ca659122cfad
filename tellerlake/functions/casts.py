"""Lenient casts from raw text: what cannot be read becomes null instead of failing the job."""

# Texts that stand for "no value" in raw CSV cells (fixed values).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = "^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"
_PLAIN_NUMBER = "^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+) *$"


def null_tokens_to_null(text: str) -> str:
    tokens = ", ".join(f"'{token}'" for token in NULL_TOKENS)
    return f"CASE WHEN {text} NOT IN ({tokens}) THEN {text} END"


def to_integer(text: str) -> str:
    """Integer from text; a decimal part is cut off ('1234.0' gives 1234)."""
    return f"CASE WHEN {text} RLIKE '{_PLAIN_NUMBER}' THEN TRY_CAST(TRY_CAST({text} AS DOUBLE) AS INT) END"


def to_double(text: str) -> str:
    """Double from text; not-a-number counts as missing."""
    return f"NANVL(TRY_CAST({text} AS DOUBLE), CAST(NULL AS DOUBLE))"


def to_boolean(text: str) -> str:
    return f"TRY_CAST({text} AS BOOLEAN)"


def to_day(text: str) -> str:
    """Date from strict yyyy-MM-dd text; a plain cast is several times faster than a formatter."""
    return f"IF({text} RLIKE '{_DAY}', TRY_CAST({text} AS DATE), NULL)"


def hour_of(text: str) -> str:
    """Hour from strict HH:mm:ss text."""
    return f"IF({text} RLIKE '{_TIME}', TRY_CAST(SUBSTRING({text}, 1, 2) AS INT), NULL)"

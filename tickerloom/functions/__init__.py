from .cells import (
    MISSING_TEXTS,
    clean_name,
    clean_name_column,
    date_from_text,
    finite_or_null,
    flatten_once,
    is_missing,
    is_missing_text,
    movement,
    number_from_text,
    split_csv_line,
)

__all__ = [
    "MISSING_TEXTS",
    "clean_name",
    "clean_name_column",
    "date_from_text",
    "finite_or_null",
    "flatten_once",
    "is_missing",
    "is_missing_text",
    "movement",
    "number_from_text",
    "split_csv_line",
]

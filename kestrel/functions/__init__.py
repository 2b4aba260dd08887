from kestrel.functions.columns import (
    bool_text_to_int,
    duration_seconds,
    element,
    epoch_seconds,
    is_missing,
    parse_vector,
    to_double,
    tokens,
    whole_division,
)

__all__ = [
    "bool_text_to_int",
    "duration_seconds",
    "element",
    "epoch_seconds",
    "is_missing",
    "parse_vector",
    "to_double",
    "tokens",
    "whole_division",
]

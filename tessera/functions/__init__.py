"""Column-level functions: the decimal codec and the type conformer."""

from .conform import conform_types, conformed_schema
from .decimals import (RESTORED_TYPE, TAG, UnsupportedTypeError, ansi_enabled, contains_tag,
                       decimal_text,
                       contains_wide_decimal, encode_wide_decimals, encoded_schema, has_tag,
                       is_wide_decimal, restore_decimals, tag_comment, tagged_columns,
                       wide_decimal_columns)

__all__ = [
    "RESTORED_TYPE", "TAG", "UnsupportedTypeError", "ansi_enabled", "conform_types",
    "conformed_schema", "decimal_text",
    "contains_tag", "contains_wide_decimal", "encode_wide_decimals", "encoded_schema",
    "has_tag", "is_wide_decimal", "restore_decimals", "tag_comment", "tagged_columns",
    "wide_decimal_columns",
]

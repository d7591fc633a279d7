"""Pieces of DuckDB SQL that several operators' checks share."""

from __future__ import annotations

#: Words of a text column, as a list.
WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def crc32_sql(text: str) -> str:
    """The CRC-32 of an ASCII text expression, bit by bit; 3988292384 is its fixed polynomial."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    byte = ("list_reduce(list_prepend(xor(s, b), [CAST(i AS BIGINT) FOR i IN range(8)]), lambda v, i: "
            "xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))")
    return (f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
            f"lambda s, b: {byte}))")

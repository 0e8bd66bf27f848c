"""Scalar text expressions: quotes, safe casts, number formats, list fields."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_quotes(text: Column) -> Column:
    """PJ5: remove every double quote."""
    return F.replace(text, F.lit('"'), F.lit(""))


def is_true(text: Column) -> Column:
    """PJ4: the text is exactly 'true' (NULL stays NULL)."""
    return text == F.lit("true")


def is_true_any_case(text: Column) -> Column:
    """PJ19: the text is 'true' in any letter case."""
    return F.lower(text) == F.lit("true")


def thousands(n: Column) -> Column:
    """PJ13: 12345 -> '12,345'."""
    return F.format_number(n, 0)


def percent_label(share: Column) -> Column:
    """PJ13: 0.1234 -> '12.3%'."""
    return F.concat(F.format_number(share * 100, 1), F.lit("%"))


def decimal_comma(value: Column) -> Column:
    """PJ14: decimal point to comma."""
    return F.replace(value.cast("string"), F.lit("."), F.lit(","))


def non_blank_items(items: Column) -> Column:
    """Trimmed items of an array, blanks and NULLs dropped."""
    return F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")


def join_items(items: Column) -> Column:
    """PJ15: non-blank items as one ', '-separated text ('' when there are none)."""
    return F.coalesce(F.array_join(non_blank_items(items), ", "), F.lit(""))


def count_items(items: Column) -> Column:
    """PJ15: how many items are not blank (0 for a missing list)."""
    return F.coalesce(F.size(non_blank_items(items)), F.lit(0))


def list_items(text: Column) -> Column:
    """AG16: the non-blank items of a comma-separated field."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def unescape_html(text: Column) -> Column:
    """PJ18: decode &name;, &#123; and &#x7B; references; anything else stays as it is."""
    for name, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("apos", "'")):
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    # what is left is nearly always &amp; alone
    rare = text.rlike(r"&(?!amp;)(?:#|[a-zA-Z])\w+;")
    return F.when(rare, _decode_references(text)).otherwise(F.replace(text, F.lit("&amp;"), F.lit("&")))


def _decode_references(text: Column) -> Column:
    names = F.create_map(*[
        F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))])
    after_amp = F.split(text, "&")

    def character(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def decode(piece: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        decimal = F.regexp_extract(name, r"^#(\d{1,7})$", 1).try_cast("int")
        hexadecimal = F.conv(F.nullif(F.regexp_extract(name, r"^#[xX]([0-9a-fA-F]{1,6})$", 1), F.lit("")), 16, 10)
        code = F.coalesce(decimal, hexadecimal.try_cast("int"))
        found = F.when(F.startswith(name, F.lit("#")), F.when(code.between(1, 0x10FFFF), character(code))
                       ).otherwise(F.try_element_at(names, name))
        rest = F.substring(piece, F.length(name) + 2, F.length(piece))
        return F.coalesce(F.when(F.contains(piece, F.lit(";")), F.concat(found, rest)),
                          F.concat(F.lit("&"), piece))

    decoded = F.transform(F.slice(after_amp, F.lit(2), F.size(after_amp)), decode)
    return F.concat(after_amp[0], F.array_join(decoded, ""))


# ---- complement arrays: [name, detail ..., "label: person - role"] -------------------


def first_item(items: Column) -> Column:
    """PJ6."""
    return F.try_element_at(items, F.lit(1))


def last_item(items: Column) -> Column:
    """PJ6."""
    return F.try_element_at(items, F.lit(-1))


def middle_items(items: Column) -> Column:
    """PJ7: items 2..n-1 joined by ' | '; NULL when n <= 2."""
    inner = F.slice(items, F.lit(2), F.greatest(F.size(items) - 2, F.lit(0)))
    return F.when(F.size(items) > 2, F.array_join(inner, " | "))


def author_fields(text: Column) -> dict[str, Column]:
    """PJ8: 'label: person - role' as three trimmed lower-case fields."""
    parts = F.split(text, ":")
    person = F.split(F.try_element_at(parts, F.lit(2)), " - ")

    def clean(c: Column) -> Column:
        return F.lower(F.trim(c))

    return {
        "descricao": clean(F.try_element_at(parts, F.lit(1))),
        "nome": clean(F.try_element_at(person, F.lit(1))),
        "cargo": clean(F.try_element_at(person, F.lit(2))),
    }

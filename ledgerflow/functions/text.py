"""Text cleaning expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Lowercase Latin letters with marks and their bare ASCII letters."""
    marked, bare = [], []
    for point in range(0x00C0, 0x0250):
        char = chr(point)
        base = unicodedata.normalize("NFD", char)[0]
        if char == char.lower() and base != char and base.isascii() and base.isalpha():
            marked.append(char)
            bare.append(base)
    return "".join(marked), "".join(bare)


_MARKED, _BARE = _accent_table()


def fold(c: Column) -> Column:
    """Case- and accent-insensitive key: equal folds mean equal texts.

    A plain string, so joins and groupings on it stay hashable.  Every letter
    maps to one letter, hence positions are those of the input.
    """
    return F.translate(F.lower(c), _MARKED, _BARE)


def clean_notes(c: Column) -> Column:
    """CR, TAB and NBSP become spaces, then left-trim; line feeds stay."""
    return F.ltrim(F.translate(c, "\r\t\u00a0", "   "))


def ptbr_decimal(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """Parse `1.058,50`, `1058,50` or `1058.50`; anything else is NULL."""
    dotless = F.translate(c, ".", "")
    plain = F.when(c.contains(","), F.translate(F.when(c.contains("."), dotless).otherwise(c), ",", "."))
    return plain.otherwise(c).try_cast(f"decimal({precision},{scale})")


def digits_only(c: Column) -> Column:
    """Drop the eight usual separators of document numbers; letters survive."""
    return F.translate(c.cast("string"), ".- /(),\t", "")


def zero_pad_postal(c: Column) -> Column:
    """Eight characters, zero-filled on the left; longer input keeps its last eight."""
    return F.right(F.concat(F.lit("00000000"), digits_only(c)), F.lit(8))


def name_segment(c: Column, position: int) -> Column:
    """Part of `Name - Store - Role`; part 3 is the whole rest, absent parts are NULL."""
    return F.trim(F.get(F.split(c, " - ", 3), F.lit(position - 1)))


def normalized_name(c: Column) -> Column:
    return F.lower(name_segment(c, 1))


# fixed value: folded prefix that marks a retired salesperson
RETIRED = "nao utilizar"


def is_retired(c: Column) -> Column:
    return fold(c).startswith(RETIRED)


def strip_retired_prefix(c: Column) -> Column:
    """Remove the retired marker together with its ` - ` separator."""
    marker = RETIRED + " - "
    rest = F.ltrim(F.substr(c, F.lit(len(marker) + 1)))
    return F.when(fold(c).startswith(marker), rest).otherwise(c)


def canonical_name(c: Column) -> Column:
    """Lowercased first part of the name without the marker; not trimmed."""
    return F.lower(F.get(F.split(strip_retired_prefix(c), " - ", 2), F.lit(0)))


def active_status(c: Column) -> Column:
    return F.when(is_retired(c), "inactive").otherwise("active")


def blank_to_null(c: Column) -> Column:
    """'' and blank-only text count as empty, as in a blank-padded comparison."""
    return F.when(F.rtrim(c) != "", c)


def tax_id_normalized(secret: Column, partner_code: Column) -> Column:
    bare = F.translate(secret, "./-", "")
    return F.coalesce(blank_to_null(bare), F.concat_ws("", F.lit("SAP"), partner_code))


def text_length(c: Column) -> Column:
    """Length that ignores trailing blanks."""
    return F.length(F.rtrim(c))


def tax_id_bucket(c: Column) -> Column:
    return (
        F.when(c.startswith("SAP"), "no document")
        .when(text_length(c) == 11, "cpf")
        .when(text_length(c) == 14, "cnpj")
        .otherwise("irregular")
    )


def prefixed_id(prefix: str, key: Column) -> Column:
    """`nf-12`; NULL when the key is NULL."""
    return F.concat(F.lit(prefix + "-"), key.cast("string"))


def line_key(doc_entry: Column, line_number: Column) -> Column:
    """`12/3`; a NULL part counts as empty text."""
    return F.concat_ws("", doc_entry.cast("string"), F.lit("/"), line_number.cast("string"))


def lenient_int(c: Column) -> Column:
    """Text to int: blanks give 0, other unparsable text gives NULL."""
    return F.when(F.trim(c) == "", 0).otherwise(c.try_cast("int"))


def goal_store_key(c: Column) -> Column:
    """Join key of a goal sheet's store text against the lowercased store name."""
    name = F.trim(c)
    return F.when(F.lower(name) == "bonsucesso - rj", "bonsucesso").otherwise(F.lower(name))


def item_prefix(item_code: Column) -> Column:
    return F.substring(item_code, 1, 2)


def item_category(item_code: Column) -> Column:
    prefix = item_prefix(item_code)
    return (
        F.when(prefix == "DA", "administrative expense")
        .when(prefix == "SV", "service")
        .otherwise("product")
    )


def item_type(sellable: Column, stockable: Column, purchased: Column) -> Column:
    return (
        F.when((sellable == "yes") & (stockable == "yes"), "product")
        .when((sellable == "yes") & (stockable == "no"), "service")
        .when((sellable == "no") & (purchased == "yes"), "administrative purchase")
        .otherwise("others")
    )

r"""Name normalisation and trigram similarity, all as built-in column expressions.

Patterns use ``\p{L}``/``\p{N}`` for "any letter or digit" so that a Cyrillic or Arabic name
survives :func:`normalize_name`; :func:`normalize_name_ascii` keeps Latin letters and digits only
and therefore turns such a name into the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_PART_COUNT = 4


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _single_spaced(text: Column) -> Column:
    # runs of blanks and single blanks other than a space; a lone space needs no replacement
    return F.trim(F.regexp_replace(text, r"\s\s+|[^\S ]", " "))


def normalize_name(name: str | Column) -> Column:
    """Lower case; hyphens and slashes become blanks, other signs vanish, blanks collapse."""
    spaced = F.translate(F.lower(_col(name)), "-/", "  ")
    return _single_spaced(F.regexp_replace(spaced, r"[^\p{L}\p{N}\s]+", ""))


def normalize_name_ascii(name: str | Column) -> Column:
    """The same for Latin letters and digits only."""
    spaced = F.translate(_col(name), "-/", "  ")
    # one named class (a-z, A-Z, 0-9): Java takes six times as long for the three ranges
    return _single_spaced(F.lower(F.regexp_replace(spaced, r"[^\p{Alnum}\s]+", "")))


def trigrams(text: str | Column) -> Column:
    """Distinct trigrams of every word, each word padded with two blanks before and one after.

    One lookahead match finds the overlapping trigrams. Words are kept apart by a line break,
    which ``.`` does not match, so no trigram spans two words; three blanks are no trigram.
    """
    words = F.regexp_replace(F.lower(_col(text)), r"[^\p{L}\p{N}]+", " \n  ")
    padded = F.concat(F.lit("  "), words, F.lit(" "))
    return F.array_distinct(F.regexp_extract_all(padded, F.lit("(?=(?!   )(.{3}))"), F.lit(1)))


def packed_trigrams(text: str | Column) -> Column:
    """:func:`trigrams` as 63-bit numbers (three 21-bit code points): exact, and cheap to compare."""

    def pack(gram: Column) -> Column:
        first, second, third = (
            F.ascii(F.substring(gram, position, 1)).cast("bigint") for position in (1, 2, 3)
        )
        return F.shiftleft(first, 42) + F.shiftleft(second, 21) + third

    return F.transform(trigrams(text), pack)


def overlap_score(left_grams: Column, right_grams: Column) -> Column:
    """Shared trigrams over all trigrams; 0 when neither side has any."""
    common = F.size(F.array_intersect(left_grams, right_grams))
    total = F.size(left_grams) + F.size(right_grams) - common
    return F.when(total == 0, F.lit(0.0)).otherwise(common / total)


def trigram_similarity(left: str | Column, right: str | Column) -> Column:
    return F.when(
        _col(left).isNotNull() & _col(right).isNotNull(),
        overlap_score(trigrams(left), trigrams(right)),
    )


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def person_name(*parts: str | Column) -> Column:
    """Stripped parts joined by a blank; NULL and empty parts are left out."""
    return F.concat_ws(" ", *[_strip(F.nullif(_col(part), F.lit(""))) for part in parts])


def safe_text(text: str | Column) -> Column:
    """Stripped text; NULL for an empty one. The check comes before the strip, as specified."""
    return F.when(_col(text) != "", _strip(_col(text)))


def date_prefix(text: str | Column) -> Column:
    """The leading ``YYYY-MM-DD`` of a date with a zone suffix."""
    return F.when(_col(text) != "", F.substring(_col(text), 1, 10))


def entity_hash(name: str | Column, reference: str | Column, gender: str | Column) -> Column:
    """SHA-256 over the three texts; a missing one counts as the word ``None``."""
    parts = [F.coalesce(_col(part), F.lit("None")) for part in (name, reference, gender)]
    return F.sha2(F.concat(*parts), 256)

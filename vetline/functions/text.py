"""HTML to text without regard to its structure; text nodes are in `html`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def display_text(branded: str | Column, plain: str | Column) -> Column:
    """The branded text where there is one (even an empty one), else the plain text."""
    return F.nullif(F.trim(F.coalesce(_col(branded), _col(plain), F.lit(""))), F.lit(""))


def clean_html_spaced(html: str | Column) -> Column:
    """Tags and ``&nbsp;`` become blanks, white space is collapsed, nothing left becomes NULL."""
    no_tags = F.regexp_replace(_col(html), "<[^>]+>", " ")
    no_nbsp = F.replace(no_tags, F.lit("&nbsp;"), F.lit(" "))
    return F.nullif(F.trim(F.regexp_replace(no_nbsp, r"\s+", " ")), F.lit(""))


def strip_tags(html: str | Column) -> Column:
    """Tags are deleted without a replacement; NULL becomes the empty text."""
    return F.regexp_replace(F.coalesce(_col(html), F.lit("")), "<[^>]*>", "")

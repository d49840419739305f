"""Keys that tell rows apart where ids may be null or repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(doc_id: str, body: str) -> Column:
    """A 128-bit hash of an id and a binary text: equal for rows that are equal in both, else different."""
    named = F.concat_ws("", F.col(doc_id).cast("string"), F.lit("/")).cast("binary")
    return F.unhex(F.md5(F.concat(named, F.col(body))))

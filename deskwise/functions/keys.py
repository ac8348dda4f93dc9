"""Surrogate keys: pure functions of the natural key, so either side of a join can build them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token that stands for null, and the separator between parts.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*parts: Column | str) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(
        F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in cols])
    )


def version_id(key: Column, moment: Column) -> Column:
    """Identifier of one version of one key, from the key and the moment the version began."""
    stamp = F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in (key, stamp)]
    return F.md5(F.concat_ws("|", *text))

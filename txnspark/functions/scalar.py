"""General scalar helpers (FN-01, FN-16 .. FN-19, FN-31)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a NULL field contributes to a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_scalar(json: Column | str, path: str) -> Column:
    """FN-01: text of a scalar in a JSON string; NULL for an object or array."""
    json = _col(json)
    return scalar_only(F.get_json_object(json, path), json, path)


def scalar_only(text: Column, json: Column, path: str) -> Column:
    """``text`` found at ``path``, NULL if an object or array is there. Only text with a leading bracket asks for its type."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant"))
    return F.when(~text.rlike(r"^\s*[\[{]"), text).when(kind == "STRING", text)


def surrogate_key(*fields: Column | str, empty_for_null: bool = False) -> Column:
    """FN-16: md5 over the fields as text, joined by ``-``."""
    token = F.lit("" if empty_for_null else SURROGATE_NULL)
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(f).cast("string"), token) for f in fields]))


def safe_add(*fields: Column | str) -> Column:
    """FN-17: sum in which a NULL field counts as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_col(f), F.lit(0)) for f in fields])


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """FN-18: quotient, NULL when the denominator is 0."""
    return F.try_divide(_col(numerator), _col(denominator))


def width_bucket(value: Column | str, low: Column | str, high: Column | str, buckets: Column | int) -> Column:
    """FN-19: 1-based equal-width bucket, 0 below ``low`` and ``buckets + 1`` from ``high`` on."""
    n = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.width_bucket(_col(value).cast("double"), _col(low).cast("double"), _col(high).cast("double"), n)


def slugify(text: str) -> str:
    """FN-31: column-name slug. Works on names while the plan is built, never on rows."""
    slug = re.sub(r"[^a-z0-9_]", "", re.sub(r"[ -]+", "_", text.lower()))
    return f"_{slug}" if slug[:1].isdigit() else slug

"""URL helpers (FN-13 .. FN-15). The inputs often lack a scheme, so ``parse_url`` does not apply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _without(text: Column, *schemes: str) -> Column:
    for scheme in schemes:
        text = F.replace(text, F.lit(scheme), F.lit(""))
    return text


def url_host(url: Column | str) -> Column:
    """FN-13: what stands before the first ``/`` or ``?`` once the scheme is gone."""
    bare = _without(F.col(url) if isinstance(url, str) else url, "android-app://", "http://", "https://")
    return F.substring_index(F.substring_index(bare, "/", 1), "?", 1)


def url_path(url: Column | str) -> Column:
    """FN-14: path without leading slash and query; the host itself when there is neither ``/`` nor ``?``."""
    bare = _without(F.col(url) if isinstance(url, str) else url, "http://", "https://")
    return (
        F.when(bare.contains("/"), F.regexp_extract(bare, r"^[^/]*/([^?]*)", 1))
        .when(bare.contains("?"), F.lit(""))
        .otherwise(bare)
    )


def url_parameter(url: Column | str, name: str) -> Column:
    """FN-15: value of a query parameter, NULL when absent or empty. Matches by suffix, so ``xp=`` serves ``p``."""
    url = F.col(url) if isinstance(url, str) else url
    tail = F.split_part(url, F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.substring_index(tail, "&", 1), F.lit(""))

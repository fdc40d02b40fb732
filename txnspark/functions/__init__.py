"""Scalar helpers: plain functions from Column to Column, no Python UDFs."""

from txnspark.functions.dates import add_interval, intervals_between, iso_utc, local_wall_clock, months_between_whole
from txnspark.functions.geo import haversine_distance, point_distance_m
from txnspark.functions.scalar import (
    json_scalar,
    safe_add,
    safe_divide,
    slugify,
    surrogate_key,
    width_bucket,
)
from txnspark.functions.urls import url_host, url_parameter, url_path

__all__ = [
    "add_interval",
    "haversine_distance",
    "intervals_between",
    "iso_utc",
    "json_scalar",
    "local_wall_clock",
    "months_between_whole",
    "point_distance_m",
    "safe_add",
    "safe_divide",
    "slugify",
    "surrogate_key",
    "url_host",
    "url_parameter",
    "url_path",
    "width_bucket",
]

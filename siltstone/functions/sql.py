"""The column functions as temporary SQL functions, for use in ``spark.sql`` text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from siltstone.functions.maths import EARTH_RADIUS_MILES, KM_PER_MILE

_SQUARES = "aggregate({v}, 0D, (s, x) -> s + cast(x as double) * cast(x as double))"

FUNCTIONS = {
    "cosine_similarity(a array<float>, b array<float>) returns double": f"""
        try_divide(aggregate(zip_with(a, b, (p, q) -> cast(p as double) * cast(q as double)), 0D, (s, x) -> s + x),
                   sqrt({_SQUARES.format(v='a')}) * sqrt({_SQUARES.format(v='b')}))""",
    "content_hash(x string) returns string": r"upper(sha2(lower(btrim(x, ' \t\n\u000b\u000c\r')), 256))",
    "word_count(x string) returns int": "length(x) - length(replace(x, ' ', '')) + 1",
    "safe_divide(a double, b double) returns double": "try_divide(a, b)",
    "haversine_distance(lat1 double, lon1 double, lat2 double, lon2 double) returns double": f"""
        {2 * EARTH_RADIUS_MILES} * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2)
          + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))""",
    "haversine_distance_km(lat1 double, lon1 double, lat2 double, lon2 double) returns double":
        f"haversine_distance(lat1, lon1, lat2, lon2) * {KM_PER_MILE}D",
    "get_url_host(x string) returns string": """
        split_part(split_part(replace(replace(replace(x, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1)""",
    "get_url_parameter(x string, p string) returns string":
        "nullif(split_part(split_part(x, concat(p, '='), 2), '&', 1), '')",
    "iso_week_start(d date) returns date": "date_sub(d, weekday(d))",
    "week_start_sunday(d date) returns date": "date_sub(d, dayofweek(d) - 1)",
}


def register_sql_functions(spark: SparkSession) -> None:
    """Create or replace the functions for this session."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {signature} return {body}")

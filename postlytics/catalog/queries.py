"""Registered queries: name -> callable(spark, root) -> DataFrame.

Each reads the driver's tables under ``root`` (all rows), derives the raw
entities (``sources.bindings``), cleans them with the shared operators and
answers one question or exercises one operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import plans
from ..operators.clean import clean_locations, clean_posts, clean_users
from ..sources.bindings import raw_locations, raw_posts, raw_users

Query = Callable[[SparkSession, str], DataFrame]

# Year windows of the driver's data (orders fall in 1995-2001): the post-year
# ranking uses 1996-2000; the join-year questions keep the reference's 2015-2020.
POST_YEARS = (1996, 2000)
JOIN_YEARS = (2015, 2020)


def entities(spark: SparkSession, root: str, key: str):
    """Cleaned (posts, locations, users) of one binding family, as lazy plans."""
    return (clean_posts(raw_posts(spark, root, key)), clean_locations(raw_locations(spark, root, key)),
            clean_users(raw_users(spark, root)))


def _q1(spark, root):
    pins, geo, _ = entities(spark, root, "order")
    return plans.top_category_by_country(pins, geo)


def _q2(spark, root):
    pins, geo, _ = entities(spark, root, "order")
    return plans.top_category_by_year(pins, geo, *POST_YEARS)


def _repeated(spark, root):
    pins, geo, _ = entities(spark, root, "customer")
    return plans.category_counts(pins, geo)


def _q3(spark, root):
    pins, geo, _ = entities(spark, root, "customer")
    return plans.top_user_by_country(pins, geo)


def _q4(spark, root):
    pins, geo, _ = entities(spark, root, "customer")
    return plans.top_country_by_followers(pins, geo)


def _q5(spark, root):
    pins, _, users = entities(spark, root, "customer")
    return plans.top_category_by_age_group(pins, users)


def _q6(spark, root):
    return plans.median_followers_by_age_group(*entities(spark, root, "customer"), method="exact")


def _q7(spark, root):
    _, _, users = entities(spark, root, "customer")
    return plans.users_joined_by_year(users, *JOIN_YEARS)


def _q8(spark, root):
    return plans.median_followers_by_year_joined(*entities(spark, root, "customer"), *JOIN_YEARS,
                                                 method="exact")


def _q9(spark, root):
    return plans.median_followers_by_year_and_age(*entities(spark, root, "customer"), *JOIN_YEARS,
                                                  method="exact")


def _sketch(by, years=None):
    """The sketch option's medians, checked by rank error: its answers depend on the group's size."""
    def run(spark, root):
        from .operator_queries import sketch_within_error
        base = plans.users_with_latest_post(*entities(spark, root, "customer"))
        if years:
            base = base.filter(base["year_joined"].between(*years))
        return sketch_within_error(base, by, "follower_count")
    return run


def _clean(kind):
    def run(spark, root):
        pins, geo, users = entities(spark, root, "order")
        return {"pin": pins, "geo": geo, "user": users}[kind]
    return run


QUERIES: dict[str, Query] = {
    "top_category_by_country": _q1,
    "top_category_by_year": _q2,
    "category_counts_repeated_keys": _repeated,
    "top_user_by_country": _q3,
    "top_country_by_followers": _q4,
    "top_category_by_age_group": _q5,
    "median_followers_by_age_group": _q6,
    "users_joined_by_year": _q7,
    "median_followers_by_year_joined": _q8,
    "median_followers_by_year_and_age": _q9,
    "median_followers_by_age_group_sketch": _sketch(["age_group"]),
    "median_followers_by_year_joined_sketch": _sketch(["year_joined"], JOIN_YEARS),
    "median_followers_by_year_and_age_sketch": _sketch(["year_joined", "age_group"], JOIN_YEARS),
    "clean_posts": _clean("pin"),
    "clean_locations": _clean("geo"),
    "clean_users": _clean("user"),
}


def _register_more():
    from .operator_queries import OPERATOR_QUERIES
    from .stream_queries import STREAM_QUERIES
    QUERIES.update(OPERATOR_QUERIES)
    QUERIES.update(STREAM_QUERIES)


_register_more()

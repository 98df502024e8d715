"""The analytic questions (Q1-Q9) over cleaned posts, locations and users.

Inputs are cleaned DataFrames (see ``operators.clean``); every function returns
a lazy DataFrame and never collects. Ties are always broken (D5, D6) so results
are deterministic:

* rankings by count: higher count first, then the smaller label;
* latest post per user: newest location time, then the smaller country, and
  among that user's posts the highest follower count, then the smaller name;
* top user per country: highest follower count, then the smaller name.

Joins keep the reference's repeated-key semantics (D4): a key posted m times
on one side and n times on the other counts m x n times. They are computed
from per-key counts (``pair_counts``) or per-key best rows
(``top_joined_per_key``), never from the m x n rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import DEFAULT_AGE_BANDS, age_band
from ..operators.aggregate import median_by_group
from ..operators.joins import pair_counts
from ..operators.rank import top_joined_per_key, top_n_per_group


def _by_count():
    return [F.col("category_count").desc(), F.col("category").asc_nulls_last()]


def top_category(counts: DataFrame, by: str) -> DataFrame:
    """The category with the highest count in each group of ``by`` (W1, W2), from (by, category, category_count) rows."""
    return top_n_per_group(counts, by, _by_count()).select(by, "category", "category_count").orderBy(by)


def top_category_by_country(pins: DataFrame, locations: DataFrame, hot_keys: Sequence | None = None) -> DataFrame:
    """Q1: most popular category in each country. ``hot_keys`` as in :func:`pair_counts`."""
    return top_category(pair_counts(locations, pins, "ind", ["country"], ["category"], "category_count", hot_keys), "country")


def category_counts(pins: DataFrame, locations: DataFrame) -> DataFrame:
    """Posts per (country, category) after the location join (J1 + A1)."""
    return pair_counts(locations, pins, "ind", ["country"], ["category"], out="category_count")


def top_category_by_year(pins: DataFrame, locations: DataFrame,
                         first_year: int = 2018, last_year: int = 2022, hot_keys: Sequence | None = None) -> DataFrame:
    """Q2: most popular category per post year, both bounds included."""
    years = (locations.select("ind", F.year("timestamp").alias("post_year"))
             .filter(F.col("post_year").between(first_year, last_year)))
    return top_category(pair_counts(years, pins, "ind", ["post_year"], ["category"], "category_count", hot_keys), "post_year")


def latest_post_per_user(pins: DataFrame, locations: DataFrame) -> DataFrame:
    """W3 on the location join: one row per ``ind`` with the newest post's
    country and time and the user's poster name and follower count."""
    return top_joined_per_key(
        locations.select("ind", "country", "timestamp"),
        pins.select("ind", "poster_name", "follower_count"),
        "ind",
        [F.col("timestamp").desc_nulls_last(), F.col("country").asc_nulls_last()],
        [F.col("follower_count").desc_nulls_last(), F.col("poster_name").asc_nulls_last()])


def _top_user_by_country(pins: DataFrame, locations: DataFrame) -> DataFrame:
    latest = latest_post_per_user(pins, locations)
    order = [F.col("follower_count").desc_nulls_last(), F.col("poster_name").asc_nulls_last()]
    return top_n_per_group(latest, "country", order).select("country", "poster_name", "follower_count")


def top_user_by_country(pins: DataFrame, locations: DataFrame) -> DataFrame:
    """Q3: user with the most followers in each country, on each user's latest post."""
    return _top_user_by_country(pins, locations).orderBy("country")


def top_country_by_followers(pins: DataFrame, locations: DataFrame) -> DataFrame:
    """Q4: countries whose top user has the overall highest follower count (ties kept).

    The maximum (J4) is taken over the one row per country that Q3 leaves, so the
    joins below it run once.
    """
    top = _top_user_by_country(pins, locations)
    highest = F.max("follower_count").over(Window.partitionBy())
    return (top.withColumn("highest", highest).filter(F.col("follower_count") == F.col("highest"))
            .select("country", "follower_count"))


def top_category_by_age_group(pins: DataFrame, users: DataFrame,
                              bands=DEFAULT_AGE_BANDS, hot_keys: Sequence | None = None) -> DataFrame:
    """Q5: most popular category per age group, every post counted."""
    groups = users.select("ind", age_band("age", bands).alias("age_group"))
    return top_category(pair_counts(groups, pins, "ind", ["age_group"], ["category"], "category_count", hot_keys), "age_group")


def users_with_latest_post(pins: DataFrame, locations: DataFrame, users: DataFrame,
                           bands=DEFAULT_AGE_BANDS) -> DataFrame:
    """Every user row with age group, join year and the latest post's follower count
    (NULL for users without posts). Users are not de-duplicated (D7).

    Users without a key match nothing; a second join column spreads them over the
    tasks instead of sending them all to one."""
    latest = latest_post_per_user(pins, locations).select(
        F.col("ind").alias("__ind"), F.lit(0).alias("__spread"), "follower_count")
    people = users.select("ind", age_band("age", bands).alias("age_group"), F.year("date_joined").alias("year_joined"),
                          F.when(F.col("ind").isNull(), F.spark_partition_id()).otherwise(F.lit(0)).alias("__own"))
    met = (F.col("ind") == F.col("__ind")) & (F.col("__own") == F.col("__spread"))
    return people.join(latest, met, "left").select("ind", "age_group", "year_joined", "follower_count")


def median_followers_by_age_group(pins: DataFrame, locations: DataFrame, users: DataFrame,
                                  method: str = "exact", bands=DEFAULT_AGE_BANDS) -> DataFrame:
    """Q6: median follower count per age group (latest post per user)."""
    return medians_from_base(users_with_latest_post(pins, locations, users, bands),
                             ["age_group"], method)


def medians_from_base(base: DataFrame, by: list[str], method: str = "exact",
                      years: tuple[int, int] | None = None) -> DataFrame:
    """Q6, Q8, Q9 from a J3 result (:func:`users_with_latest_post`), optionally
    restricted to join years (both bounds included)."""
    if years is not None:
        base = base.filter(F.col("year_joined").between(*years))
    return (median_by_group(base, by, "follower_count", method, out="median_follower_count")
            .orderBy(*by))


def users_joined_by_year(users: DataFrame, first_year: int = 2015, last_year: int = 2020) -> DataFrame:
    """Q7: distinct users per join year, both bounds included.

    The reference counts over users left-joined to one latest post per user;
    that join keeps exactly the users' keys, so it is skipped here.
    """
    years = (users.select("ind", F.year("date_joined").alias("year_joined"))
             .filter(F.col("year_joined").between(first_year, last_year)))
    return (years.groupBy("year_joined").agg(F.count_distinct("ind").alias("number_users_joined"))
            .orderBy("year_joined"))


def median_followers_by_year_joined(pins: DataFrame, locations: DataFrame, users: DataFrame,
                                    first_year: int = 2015, last_year: int = 2020,
                                    method: str = "exact") -> DataFrame:
    """Q8: median follower count per join year."""
    base = users_with_latest_post(pins, locations, users)
    return medians_from_base(base, ["year_joined"], method, (first_year, last_year))


def median_followers_by_year_and_age(pins: DataFrame, locations: DataFrame, users: DataFrame,
                                     first_year: int = 2015, last_year: int = 2020,
                                     method: str = "exact", bands=DEFAULT_AGE_BANDS) -> DataFrame:
    """Q9: median follower count per join year and age group."""
    base = users_with_latest_post(pins, locations, users, bands)
    return medians_from_base(base, ["year_joined", "age_group"], method, (first_year, last_year))

"""The daily run as delta maintenance: every run reads new files only and answers Q1-Q9.

1. *Bookmark.* Each landed topic is read as a stream with an ``availableNow`` trigger and a
   checkpoint, parsed once into an entity table (``streaming.tables``). A run without new files
   reads none.
2. *State.* A run adds one batch to the state, derived from the new rows alone:

   ================  =====================================  ==========================
   table             rows                                   questions
   ================  =====================================  ==========================
   ``pin_counts``    posts per (ind, category)
   ``geo_counts``    locations per (ind, country, year)
   ``user_counts``   users per (ind, age group)
   ``geo_pin``       pairs per (country, year, category)    Q1, Q2
   ``user_pin``      pairs per (age group, category)        Q5
   ``pin_best``      best post per ind                      Q3, Q4, Q6, Q8, Q9
   ``geo_best``      newest location per ind                Q3, Q4, Q6, Q8, Q9
   ``users``         ind, age, date_joined                  Q6-Q9
   ================  =====================================  ==========================

   Pair counts are linear in either side, so the new pairs are new L x (old + new R) plus
   old L x new R, joined on counts per key and never on rows. Best rows merge by taking the best again.
   A table of the state is the union of its batches; nothing old is rewritten by a run.
   ``compact_state`` merges the batches so far into one now and then: counts are summed, best rows taken again.
3. *Commit.* The batch counts once its commit exists (``sources.commits``); it names the entity
   batches it has taken in, so a run that was killed is repeated and counts nothing twice.
4. *Answers* come from the state, under ``answers/data/batch=<run>/...``, committed alike.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import age_band
from ..operators.rank import top_n_per_group
from ..schemas import SCHEMAS
from ..sources.commits import attempt_path, commit, committed, committed_paths, compaction_path, is_committed
from ..sources.messages import stream_landed
from ..sources.topics import topic_path
from ..streaming.landing import read_landed_stream
from ..streaming.sinks import read_messages_stream
from ..streaming.state import BEST_POST, LATEST_LOCATION
from ..streaming.tables import read_entity_table, run_entity_tables
from . import questions as q

# Columns of the state's tables.
STATE = {
    "pin_counts": "ind bigint, category string, n bigint",
    "geo_counts": "ind bigint, country string, post_year int, n bigint",
    "user_counts": "ind bigint, age_group string, n bigint",
    "geo_pin": "country string, post_year int, category string, n bigint",
    "user_pin": "age_group string, category string, n bigint",
    "pin_best": "ind bigint, poster_name string, follower_count bigint",
    "geo_best": "ind bigint, country string, timestamp timestamp",
    "users": "ind bigint, age int, date_joined timestamp",
    "taken": "entity string, upto bigint",
}

# Orders of the best rows.
BEST = {"pin_best": BEST_POST, "geo_best": LATEST_LOCATION}
ANSWERS = ("top_category_by_country", "top_category_by_year", "top_user_by_country", "top_country_by_followers",
           "top_category_by_age_group", "median_followers_by_age_group", "users_joined_by_year",
           "median_followers_by_year_joined", "median_followers_by_year_and_age")


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of the state: the union of its committed batches, merged ones first."""
    paths = [f"{path}/{name}" for path in committed_paths(spark, root)]
    return spark.read.schema(STATE[name]).parquet(*paths) if paths else spark.createDataFrame([], STATE[name])


def _pairs(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Pairs per group of two tables of counts per key."""
    joined = left.select("*", F.col("n").alias("__nl")).drop("n").join(right.select("*", F.col("n").alias("__nr")).drop("n"), "ind")
    return joined.groupBy(*by).agg(F.sum(F.col("__nl") * F.col("__nr")).alias("n"))


def _best(rows: DataFrame, name: str) -> DataFrame:
    order = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in BEST[name]]
    return top_n_per_group(rows, "ind", order)


def _counts(rows: DataFrame, *by) -> DataFrame:
    return rows.where(F.col("ind").isNotNull()).groupBy("ind", *by).agg(F.count(F.lit(1)).alias("n"))


def update_state(spark: SparkSession, tables_root: str, root: str) -> bool:
    """Take the entity batches that are new since the last committed run into the state; False if
    there are none."""
    runs = committed(spark, root)
    taken = {r.entity: r.upto for r in read_state(spark, root, "taken").groupBy("entity").agg(F.max("upto").alias("upto")).collect()}
    newest = {e: max(committed(spark, f"{tables_root.rstrip('/')}/{e}"), default=-1) for e in SCHEMAS}
    if all(newest[e] <= taken.get(e, -1) for e in SCHEMAS):
        return False
    run, attempt = max(runs, default=-1) + 1, uuid.uuid4().hex
    path = attempt_path(root, run, attempt)

    def write(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(STATE[name]).parquet(f"{path}/{name}")

    # batches that come while this runs are left to the next run
    pins, geo, users = (read_entity_table(spark, tables_root, e, since=taken.get(e, -1), upto=newest[e]) for e in ("pin", "geo", "user"))
    new_pins = write("pin_counts", _counts(pins, "category"))
    new_geo = write("geo_counts", _counts(geo, "country", F.year("timestamp").alias("post_year")))
    new_users = write("user_counts", _counts(users, age_band("age").alias("age_group")))
    old_pins, old_geo, old_users = (read_state(spark, root, n) for n in ("pin_counts", "geo_counts", "user_counts"))
    all_pins = old_pins.unionByName(new_pins)
    for name, new, old, by in (("geo_pin", new_geo, old_geo, ["country", "post_year", "category"]),
                               ("user_pin", new_users, old_users, ["age_group", "category"])):
        added = _pairs(new, all_pins, by).unionByName(_pairs(old, new_pins, by))
        write(name, added.groupBy(*by).agg(F.sum("n").alias("n")))
    keyed = F.col("ind").isNotNull()
    write("pin_best", _best(pins.where(keyed).select("ind", "poster_name", "follower_count"), "pin_best"))
    write("geo_best", _best(geo.where(keyed).select("ind", "country", "timestamp"), "geo_best"))
    write("users", users.select("ind", "age", "date_joined"))
    write("taken", spark.createDataFrame(list(newest.items()), STATE["taken"]))
    commit(spark, root, run, attempt)
    return True


def compact_state(spark: SparkSession, root: str) -> bool:
    """Merge all batches of the state into one that stands for them; False if there is only one.

    Readers take it from its commit on; the batches stay where they are, so a job that reads them
    meanwhile isn't disturbed.
    """
    if len(committed_paths(spark, root)) < 2:
        return False
    upto, attempt = max(committed(spark, root)), uuid.uuid4().hex
    path = compaction_path(root, upto, attempt)
    for name, columns in STATE.items():
        rows, names = read_state(spark, root, name), [c.split()[0] for c in columns.split(", ")]
        if names[-1] == "n":
            rows = rows.groupBy(*names[:-1]).agg(F.sum("n").alias("n"))
        elif name in BEST:
            rows = _best(rows, name)
        elif name == "taken":
            rows = rows.groupBy("entity").agg(F.max("upto").alias("upto"))
        rows.select(*names).write.parquet(f"{path}/{name}")
    commit(spark, root, upto, attempt, "compactions")
    return True


def answers_from_state(spark: SparkSession, root: str, post_years: tuple[int, int] = (2018, 2022),
                       join_years: tuple[int, int] = (2015, 2020), method: str = "exact") -> dict[str, DataFrame]:
    """Q1-Q9 over everything taken in so far."""
    geo_pin, user_pin = read_state(spark, root, "geo_pin"), read_state(spark, root, "user_pin")
    pins, geo, users = (read_state(spark, root, n) for n in ("pin_best", "geo_best", "users"))

    def counts(df: DataFrame, by: str) -> DataFrame:
        return df.groupBy(by, "category").agg(F.sum("n").alias("category_count"))

    base = q.users_with_latest_post(pins, geo, users)
    return {
        "top_category_by_country": q.top_category(counts(geo_pin, "country"), "country"),
        "top_category_by_year": q.top_category(counts(geo_pin.where(F.col("post_year").between(*post_years)), "post_year"), "post_year"),
        "top_user_by_country": q.top_user_by_country(pins, geo),
        "top_country_by_followers": q.top_country_by_followers(pins, geo),
        "top_category_by_age_group": q.top_category(counts(user_pin, "age_group"), "age_group"),
        "median_followers_by_age_group": q.medians_from_base(base, ["age_group"], method),
        "users_joined_by_year": q.users_joined_by_year(users, *join_years),
        "median_followers_by_year_joined": q.medians_from_base(base, ["year_joined"], method, join_years),
        "median_followers_by_year_and_age": q.medians_from_base(base, ["year_joined", "age_group"], method, join_years),
    }


def run_incremental(spark: SparkSession, topics_root: str, out_root: str, topics: Mapping[str, str] | None = None,
                    layout: str = "connector", post_years: tuple[int, int] = (2018, 2022),
                    join_years: tuple[int, int] = (2015, 2020), method: str = "exact") -> dict[str, str]:
    """One daily run over what has landed since the last one. Returns answer name -> table path, the
    last run's where nothing is new. Parameters as in :func:`postlytics.plans.run_batch`; one
    ``out_root`` keeps one set of topics and year bounds.
    """
    from .report import write_answers
    root = out_root.rstrip("/")
    names = {**{e: e for e in SCHEMAS}, **(topics or {})}
    if layout == "hive" and stream_landed(spark, topics_root):
        sources = {e: read_landed_stream(spark, topics_root, "^" + re.escape(t) + "$") for e, t in names.items()}
    else:
        sources = {e: read_messages_stream(spark, "text", topic_path(topics_root, t, layout)) for e, t in names.items()}
    for query in run_entity_tables(spark, sources, f"{root}/tables", trigger={"availableNow": True}).values():
        query.awaitTermination()
    update_state(spark, f"{root}/tables", f"{root}/state")
    run, answers_root = max(committed(spark, f"{root}/state"), default=-1), f"{root}/answers"
    if not is_committed(spark, answers_root, run):
        attempt = uuid.uuid4().hex
        write_answers(answers_from_state(spark, f"{root}/state", post_years, join_years, method),
                      attempt_path(answers_root, run, attempt))
        commit(spark, answers_root, run, attempt)
    folder = attempt_path(answers_root, run, committed(spark, answers_root)[run])
    return {name: f"{folder}/{name}" for name in ANSWERS}

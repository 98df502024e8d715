"""The whole batch analysis as one callable job (the reference's daily run).

All questions are answered from one set of cleaned entities. The input shared
by Q6-Q9 (users joined to their latest post, J3) is written once as a parquet table
in the cluster's shared folder (M1, M2), so the four answers do not recompute the
joins, read only the columns they need, and a lost executor costs a re-read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import fresh_dir
from . import questions as q


def answer_questions(pins: DataFrame, locations: DataFrame, users: DataFrame,
                     post_years: tuple[int, int] = (2018, 2022),
                     join_years: tuple[int, int] = (2015, 2020),
                     method: str = "exact", reuse: bool = True, hot_keys: Sequence | None = None) -> dict[str, DataFrame]:
    """Q1-Q9 keyed by name; ``method`` picks the median (``approx`` = reference sketch), ``hot_keys`` (frequent
    users, where known) the plan of the pair counts.

    With ``reuse`` the input of Q6, Q8 and Q9 is written to the shared folder when this is
    called; all else is lazy.
    """
    base = q.users_with_latest_post(pins, locations, users)
    if reuse:
        path = fresh_dir(base.sparkSession, "latest-posts")
        base.write.parquet(path)
        base = base.sparkSession.read.schema(base.schema).parquet(path)
    return {
        "top_category_by_country": q.top_category_by_country(pins, locations, hot_keys),
        "top_category_by_year": q.top_category_by_year(pins, locations, *post_years, hot_keys=hot_keys),
        "top_user_by_country": q.top_user_by_country(pins, locations),
        "top_country_by_followers": q.top_country_by_followers(pins, locations),
        "top_category_by_age_group": q.top_category_by_age_group(pins, users, hot_keys=hot_keys),
        "median_followers_by_age_group": q.medians_from_base(base, ["age_group"], method),
        "users_joined_by_year": q.users_joined_by_year(users, *join_years),
        "median_followers_by_year_joined": q.medians_from_base(base, ["year_joined"], method, join_years),
        "median_followers_by_year_and_age": q.medians_from_base(
            base, ["year_joined", "age_group"], method, join_years),
    }


def write_answers(answers: dict[str, DataFrame], root: str, fmt: str = "parquet",
                  mode: str = "overwrite", parallel: int = 4) -> dict[str, str]:
    """Write every answer as a table folder ``<root>/<name>``; returns name -> path.

    Up to ``parallel`` writes are submitted at once from driver threads, so
    the many small stages of one answer overlap with those of the others.
    """
    from concurrent.futures import ThreadPoolExecutor

    paths = {name: f"{root.rstrip('/')}/{name}" for name in answers}

    def write(name: str) -> None:
        answers[name].write.mode(mode).format(fmt).save(paths[name])

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for future in [pool.submit(write, name) for name in answers]:
            future.result()
    return paths


def run_batch(spark, topics_root: str, out_root: str, topics: dict[str, str] | None = None,
              layout: str = "connector", post_years: tuple[int, int] = (2018, 2022),
              join_years: tuple[int, int] = (2015, 2020), method: str = "exact") -> dict[str, str]:
    """The daily batch run: read the three landed topics with their schemas
    (S1), clean them (C13-C15), answer Q1-Q9 and write one table per answer.

    Each topic is parsed once: cleaned records and faults leave in one write under ``<out_root>/_clean/<run>/``
    (a new run id each time, so a failed rerun leaves earlier tables whole). The
    questions read the cleaned part; faults go to ``_rejects/<run>/`` with their reason.
    A lost executor re-reads a table instead of re-parsing the topics. Load counts and a sketch of
    the keys ride along with that write, and users it finds frequent steer the pair counts.

    See :func:`postlytics.plans.run_incremental` for a run that reads new files only.

    ``topics`` maps entity (``pin``, ``geo``, ``user``) to topic name; by
    default the topic is the entity name. Returns answer name -> table path.
    """
    from ..operators.joins import hot_keys_of, key_sketch
    from ..schemas import CLEAN_SCHEMAS
    from ..sources.topics import topic_lines
    from ..streaming.tables import CLEAN, REJECT_FIELDS, REJECTS, parsed_once
    names = {"pin": "pin", "geo": "geo", "user": "user", **(topics or {})}
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    cleaned, observed = {}, {}
    run, paths, root = uuid.uuid4().hex[:12], {}, out_root.rstrip("/")
    for entity in names:
        rows = parsed_once(topic_lines(spark, topics_root, names[entity], layout), entity)
        observed[entity] = Observation(f"load_{entity}")
        clean = F.col("kind") == CLEAN
        rows.observe(observed[entity], F.count_if(clean).alias("rows"),
                     F.count_if(clean & F.col("ind").isNull()).alias("rows_without_key"), key_sketch("ind").alias("keys")) \
            .write.parquet(f"{root}/_clean/{run}/{entity}")
        written = spark.read.schema(rows.schema).parquet(f"{root}/_clean/{run}/{entity}")
        cleaned[entity] = written.where(clean).select(*CLEAN_SCHEMAS[entity].names)
        paths[f"_rejects_{entity}"] = f"{root}/_rejects/{run}/{entity}"
        written.where(F.col("kind") == REJECTS).select(*[f.name for f in REJECT_FIELDS]).write.parquet(paths[f"_rejects_{entity}"])
    profile_path = f"{root}/_load_profile"
    loads = [(e, int(o.get["rows"]), int(o.get["rows_without_key"]), o.get["keys"]) for e, o in observed.items()]
    sketch = spark.createDataFrame([], "ind bigint").agg(key_sketch("ind").alias("keys")).schema["keys"].dataType
    profile = spark.createDataFrame(loads, f"entity string, rows bigint, rows_without_key bigint, keys {sketch.simpleString()}")
    profile.write.mode("overwrite").parquet(profile_path)
    # a user who is frequent among posts and locations together
    hot = hot_keys_of(profile, "keys", max(n for _, n, _, _ in loads))
    answers = answer_questions(cleaned["pin"], cleaned["geo"], cleaned["user"],
                               post_years, join_years, method, hot_keys=hot)
    paths.update(write_answers(answers, out_root))
    paths["_load_profile"] = profile_path
    return paths


def main(argv: list[str] | None = None) -> None:
    """Command line for schedulers: ``python -m postlytics.plans.report --topics R --out O``."""
    import argparse
    from pyspark import SparkConf
    from ..session import CLUSTER_CONF, get_session
    parser = argparse.ArgumentParser(description="Answer the batch questions from landed topics.")
    parser.add_argument("--topics", required=True, help="folder holding topics/<topic>/...")
    parser.add_argument("--out", required=True, help="folder for the answer tables")
    parser.add_argument("--layout", default="connector", choices=["connector", "hive"])
    parser.add_argument("--pin-topic", default="pin")
    parser.add_argument("--geo-topic", default="geo")
    parser.add_argument("--user-topic", default="user")
    parser.add_argument("--post-years", default="2018-2022")
    parser.add_argument("--join-years", default="2015-2020")
    parser.add_argument("--median", default="exact", choices=["approx", "exact"])
    parser.add_argument("--incremental", action="store_true", help="read only what landed since the last run into --out")
    args = parser.parse_args(argv)

    def years(text):
        first, last = text.split("-")
        return int(first), int(last)

    local = SparkConf().get("spark.master", "local").startswith("local")
    spark = get_session(app="postlytics-batch", **({} if local else CLUSTER_CONF))
    if args.incremental:
        from .incremental import run_incremental as run
    else:
        run = run_batch
    paths = run(spark, args.topics, args.out,
                      {"pin": args.pin_topic, "geo": args.geo_topic, "user": args.user_topic},
                      args.layout, years(args.post_years), years(args.join_years), args.median)
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()

"""Mixing sources to target weights, with DataFrame functions only.

Tokens are counted per document and summed per source; weights give each source
a target, held at ``most_repeats`` times its size, the excess shared again by
weight. A source's repetition rate is target / size, and each of its documents is
taken floor(rate) times plus one copy more with probability equal to the
fraction, drawn from a hash of (seed, doc_id), without an id of (seed, text), so reruns agree.

The resharing has a closed form. With sources in ascending order of
cap / weight, sources are held at their caps from the front until the level
(what is left to share / the weight left) is at most the next cap / weight;
each source gets min(cap, level * weight).

Defined results: a null text has size 0 and is taken 0 words; a null source is a
source of its own, after all others; documents without an id draw by their text; an
empty table gives no rows; a table without words gives targets of 0. Rows with
equal ids share one draw, and so do equal texts without an id. Other columns pass through ``mixed_rows`` unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_PATTERN, staged

WEIGHTS = (5, 2, 1)
SALTS = 16


def word_count(column: str = "text") -> Column:
    """Words of a text: each becomes one character, the rest goes."""
    marked = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), WORD_PATTERN, "x")
    return F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = 3) -> DataFrame:
    """One row per source: source, source_size, target. Input: (source, size) rows.

    Works on one row per source, after a partial sum in every task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", F.get(cycle, ((place - 1) % len(weights)).cast("int")).cast("bigint"))
    per = per.withColumn("cap", most_repeats * F.col("source_size"))
    # Integer cross products order cap / weight exactly; ties share one level anyway.
    by_ratio = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = per.withColumn("left", F.sum("source_size").over(everything)
                         - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    per = per.withColumn("weight_left", F.sum("weight").over(everything)
                         - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    level = F.col("left") / F.col("weight_left")
    per = per.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    # the first level that holds no later source at its cap
    per = per.withColumn("level", F.first("level", ignorenulls=True).over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return per.select("source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def draw_key() -> Column:
    """What a document draws by: its id, without one its text."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))


def uniform(seed: int, column: str) -> Column:
    """A number in [0, 1) from the first 32 bits of md5('seed:key')."""
    text = F.concat(F.lit(f"{seed}:"), F.col(column))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def with_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = 3,
                seed: int = 17, broadcast_sources: int = 20_000) -> DataFrame:
    """``docs`` (doc_id, source, size and anything else) with source_size, target, copies. Documents draw
    by ``_draw`` (see :func:`draw_key`), or by their id where that column isn't given.

    Up to ``broadcast_sources`` sources (counted, not assumed) are broadcast. Beyond
    that their rows are repeated ``SALTS`` times and documents join on (source, salt),
    so that a source with a third of all rows is spread over many tasks.
    """
    if "_draw" not in docs.columns:
        docs = docs.withColumn("_draw", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    targets = staged(source_targets(docs.select("source", "size"), weights, most_repeats), "targets")
    key = lambda c: F.struct(c.isNull().alias("none"), F.coalesce(c, F.lit("")).alias("name"))
    right = targets.select(key(F.col("source")).alias("_source"), "source_size", "target")
    left = docs.withColumn("_source", key(F.col("source")))
    if targets.count() <= broadcast_sources:
        joined = left.join(F.broadcast(right), "_source")
    else:
        left = left.withColumn("_salt", F.pmod(F.xxhash64("_draw", "size"), F.lit(SALTS)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = left.join(right, ["_source", "_salt"]).drop("_salt")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor("_rate") + (uniform(seed, "_draw") < F.col("_rate") - F.floor("_rate")).cast("bigint")
    return (joined.withColumn("_rate", rate)
            .withColumn("copies", F.least(copies, F.lit(most_repeats).cast("bigint")))
            .drop("_source", "_rate", "_draw"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = 3, seed: int = 17) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    sizes = staged(docs.select("doc_id", "source", word_count().alias("size"), draw_key().alias("_draw")), "sizes")
    return with_copies(sizes, weights, most_repeats, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = 3,
               seed: int = 17) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, same columns.

    Targets come from a first pass over the sizes; with few sources, texts don't
    travel in the second one.
    """
    # the whole row in one column: no name of it can clash with those added here
    packed = docs.select(F.struct("*").alias("_row"), "doc_id", "source", word_count().alias("size"), draw_key().alias("_draw"))
    taken = with_copies(packed, weights, most_repeats, seed).where("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")

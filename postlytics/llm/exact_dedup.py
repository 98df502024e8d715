"""Exact dedup by progressive refinement, with DataFrame functions only.

Two texts are equal when they are identical after every run of white space becomes one space.
Texts are compared in three steps, each over what the step before has left:

1. by length: one pass over the texts writes (length, hash of the first characters) per row, and
   the lengths that occur once leave;
2. by that prefix hash: of the rest, a (length, prefix) that occurs once leaves;
3. by the full hash: a second pass over the texts hashes whole texts, but only those whose
   (length, prefix) is shared, and groups them.

What a step has left is kept as a bitmap of 2^``bits`` bits over hashed keys. It is broadcast:
its size is fixed by ``bits`` (2^26 bits are 8 MB) and doesn't grow with the data, so texts
are never shuffled to find out whether they survive. Two keys in one bit only let a unique
text through to the next step; the full hash (SHA-256) settles every case.

Groups are counted with a partial sum in every task. Their rows get the result by a join on the
full hash; groups that hold over 1 / ``hot_share`` of all rows, fewer than ``hot_share`` by
definition, are broadcast, so a text copied into a third of all rows is not sent to one task.

Defined results: a null text is the empty text (equal to it, and not to a single space). Of
equal texts the row with the smallest id stays, a null id only if all are null; of rows with
equal texts and equal ids, one stays. An empty table gives no rows. Other columns aren't read,
and ``keep_first`` passes them through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

BLANKS = r"[\x20\x09-\x0D]+"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), BLANKS, " ")


def _slot(bits: int, *columns: str) -> Column:
    """Place of a key in the bitmap, from 1."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << bits)) + 1


def bitmap_of(keys: DataFrame, bits: int, *columns: str) -> DataFrame:
    """(bucket, bitmap) rows of the keys' slots: at most 2^bits / 8 bytes in all."""
    slots = keys.select(_slot(bits, *columns).alias("slot"))
    return staged(slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")), "bitmap")


def with_mark(rows: DataFrame, bitmap: DataFrame, bits: int, *columns: str) -> DataFrame:
    """``rows`` with ``marked``: whether the slot of the key is set in the broadcast bitmap."""
    slot = _slot(bits, *columns)
    found = rows.withColumn("bucket", F.bitmap_bucket_number(slot)).withColumn("place", F.bitmap_bit_position(slot))
    found = found.join(F.broadcast(bitmap), "bucket", "left")
    byte = F.conv(F.hex(F.substring("bitmap", (F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, (F.col("place") % 8).cast("int")) == 1
    return found.withColumn("marked", F.coalesce(marked, F.lit(False))).drop("bucket", "place", "bitmap")


def _facts(rows: DataFrame, prefix_chars: int, bits: int, digest_all: bool) -> DataFrame:
    """Staged (rid, id, length, prefix, marked, digest) of ``rows`` (rid, id, text): the digest of
    the texts that survive the first two steps, and with ``digest_all`` of the others too."""
    texts = rows.select("rid", "id", normalised().alias("t"))
    sized = lambda keep: texts.select(*keep, F.length("t").alias("length"),
                                      F.xxhash64(F.substring("t", 1, prefix_chars)).alias("prefix"))
    slim = staged(sized([]), "lengths")
    lengths = slim.groupBy("length").count().where("count > 1")
    left = with_mark(slim, bitmap_of(lengths, bits, "length"), bits, "length").where("marked")
    shared = left.groupBy("length", "prefix").count().where("count > 1")
    bitmap = bitmap_of(shared, bits, "length", "prefix")
    marked = with_mark(sized(["rid", "id", "t"]), bitmap, bits, "length", "prefix")
    digest = F.sha2("t", 256)
    return staged(marked.select("rid", "id", "length", "prefix", "marked",
                                (digest if digest_all else F.when(F.col("marked"), digest)).alias("digest")), "facts")


def copies(rows: DataFrame, prefix_chars: int = 64, bits: int = 26, hot_share: int = 1000,
           digest_all: bool = False) -> DataFrame:
    """Per row of ``rows`` (rid, id, text; rid unique and stable, or drawn by the scan):
    rid, id, keep_id, group_size, kept, digest."""
    facts = _facts(rows, prefix_chars, bits, digest_all)
    key = ["length", "prefix", "digest"]
    groups = staged(
        facts.where("marked").groupBy(*key)
        .agg(F.count(F.lit(1)).alias("group_size"), F.min("id").alias("keep_id"),
             F.coalesce(F.min_by("rid", "id"), F.min("rid")).alias("keep_rid")).where("group_size > 1"), "groups")
    hot_size = facts.agg((F.count(F.lit(1)) / hot_share).alias("n")).scalar()
    hot = staged(groups.where(F.col("group_size") > hot_size), "hot-groups").select("digest", "group_size", "keep_id", "keep_rid")
    in_hot = facts.where("marked").join(F.broadcast(hot), "digest")
    others = facts.where("marked").join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(groups, key, "left")
    unique = facts.where("NOT marked").withColumns({"group_size": F.lit(None).cast("bigint"), "keep_id": F.col("id"),
                                                    "keep_rid": F.col("rid")})
    columns = ["rid", "id", "group_size", "keep_id", "keep_rid", "digest"]
    everything = in_hot.select(*columns).unionByName(others.select(*columns)).unionByName(unique.select(*columns))
    alone = F.col("group_size").isNull()
    return everything.select(
        "rid", "id", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"), "digest")


def exact_copies(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").alias("id"), F.col("text").alias("text"))
    return copies(rows, digest_all=True, **options).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; only shared prefixes are hashed in full."""
    whole = staged(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid")), "rows")
    rows = whole.select("rid", F.col("row.doc_id").alias("id"), F.col("row.text").alias("text"))
    gone = copies(rows, **options).where("NOT kept").select("rid")
    return whole.join(gone, "rid", "left_anti").select("row.*")

"""Exact deduplication by skew-safe combining, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from retaloom.llm.common import row_order

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Every run of white space as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def winners(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16
) -> DataFrame:
    """One row per distinct normalised text: digest, n_bytes, keep_id, group_size.

    Three combining stages, each of which groups by the digest *and the content*, so
    that texts are merged on equality, never on a digest alone:

    * local: before the first exchange every task folds its own rows, so a text that
      makes up a third of the input leaves each task as one row;
    * salted: the folded rows meet by (digest, salt), the salt being the task's number
      modulo ``salts``; a hot digest is spread over that many reducers;
    * global: at most ``salts`` rows per text are left to combine.
    """
    text = normalised(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("content")).withColumn(
        "digest", F.sha2("content", 256))
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "content")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    )
    return (
        salted.groupBy("digest", "content")
        .agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))
        .select("digest", F.octet_length("content").alias("n_bytes"), "keep_id", "group_size")
    )


def assign(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    The narrow rows (id, digest, byte length) find their winner by a shuffled join; a
    hot digest has one winner row, so adaptive execution can split its partition.

    Cases: NULL text equals empty text. The smallest non-NULL id stays; in a group
    whose ids are all NULL, keep_id is NULL and every row of it is kept. Rows that
    repeat an id with the same text are all marked kept if that id is the winner
    (``deduplicate`` returns one of them). Empty input gives an empty result. Further
    columns are neither read nor returned.
    """
    text = normalised(F.col(f"`{text_col}`"))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.sha2(text, 256).alias("digest"), F.octet_length(text).alias("n_bytes"))
    return rows.join(winners(docs, id_col, text_col, salts), ["digest", "n_bytes"]).select(
        "doc_id", "keep_id", F.col("group_size").cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def deduplicate(docs: DataFrame, salts: int = 16) -> DataFrame:
    """The documents that stay, with all their columns; their texts are unchanged.

    ``docs`` must have doc_id and text. The rows meet their winner on digest, byte length
    and id together, so no key is hot. Where rows repeat the winner's id and text, one of
    them stays, whichever comes first by all columns; so does one of a group in which all ids
    are NULL. The result does not depend on the partitions.
    """
    text = normalised(F.col("`text`"))
    # The id as two plain columns, so that join and window need the rows in one and the same order.
    known = lambda c: (F.coalesce(c, F.lit(0)).alias("id"), c.isNull().alias("no_id"))
    keys = ["digest", "n_bytes", "id", "no_id"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
        *known(F.col("`doc_id`")), F.sha2(text, 256).alias("digest"),
        F.octet_length(text).alias("n_bytes"))
    won = winners(docs, salts=salts).select("digest", "n_bytes", *known(F.col("keep_id")))
    one = Window.partitionBy(*keys).orderBy(row_order("whole", rows))
    return rows.join(won, keys).withColumn("r", F.row_number().over(one)).where("r = 1").select("whole.*")

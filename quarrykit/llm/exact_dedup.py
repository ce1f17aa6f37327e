"""Exact dedup by a heavy-hitter split, in DataFrame and SQL functions only.

Texts are equal when identical after each run of [\\x20\\x09-\\x0D] became one space; equality is
decided on the SHA-256 of that text. A Misra-Gries summary (Spark's approx_top_k keeps the counters of
Anderson et al., "A High-Performance Algorithm for Identifying Frequent Items in Data Streams", 2017, a
mergeable variant of Misra-Gries) finds frequent digests in one pass with map-side partial summaries. Exact
counts and first rows of all its counters are then verified; the winners, groups of two and more and at most `tracked` rows of about 100 bytes,
are broadcast, so that no copy of a frequent text is shuffled. All other digests are shuffled as usual: the summary has room for
`tracked` / 0.75 items, up to a power of two (32,768), and its error is at most 3.5 times the rows over that, so a digest of
more than one row in 9362 is always among the counters, and a group left to the shuffle is smaller than that.

Defined results: a null text counts as empty; of equal texts the row with the smallest id stays, a null id
only where the group has no other; of rows with that same id exactly one stays; an empty table gives no row.
bytes that aren't UTF-8 count as Spark's functions read them, as U+FFFD. Other columns pass through drop_exact_duplicates untouched, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents, free

WHITE = r"[\x20\x09-\x0D]+"
#: Counters of the summary, all of which are verified.
TRACKED = 16384


def digest(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " "), 256)


def heavy_digests(digests: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Frequent digests with exact count and first row: columns _digest, _first (null_id, id, row), _size."""
    top = digests.select(F.expr(f"approx_top_k(_digest, {tracked}, {tracked})").alias("_top"))
    likely = top.select(F.explode("_top").alias("_t")).where("_t.count > 1").select(F.col("_t.item").alias("_digest"))
    return cut(digests.join(F.broadcast(likely), "_digest").groupBy("_digest").agg(F.min(_order()).alias("_first"), F.count(F.lit(1)).alias("_size")).where("_size > 1"))


def _order() -> Column:
    return F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"))


def _digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return cut(df.select(df[id_col].alias("_id"), digest(df[text_col]).alias("_digest"), F.monotonically_increasing_id().alias("_row")))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED) -> DataFrame:
    """One row per row of df: id, keep_id, group_size, kept, text_sha256. The text is read once."""
    rows = _digests(df, id_col, text_col)
    heavy = heavy_digests(rows, tracked)
    group = Window.partitionBy("_digest")
    rest = rows.join(F.broadcast(heavy), "_digest", "left_anti").select("*", F.min(_order()).over(group).alias("_first"), F.count(F.lit(1)).over(group).alias("_size"))
    both = rows.join(F.broadcast(heavy), "_digest").select(rest.columns).unionByName(rest)
    return both.select(F.col("_id").alias(id_col), F.col("_first.id").alias("keep_id"), F.col("_size").alias("group_size"), (F.col("_first.row") == F.col("_row")).alias("kept"), F.col("_digest").alias("text_sha256"))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED) -> DataFrame:
    """The rows that stay, with all columns of df. Copies of frequent texts go map-side; of them only rows
    with the smallest id travel on to the shuffle that settles the rest, and of these, as of any group, the first of each task: Spark limits
    the groups of a row_number that only its first is asked of before it shuffles."""
    key, winner, nth = (free(df, n) for n in ("_digest", "_winner", "_nth"))
    heavy = heavy_digests(_digests(df, id_col, text_col), tracked).select(F.col("_digest").alias(key), F.struct(F.col("_first.id").alias("id")).alias(winner))
    keyed = df.withColumn(key, digest(df[text_col])).join(F.broadcast(heavy), key, "left")
    left = keyed.where(F.col(winner).isNull() | F.col(id_col).eqNullSafe(F.col(f"{winner}.id"))).drop(winner)
    first = Window.partitionBy(key).orderBy(F.col(id_col).asc_nulls_last())
    return left.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).select(*(F.col(f"`{c}`") for c in df.columns))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n
"""

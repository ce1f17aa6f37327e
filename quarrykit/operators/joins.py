"""Filters and joins. A side is never broadcast by hint: Spark does that when the size it measured allows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import TILE, similar_rows
from .project import NO_COVERAGE, best_of_both, col

ALL = "__all__"
#: Keys that a filter lists at most; longer lists join.
LISTED = 200


def passed(df: DataFrame, critical: str = "dq_has_critical_error", columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without critical error, without check columns or with the columns given."""
    return df.where(col(critical) == 0).select(*(col(c) for c in (columns or [c for c in df.columns if not c.startswith("dq_") and c != "failure_reason"])))


def failed(df: DataFrame, critical: str = "dq_has_critical_error") -> DataFrame:
    return df.where(col(critical) == 1)


def with_keys(df: DataFrame, column: str, keys: Iterable | DataFrame) -> DataFrame:
    """Rows whose column is among the keys: ['__all__'] all, [] none; a long list or a table is a semi join."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(keys[keys.columns[0]].alias("_key")).distinct(), col(column) == F.col("_key"), "left_semi")
    keys = list(keys)
    if keys == [ALL]:
        return df
    if len(keys) <= LISTED:
        return df.where(col(column).isin(keys)) if keys else df.limit(0)
    return with_keys(df, column, df.sparkSession.createDataFrame([(k,) for k in keys], f"_key {dict(df.dtypes)[column]}"))


def pending_changes(df: DataFrame, upload: str) -> DataFrame:
    return df.where((F.col("upload_id") == upload) & (F.col("status") == "PENDING") & (F.col("change_type") != "UNCHANGED"))


def on_map(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows whose coordinates are numbers within range."""
    return df.where(col(lat).try_cast("double").between(-90, 90) & col(lon).try_cast("double").between(-180, 180))


def slice_of(df: DataFrame, column: str, value: object) -> DataFrame:
    """One value's rows without that column; prunes partitions where the table has them by it."""
    return df.where(col(column) == F.lit(value)).drop(column)


def add_is_new(df: DataFrame, base: DataFrame, key: str, out: str = "is_new") -> DataFrame:
    """Whether the key isn't in the base. Repeated keys of the base don't multiply rows; a null key is new."""
    held = base.select(base[key].alias("_held")).where("_held IS NOT NULL").distinct()
    return df.join(held, df[key] == F.col("_held"), "left").withColumn(out, F.col("_held").isNull()).drop("_held")


def enrich(df: DataFrame, base: DataFrame, key: str, columns: Sequence[str], authoritative: Sequence[str] = ()) -> DataFrame:
    """Incoming values, where null those of the base, of columns that either has; authoritative ones the other way round. The base's key must be unique."""
    mine = [c for c in columns if c in base.columns]
    held = base.select(base[key].alias("_key"), *(base[c].alias(f"_base_{c}") for c in mine))
    joined = df.join(held, df[key] == F.col("_key"), "left")
    pick = lambda c: F.col(f"_base_{c}") if c not in df.columns else F.coalesce(F.col(f"_base_{c}"), df[c]) if c in authoritative else F.coalesce(df[c], F.col(f"_base_{c}"))
    return joined.withColumns({c: pick(c) for c in mine}).drop("_key", *(f"_base_{c}" for c in mine))


def lookup(df: DataFrame, base: DataFrame, key: str, columns: Sequence[str], how: str = "left", key_as: str | None = None) -> DataFrame:
    """df with columns of the base by key; key_as casts both keys, so that 5 and '5' meet."""
    kind = key_as or dict(df.dtypes)[key]
    held = base.select(base[key].cast(kind).alias("_key"), *(base[c] for c in columns))
    return df.join(held, df[key].cast(kind) == F.col("_key"), how).drop("_key")


def known_only(df: DataFrame, base: DataFrame, key: str) -> DataFrame:
    return df.join(base.select(base[key].alias("_key")), df[key] == F.col("_key"), "left_semi")


def inserts_and_deletes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    return new.join(old, list(keys), "left_anti"), old.join(new, list(keys), "left_anti")


def first_seen(sources: dict[str, DataFrame], keys: Sequence[str], time: str) -> DataFrame:
    """Reconciles sources by key: first time of all and the list of sources, from one aggregate over their union."""
    union = None
    for name, df in sources.items():
        part = df.select(*(col(k) for k in keys), col(time).alias("_time"), F.lit(name).alias("_source"))
        union = part if union is None else union.unionByName(part)
    grouped = union.groupBy(*keys).agg(F.min("_time").alias("first_seen"), F.sort_array(F.collect_set("_source")).alias("_sources"))
    return grouped.select(*keys, "first_seen", F.concat_ws(", ", "_sources").alias("sources"))


def merge_coverage(stored: DataFrame, incoming: DataFrame, key: str, technology: str, others: Sequence[str] = ()) -> DataFrame:
    """Full outer merge: new values win, the technology is the better of both."""
    a, b = stored.alias("a"), incoming.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    best = best_of_both(F.col(f"a.{technology}"), F.col(f"b.{technology}"))
    return joined.select(F.coalesce(f"b.{key}", f"a.{key}").alias(key), best.alias(technology), F.when(best == NO_COVERAGE, "no").when(best.isNotNull(), "yes").alias("available"), *(F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in others))


def flag_by_text_key(df: DataFrame, other: DataFrame, key: str, flag: str, default: str = "No") -> DataFrame:
    """The other's flag by key regardless of case, or the default. Of several the greatest."""
    flags = other.groupBy(F.lower(other[key]).alias("_key")).agg(F.max(other[flag]).alias("_flag"))
    return df.join(flags, F.lower(df[key]) == F.col("_key"), "left").withColumn(flag, F.coalesce("_flag", F.lit(default))).drop("_key", "_flag")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """df, after a look whether a key repeats."""
    bad = df.groupBy(*keys).count().where("count > 1").limit(3).collect()
    if bad:
        raise ValueError(f"keys of the {what} repeat: {[tuple(r)[: len(keys)] for r in bad]}")
    return df


def fan_in(base: DataFrame, metrics: dict[str, DataFrame], keys: Sequence[str], check: bool = True) -> DataFrame:
    """Left joins of metrics that have one row a key at most."""
    for name, df in metrics.items():
        base = base.join(assert_unique(df, keys, name) if check else df, list(keys), "left")
    return base


def image_pairs(feed: DataFrame, key: str, version: str = "_commit_version", kind: str = "_change_type") -> DataFrame:
    """Pre- and postimage of each update, by key and version: columns before, after (structs)."""
    values = [c for c in feed.columns if c not in (key, version, kind)]
    side = lambda k, out: feed.where(col(kind) == k).select(key, version, F.struct(*(col(c) for c in values)).alias(out))
    return side("update_preimage", "before").join(side("update_postimage", "after"), [key, version])


def overlay(stored: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], stored_wins: Sequence[str] = (), insert: bool = False) -> DataFrame:
    """Updates over stored values, column by column; stored_wins keep what is stored. Never deletes; inserts only if asked."""
    a, b = stored.alias("a"), updates.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full" if insert else "left")
    made = []
    for c in stored.columns:
        if c == key:
            made.append(F.coalesce(f"a.{key}", f"b.{key}").alias(key))
        elif c in columns and c in updates.columns:
            made.append((F.coalesce(f"a.{c}", f"b.{c}") if c in stored_wins else F.coalesce(f"b.{c}", f"a.{c}")).alias(c))
        else:
            made.append(F.col(f"a.{c}"))
    return joined.select(*made)


def to_update(df: DataFrame, stored: DataFrame, key: str, watched: str) -> DataFrame:
    """Rows that are new or whose watched column isn't what is stored, with `reason`."""
    held = stored.select(stored[key].alias("_key"), stored[watched].alias("_held"))
    joined = df.join(held, df[key] == F.col("_key"), "left")
    reason = F.when(F.col("_key").isNull(), "new").when(~df[watched].eqNullSafe(F.col("_held")), "changed")
    return joined.withColumn("reason", reason).where("reason IS NOT NULL").drop("_key", "_held")


def links_to_first(df: DataFrame, id_col: str, keys: Sequence[str]) -> DataFrame:
    """Rows that are equal in the keys, each linked to the one of the smallest id: df with first and size, for all but the first. A group of n gives n - 1 links,
    not all pairs; null keys link nothing."""
    some = reduce(lambda a, b: a & b, (col(k).isNotNull() for k in keys))
    groups = df.where(some).groupBy(*(col(k).alias(f"_k{n}") for n, k in enumerate(keys))).agg(F.min(id_col).alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
    same = reduce(lambda a, b: a & b, (col(k) == F.col(f"_k{n}") for n, k in enumerate(keys)))
    return df.join(groups, same).where(col(id_col) != F.col("first")).drop(*(f"_k{n}" for n in range(len(keys))))


def similar_pairs(names: DataFrame, name: str, block: Sequence[str], cutoff: float, tile: int = TILE) -> DataFrame:
    """The columns of block and x, y, similarity: pairs x < y of distinct names of a block (whose columns may be null) with an indel ratio of the cut-off or more. Exact.

    Names go to tasks, pairs don't: a block of up to `tile` names is compared in one place, a larger one is dealt out as pairs of its parts, so that no task has more than two parts at
    once, however many names a block has. Blocks of one name go nowhere."""
    rows = names.where(col(name).isNotNull()).select(F.struct(*(col(c) for c in block)).alias("block"), col(name).alias("_name")).distinct()
    sizes = rows.groupBy(F.col("block").alias("_block")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    dealt = rows.join(sizes, F.col("block") == F.col("_block")).withColumn("_parts", F.ceil(F.col("_n") * 2 / tile).cast("int"))
    part = F.when(F.col("_n") <= tile, F.lit(0)).otherwise(F.pmod(F.xxhash64("_name"), F.col("_parts")).cast("int"))
    other = F.when(F.col("_n") <= tile, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1))
    dealt = dealt.select("block", "_name", part.alias("_i"), F.explode(other).alias("_j"))
    # a tile of two parts has sides, one of a part with itself has none; two numbers, so that no two tiles are taken for one
    side = F.when(F.col("_i") == F.col("_j"), -1).when(F.col("_i") < F.col("_j"), 0).otherwise(1)
    which = ("block", F.least("_i", "_j"), F.greatest("_i", "_j"))
    tiles = dealt.select(F.xxhash64(*which).alias("tile"), F.xxhash64(F.lit(1), *which).alias("again"), side.alias("side"), "block", "_name")
    kind = dict(rows.dtypes)["block"]
    found = tiles.repartition("tile").sortWithinPartitions("tile", "again").mapInArrow(lambda x: similar_rows(x, cutoff), f"block {kind}, x string, y string, similarity double")
    return found.select("block.*", "x", "y", "similarity")

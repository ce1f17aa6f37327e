"""Merge, change capture and review of tables. A merge is a DataFrame of the table afterwards; sinks write it.

One rule holds for keys throughout: a null key is a key like any other, and of rows of one table that repeat a key the least by value counts, so that each result has one row a key. Tables may have MAP
columns, which are told apart and ordered by their entries."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from .project import col, comparable, has_map, signature
from .windows import first_per_key

KIND, VERSION = "_change_type", "_commit_version"


def sides(frames: Sequence[DataFrame], keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row a key: its columns in each frame as structs _0, _1, ... , null where the frame hasn't the key; of rows of a frame with one key the least by value.

    One shuffle of the union, with partial aggregation before it, whatever the number of frames. A frame may lack columns, which are null then."""
    others = [c for c in columns if c not in keys]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (f.select(*(col(c) for c in columns if c in f.columns), F.lit(n).alias("_of")) for n, f in enumerate(frames)))
    whole = F.struct(F.lit(True).alias("_there"), *(col(c) for c in others))
    if any(has_map(union.schema[c].dataType) for c in others):  # a map has no order: the least by what can be compared
        rank = F.struct(*(comparable(union, c).alias(c) for c in others))
        least = lambda n: F.min_by(F.when(F.col("_of") == n, whole), F.when(F.col("_of") == n, rank))
    else:
        least = lambda n: F.min(F.when(F.col("_of") == n, whole))
    return union.groupBy(*(col(k) for k in keys)).agg(*(least(n).alias(f"_{n}") for n in range(len(frames))))


def differs(kinds: DataFrame, columns: Iterable[str], a: str, b: str) -> Column:
    """Whether two structs of sides() differ in a column, null-safe; a map by its entries, whose types come from `kinds`."""

    def same(c: str) -> Column:
        x, y, kind = F.col(a).getField(c), F.col(b).getField(c), kinds.schema[c].dataType
        if isinstance(kind, MapType) and not has_map(kind.valueType):
            return F.array_sort(F.map_entries(x)).eqNullSafe(F.array_sort(F.map_entries(y)))
        return F.to_json(F.struct(x)).eqNullSafe(F.to_json(F.struct(y))) if has_map(kind) else x.eqNullSafe(y)

    return ~reduce(lambda p, q: p & q, map(same, columns), F.lit(True))


def _first(c: str, *at: int) -> Column:
    """The value of a column in the first of these sides where it isn't null."""
    return F.coalesce(*(F.col(f"_{n}").getField(c) for n in at))


def _row(keys: Sequence[str], columns: Sequence[str], value: Callable[[str], Column]) -> list[Column]:
    return [col(c) if c in keys else value(c).alias(c) for c in columns]


def merge_frames(master: DataFrame, inserts: DataFrame, updates: DataFrame, deletes: DataFrame, keys: Sequence[str], columns: Sequence[str], *, updated_only: bool = False, to_null: bool = False) -> DataFrame:
    """The master with updates over it, without deletes, with inserts: one row a key.

    An update's null leaves the master's value, unless to_null. updated_only keeps only rows that are updated. Of rows with one key, inserts
    yield to rows of the master that stay."""
    old, new, put = F.col("_0"), F.col("_1"), F.col("_2")
    stays = old.isNotNull() & F.col("_3").isNull() & (new.isNotNull() if updated_only else F.lit(True))
    over = lambda c: F.when(new.isNotNull(), F.col("_1").getField(c)).otherwise(F.col("_0").getField(c)) if to_null else _first(c, 1, 0)
    found = sides([master, updates, inserts, deletes.select(*(col(k) for k in keys))], keys, columns).where(stays | put.isNotNull())
    return found.select(*_row(keys, columns, lambda c: F.when(stays, over(c)).otherwise(F.col("_2").getField(c))))


def latest_change(feed: DataFrame, keys: Sequence[str], version: str = VERSION, kind: str = KIND) -> DataFrame:
    """The last change of each key: highest version, of one version any but a preimage."""
    last = F.when(col(kind) == "update_preimage", 1).otherwise(0)
    return first_per_key(feed, keys, [col(version).desc(), last, col(kind)])


def apply_feed(master: DataFrame, feed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The master after the last change of each key: inserts of keys that are there are updates, updates of others inserts."""
    last = latest_change(feed, keys).where(F.col(KIND) != "update_preimage")
    put, gone = last.where(F.col(KIND) != "delete").select(*(col(c) for c in columns)), last.where(F.col(KIND) == "delete").select(*(col(k) for k in keys))
    found = sides([master, put, gone], keys, columns).where("_1 IS NOT NULL OR _2 IS NULL")
    return found.select(*_row(keys, columns, lambda c: F.when(F.col("_1").isNotNull(), F.col("_1").getField(c)).otherwise(F.col("_0").getField(c))))


def partial_merge(master: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Updates and inserts; nothing is deleted."""
    return sides([master, incoming], keys, columns).select(*_row(keys, columns, lambda c: _first(c, 1, 0)))


def full_merge(master: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Updates and inserts; rows that don't come in are deleted."""
    return sides([master, incoming], keys, columns).where("_1 IS NOT NULL").select(*_row(keys, columns, lambda c: _first(c, 1, 0)))


def _compared(master: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, Column]:
    """Both sides by key, and whether a row that is on both differs."""
    others = [c for c in columns if c not in keys]
    return sides([master, incoming], keys, columns), differs(incoming, others, "_0", "_1")


def upsert_counts(master: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str], full: bool = False) -> DataFrame:
    """updates, inserts, deletes that a merge would make: one aggregate by key, one of all."""
    both, changed = _compared(master, incoming, keys, columns)
    old, new = F.col("_0").isNotNull(), F.col("_1").isNotNull()
    return both.agg(F.count_if(old & new & changed).alias("updates"), F.count_if(~old).alias("inserts"), F.count_if(~new & F.lit(full)).alias("deletes"))


def signature_upsert(master: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str], full: bool = False) -> tuple[DataFrame, bool]:
    """The merged table, incoming rows over the master's, and whether it differs; if it doesn't, it is the master as it stands."""
    if not any(upsert_counts(master, incoming, keys, columns, full).first()):
        return master.select(*columns), False
    both = sides([master, incoming], keys, columns)
    both = both.where("_1 IS NOT NULL") if full else both
    return both.select(*_row(keys, columns, lambda c: F.when(F.col("_1").isNotNull(), F.col("_1").getField(c)).otherwise(F.col("_0").getField(c)))), True


def _by_key(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """The rows of df whose key is (left_semi) or isn't (left_anti) a key of the other; null keys are keys."""
    held = other.select(*(col(k).alias(f"_d{n}") for n, k in enumerate(keys))).distinct()
    return df.join(held, reduce(lambda a, b: a & b, (df[k].eqNullSafe(F.col(f"_d{n}")) for n, k in enumerate(keys))), how)


def delete_keys(master: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _by_key(master, deletes, keys, "left_anti")


def upsert_all(master: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All incoming rows over the master; one shuffle by key."""
    both = incoming.withColumn("_from", F.lit(0)).unionByName(master.withColumn("_from", F.lit(1)), allowMissingColumns=True)
    return first_per_key(both, keys, [F.col("_from"), *(F.col(f"`{c}`").asc_nulls_last() for c in master.columns)]).drop("_from")


def insert_only(master: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    return master.unionByName(_by_key(incoming, master, keys, "left_anti"))


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: F.when(condition, v).otherwise(col(c)) for c, v in values.items()})


def delete_cascade(master: DataFrame, dependent: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    return delete_keys(master, deletes, keys), delete_keys(dependent, deletes, keys)


def update_or_delete(master: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Matched rows updated, rows that don't come in deleted, nothing inserted."""
    return sides([master, incoming], keys, columns).where("_0 IS NOT NULL AND _1 IS NOT NULL").select(*_row(keys, columns, lambda c: _first(c, 1, 0)))


def stage_upload(incoming: DataFrame, stored: DataFrame, key: str, columns: Sequence[str], upload: str, at: Column) -> DataFrame:
    """Incoming rows as changes to review: change_type by signature after nulls were filled from what is stored, change_id, status."""
    held = stored.select(stored[key].alias("_key"), *(stored[c].alias(f"_base_{c}") for c in columns if c != key))
    filled = incoming.select(*columns).join(held, F.col(key) == F.col("_key"), "left")
    filled = filled.withColumns({c: F.coalesce(col(c), F.col(f"_base_{c}")) for c in columns if c != key})
    old = F.struct(*(F.col(f"_base_{c}") for c in columns if c != key))
    new = F.struct(*(col(c).alias(f"_base_{c}") for c in columns if c != key))
    kind = F.when(F.col("_key").isNull(), "INSERT").when(old.eqNullSafe(new), "UNCHANGED").otherwise("UPDATE")
    made = {"signature": signature(columns), "change_type": kind, "upload_id": F.lit(upload)}
    out = filled.withColumns(made).withColumns({
        "change_id": F.concat_ws("|", col(key).cast("string"), "upload_id", "change_type"), "status": F.when(F.col("change_type") == "UNCHANGED", "PROCESSED_UNCHANGED").otherwise("PENDING"), "created_at": at,
    })
    return out.drop("_key", *(f"_base_{c}" for c in columns))


def stage_deletes(stored: DataFrame, keys: DataFrame, key: str, upload: str, at: Column) -> DataFrame:
    gone = stored.join(keys.select(key).distinct(), key, "left_semi")
    return gone.withColumns({"change_type": F.lit("DELETE"), "upload_id": F.lit(upload), "change_id": F.concat_ws("|", col(key).cast("string"), F.lit(upload), F.lit("DELETE")), "status": F.lit("PENDING"), "created_at": at})


def apply_approval(silver: DataFrame, staged: DataFrame, approved: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Silver after the approved changes, with signatures; of changes of one key that put a row the latest counts.

    What approved deletes are to do is verified as part of the plan: a key that approved changes both put and delete, in whatever order, raises, since its row would be there after a delete or be lost
    after an update."""
    chosen = staged.join(approved.select("change_id").distinct(), "change_id", "left_semi")
    change = F.when(F.col("change_type") == "DELETE", "DELETE").when(F.col("change_type").isin("INSERT", "UPDATE"), "PUT")
    chosen = chosen.withColumn("_change", change).where("_change IS NOT NULL")
    put = first_per_key(chosen.where("_change = 'PUT'"), [key], [F.col("created_at").desc() if "created_at" in chosen.columns else F.lit(0), F.col("change_id")])
    both = sides([silver, put.select(*(col(c) for c in columns)), chosen.where("_change = 'DELETE'").select(key)], [key], columns)
    clash = F.col("_1").isNotNull() & F.col("_2").isNotNull()
    wrong = F.concat(F.lit("deletes not applied: approved changes also put the row of key "), F.coalesce(col(key).cast("string"), F.lit("null")))
    stays = F.when(clash, F.raise_error(wrong).cast("boolean")).otherwise(F.col("_2").isNull())
    return both.where(stays).select(*_row([key], columns, lambda c: _first(c, 1, 0))).withColumn("signature", signature(columns))


def verify_deleted(after: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> int:
    """The number of keys that were to be deleted, once a table as it was written has none of them; else it raises with how many are left."""
    if left := _by_key(after, deletes, keys, "left_semi").count():
        raise ValueError(f"deletes not applied: {left} rows are still there")
    return deletes.select(*(col(k) for k in keys)).distinct().count()


def keep_rejected(rejected: DataFrame, staged: DataFrame, ids: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The table of rejected rows with those of these change ids, status REJECTED."""
    now = staged.join(ids.select("change_id").distinct(), "change_id", "left_semi").select(*columns)
    return partial_merge(rejected.select(*columns), first_per_key(now, [key], [F.col(f"`{c}`").asc_nulls_last() for c in columns]), [key], columns).withColumn("status", F.lit("REJECTED"))


def change_counts(feed: DataFrame, kind: str = KIND) -> DataFrame:
    """added, modified, deleted of a feed."""
    return feed.agg(F.count_if(col(kind) == "insert").alias("added"), F.count_if(col(kind) == "update_postimage").alias("modified"), F.count_if(col(kind) == "delete").alias("deleted"))


def column_change_counts(feed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For each column the updates that changed it, null-safe and by key and version, and the inserts that fill it.

    The plan doesn't grow with the columns: changed names are an array that is exploded once."""
    side = lambda k, n: feed.where(F.col(KIND) == k).select(*keys, VERSION, F.struct(*(col(c) for c in columns)).alias(n))
    pairs = side("update_preimage", "x").join(side("update_postimage", "y"), [*keys, VERSION])
    changed = F.array_compact(F.array(*(F.when(~F.col(f"x.`{c}`").eqNullSafe(F.col(f"y.`{c}`")), F.lit(c)) for c in columns)))
    filled = F.array_compact(F.array(*(F.when(col(c).isNotNull(), F.lit(c)) for c in columns)))
    names = pairs.select(F.explode(changed).alias("column")).union(feed.where(F.col(KIND) == "insert").select(F.explode(filled)))
    return names.groupBy("column").agg(F.count(F.lit(1)).alias("changes")).orderBy(F.desc("changes"), "column")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int = 1) -> DataFrame:
    """The change feed between two snapshots: inserts, deletes, pre- and postimages of rows that differ (null-safe)."""
    others = [c for c in new.columns if c not in keys]
    both = sides([old, new], keys, new.columns)
    image = lambda s, kind: F.struct(F.col(s).alias("row"), F.lit(kind).alias(KIND))
    changed = differs(new, others, "_0", "_1")
    made = F.when(F.col("_0").isNull(), F.array(image("_1", "insert"))).when(F.col("_1").isNull(), F.array(image("_0", "delete"))).when(changed, F.array(image("_0", "update_preimage"), image("_1", "update_postimage")))
    rows = both.select(*(col(k) for k in keys), F.explode(made).alias("_c"))
    return rows.select(*(col(c) if c in keys else F.col("_c.row").getField(c).alias(c) for c in new.columns), F.col(f"_c.{KIND}"), F.lit(version).alias(VERSION))


def unpushed(df: DataFrame, flag: str = "is_pushed") -> DataFrame:
    return df.where(~F.coalesce(col(flag), F.lit(False)))


def mark_pushed(df: DataFrame, pushed: DataFrame, key: str, flag: str = "is_pushed") -> DataFrame:
    done = pushed.select(F.col(key).alias("_key")).distinct()
    return df.join(done, df[key] == F.col("_key"), "left").withColumn(flag, F.coalesce(col(flag), F.lit(False)) | F.col("_key").isNotNull()).drop("_key")

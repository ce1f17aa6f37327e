"""Projections and standardisation, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

UNKNOWN = "Unknown"
#: Name spaces of UUIDs as their standard gives them.
DNS = "6ba7b8109dad11d180b400c04fd430c8"


def col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def free(df: DataFrame, name: str) -> str:
    """The name, made longer until df has no such column, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(columns: Iterable[str], *made: str) -> list[str]:
    """The columns whose names are none of those made, whatever the case of letters."""
    taken = {m.lower() for m in made}
    return [c for c in columns if c.lower() not in taken]


def has_map(kind: DataType) -> bool:
    """Whether a type holds a map, which has no order and no equality."""
    if isinstance(kind, StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType) or (isinstance(kind, ArrayType) and has_map(kind.elementType))


def comparable(df: DataFrame, c: str) -> Column:
    """A column in a form that has an order and equality: a map as its entries in the order of keys, other types that hold maps as JSON."""
    kind = df.schema[c].dataType
    if isinstance(kind, MapType) and not has_map(kind.keyType) and not has_map(kind.valueType):
        return F.array_sort(F.map_entries(col(c)))
    return F.to_json(F.struct(col(c))) if has_map(kind) else col(c)


def uuid3(text: Column, space: str = DNS) -> Column:
    """The name-based (MD5) UUID of a text, as an expression; null of null."""
    h = F.md5(F.concat(F.unhex(F.lit(space)), F.encode(text, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    parts = (F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))
    return F.when(text.isNotNull(), F.concat_ws("-", *parts))


def stable_id(df: DataFrame, out: str, parts: Sequence[str]) -> DataFrame:
    """The id that is there, or else the UUID of the parts together; null if a part is null or absent."""
    held = col(out) if out in df.columns else F.lit(None).cast("string")
    if any(p not in df.columns for p in parts):
        return df.withColumn(out, held)
    whole = F.concat(*(col(p).cast("string") for p in parts))
    return df.withColumn(out, F.coalesce(held, F.when(whole.isNotNull(), uuid3(whole))))


def map_values(df: DataFrame, column: str, mapping: DataFrame, out: str | None = None, key: str = "src", value: str = "dst") -> DataFrame:
    """Values by a dictionary table, regardless of case and outer blanks; what isn't in it is 'Unknown'.

    Equal keys: the smallest value. The dictionary joins by its key; Spark broadcasts it when its size allows."""
    words = mapping.groupBy(F.lower(F.trim(col(key))).alias("_key")).agg(F.min(col(value)).alias("_value"))
    joined = df.join(words, F.lower(F.trim(col(column))) == F.col("_key"), "left")
    return joined.withColumn(out or column, F.coalesce("_value", F.lit(UNKNOWN))).drop("_key", "_value")


def joined_name(df: DataFrame, out: str, rule: Column, parts: Sequence[str], keep_unknown: bool = True) -> DataFrame:
    """Where the rule holds: the parts that aren't null, joined by a blank; elsewhere the name as it is.

    A rule that is null leaves the name, or with keep_unknown=False drops the row, as two filters and a union would."""
    rows = df if keep_unknown else df.where(rule.isNotNull())
    return rows.withColumn(out, F.when(rule, F.concat_ws(" ", *(col(p) for p in parts))).otherwise(col(out)))


def number_in(text: Column | str) -> Column:
    """The number that is left of a text without all but digits and dots."""
    return F.regexp_replace(col(text), "[^0-9.]", "").try_cast("double")


def root_category(c: Column | str, roots: Mapping[str, Iterable[str]], other: str | None = None) -> Column:
    out = None
    for root, members in roots.items():
        out = (F if out is None else out).when(F.lower(col(c)).isin(*(m.lower() for m in members)), F.lit(root))
    return out.otherwise(F.lit(other)) if other is not None else out


def title_case(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.initcap(col(c)) for c in columns if c in df.columns})


def stamped(df: DataFrame, source: str, out: str, now: Column) -> DataFrame:
    """The time given where the source has a value; rows keep null elsewhere, and all do without that column."""
    return df.withColumn(out, F.when(col(source).isNotNull(), now) if source in df.columns else F.lit(None).cast("timestamp"))


def default_value(df: DataFrame, column: str, value: object, new_only: str | None = None) -> DataFrame:
    """Fills nulls, of new rows only if a flag column is named; makes the column if it is absent."""
    held = col(column) if column in df.columns else F.lit(None)
    filled = F.coalesce(held, F.lit(value))
    return df.withColumn(column, F.when(col(new_only), filled).otherwise(held) if new_only else filled)


def blank_without(df: DataFrame, columns: Iterable[str], needed: Iterable[str]) -> DataFrame:
    """Nulls in derived columns where one that they are derived from is missing."""
    there = F.lit(True)
    for n in needed:
        there &= col(n).isNotNull()
    return df.withColumns({c: F.when(there, col(c)) for c in columns if c in df.columns})


def signature(columns: Iterable[str], null_token: str | None = None) -> Column:
    """SHA-256 over the columns in order of their names, joined by bars. Nulls are skipped, so that a,null,b and a,b meet; a
    token in their place tells them apart."""
    each = (col(c).cast("string") for c in sorted(columns) if c != "signature")
    return F.sha2(F.concat_ws("|", *(F.coalesce(c, F.lit(null_token)) if null_token is not None else c for c in each)), 256)


def with_signature(df: DataFrame, columns: Iterable[str] | None = None, null_token: str | None = None) -> DataFrame:
    return df.withColumn("signature", signature(columns or df.columns, null_token))


def event_key(df: DataFrame, keys: Sequence[str], time: str, out: str = "event_key") -> DataFrame:
    """Key by hash, date and signature; of rows of one key the first by time, then signature, stays."""
    made = df.withColumns({out: F.sha2(F.concat_ws("_", *(col(k).cast("string") for k in keys)), 256), "date": F.to_date(col(time)), "signature": signature(df.columns)})
    first = Window.partitionBy(out).orderBy(col(time), "signature")
    return made.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def time_from(c: Column | str, form: str) -> Column:
    """Time by declared form: iso, epoch (seconds), or a date pattern; null for what doesn't fit."""
    if form == "iso":
        return col(c).cast("string").try_cast("timestamp")
    if form == "epoch":
        return F.timestamp_seconds(col(c).cast("string").try_cast("double"))
    return F.try_to_timestamp(col(c).cast("string"), F.lit(form))


def coverage_flags(df: DataFrame, key: str, columns: Mapping[str, str], binary: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """key, one boolean for each column (percents: positive; binary ones: 1) and the columns to keep, names lower-cased; rows without key go."""
    flag = lambda c: col(c) == 1 if binary else col(c) > 0
    return df.where(col(key).isNotNull()).select(col(key).alias(key.lower()), *(flag(c).alias(out.lower()) for c, out in columns.items()), *(col(c).alias(c.lower()) for c in keep))


TECHNOLOGIES = ("5G", "4G", "3G", "2G")
NO_COVERAGE = "no coverage"


def best_technology(flags: Mapping[str, Column | str]) -> Column:
    """The newest technology whose flag holds; a technology without flag counts as not there."""
    out = None
    for t in TECHNOLOGIES:
        if t in flags:
            out = (F if out is None else out).when(F.coalesce(col(flags[t]), F.lit(False)), F.lit(t))
    return out.otherwise(F.lit(NO_COVERAGE)) if out is not None else F.lit(NO_COVERAGE)


def availability(technology: Column | str) -> Column:
    return F.when(col(technology) == NO_COVERAGE, "no").otherwise("yes")


def best_of_both(a: Column, b: Column) -> Column:
    """The newer of two technologies; null only of two nulls."""
    out = None
    for t in (*TECHNOLOGIES, NO_COVERAGE):
        out = (F if out is None else out).when((a == t) | (b == t), F.lit(t))
    return out


def bucket_label(time: Column, minutes: int = 5) -> Column:
    """HH.MM - HH.MM of the bucket that a time is in."""
    start = F.window(time, f"{minutes} minutes")
    return F.concat_ws(" - ", F.date_format(start["start"], "HH.mm"), F.date_format(start["end"], "HH.mm"))


def label_parts(label: Column | str) -> tuple[Column, Column]:
    """A device label before and after its first ' - '."""
    cut = F.split(col(label), " - ", 2)
    return F.element_at(cut, 1), F.try_element_at(cut, F.lit(2))


def ingestion_id(key: Column | str, time: Column | str) -> Column:
    return F.concat(col(key).cast("string"), F.date_format(col(time), "yyyyMMddHHmmss"))


def truncated(c: Column | str, decimals: int = 3) -> Column:
    """Digits after the point cut off, towards zero; null for what is no number."""
    scale = 10**decimals
    return (col(c).cast("string").try_cast("double") * scale).cast("bigint") / F.lit(float(scale))


def readable_flags(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Check columns under their descriptions, with No where a check failed and Yes where it passed."""
    return df.select(*((F.when(col(c) == 1, "No").when(col(c) == 0, "Yes").alias(names[c]) if c in names else col(c)) for c in df.columns))


def checks_to_map(df: DataFrame, prefix: str = "dq_", out: str = "dq_results") -> DataFrame:
    """All integer columns of the prefix in one map by name without it."""
    checks = [c for c, t in df.dtypes if c.startswith(prefix) and t in ("int", "bigint", "smallint", "tinyint")]
    pairs = (x for c in checks for x in (F.lit(c[len(prefix) :]), col(c).cast("int")))
    return df.select(*(col(c) for c in df.columns if c not in checks), F.create_map(*pairs).alias(out))


def is_yes(c: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(col(c))) == "yes", F.lit(False))


def has_value(c: Column | str) -> Column:
    return F.coalesce(F.trim(col(c).cast("string")) != "", F.lit(False))


def same_availability(flag: Column | str, value: Column | str) -> Column:
    return is_yes(flag) == has_value(value)


def decimals(c: Column | str) -> Column:
    """Digits after the point of a number's text; those of scientific notation are counted as written out."""
    text = col(c).cast("string")
    mantissa = F.length(F.regexp_extract(text, r"^-?\d*\.?(\d*)", 1))
    power = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?\d+)$", 1).try_cast("int"), F.lit(0))
    return F.when(text.isNotNull(), F.greatest(mantissa - power, F.lit(0)))


def in_range(c: Column | str, least: float, most: float) -> Column:
    return F.coalesce(col(c).try_cast("double").between(least, most), F.lit(False))


def verdict(real_time: Column | None, declared: Column | None, speed: Column | None, new: Column | None = None) -> Column:
    """Yes if measured or declared; no if declared so; else by speed; else 'Unknown' for new rows and null for others."""
    yes = F.lit(False)
    for c in (real_time, declared):
        if c is not None:
            yes |= is_yes(c)
    out = F.when(yes, "Yes")
    if declared is not None:
        out = out.when(F.lower(F.trim(declared)) == "no", "No")
    if speed is not None:
        out = out.when(speed > 0, "Yes").when(speed == 0, "No")
    return out.when(new, UNKNOWN) if new is not None else out


def source_list(*sources: Column) -> Column:
    """Sources joined by a comma, without empty ones at either end."""
    return F.regexp_replace(F.concat_ws(", ", *sources), "^(, )+|(, )+$", "")

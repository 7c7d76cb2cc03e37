"""Canonical rows of all populations, and one pooled row for each entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.normalize import clean, norm_state, norm_zip5, to_id

NAMES, ADDRESSES = ("name1", "name2"), ("addr1", "addr2", "addr3")
CANONICAL = ("entity_id", "population", *NAMES, *ADDRESSES, "city", "state", "zip")
IDS = ("entity_ref_id", "link_ref_id")


class MissingColumns(ValueError):
    pass


def canonical(df: DataFrame, label: str, roles: dict[str, Sequence[str] | str | None], ids: Sequence[str] = IDS, key: str = "entity_id") -> DataFrame:
    """One population's rows under canonical names; roles: name and address lists, city, state, zip. Absent roles are null."""
    names, lines = list(roles.get("name") or []), list(roles.get("address") or [])
    wanted = [key, *names, *lines, *(roles.get(r) for r in ("city", "state", "zip") if roles.get(r)), *ids]
    if missing := [c for c in wanted if c not in df.columns]:
        raise MissingColumns(f"population {label!r} lacks {missing}; it has {df.columns}")
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    at = lambda own, i: own[i] if i < len(own) else None
    return df.select(
        F.col(key).cast("long").alias("entity_id"),
        F.lit(label).alias("population"),
        *(text(at(names, i)).alias(c) for i, c in enumerate(NAMES)),
        *(text(at(lines, i)).alias(c) for i, c in enumerate(ADDRESSES)),
        *(text(roles.get(c)).alias(c) for c in ("city", "state", "zip")),
        *(F.col(c).alias(c) for c in ids),
    )


def union_first(parts: Sequence[DataFrame], ids: Sequence[str] = IDS) -> DataFrame:
    """All populations' rows, numbered by population (ord), the first of each repeated (entity, population, names, lines).

    Ids, city, state and zip aren't compared, so later rows that differ in them alone go.  A key is at most one
    entity's rows of a population, so no window partition is large.
    """
    rows = None
    for i, part in enumerate(parts):
        own = part.withColumn("ord", F.lit(i))
        rows = own if rows is None else rows.unionByName(own)
    order = [F.col(c).asc_nulls_last() for c in (*ids, "city", "state", "zip")]
    w = Window.partitionBy("entity_id", "population", *NAMES, *ADDRESSES).orderBy("ord", *order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def pooled(rows: DataFrame, ids: Sequence[str] = IDS) -> DataFrame:
    """entity_id, populations, n_populations, names, addrs, cities, states, zips, and the first non-null of each id.

    Lists hold distinct non-blank values, by column, then row; rows by population and the order of union_first.
    """
    order = F.struct("ord", *(F.struct(F.col(c).isNull().alias("n"), F.col(c)).alias(f"o{i}") for i, c in enumerate((*ids, "city", "state", "zip", *NAMES, *ADDRESSES))))
    fields = [*NAMES, *ADDRESSES, "city", "state", "zip"]
    held = F.array_sort(F.collect_list(F.struct(order.alias("o"), *fields, *(to_id(c).alias(f"i_{c}") for c in ids))))

    def column(c: str) -> Column:
        return F.transform("_rows", lambda r: r[c])

    def values(cols: Sequence[str], blank: bool = False) -> Column:
        every = F.concat(*(column(c) for c in cols))
        return F.array_distinct(F.filter(every, lambda x: x.isNotNull() if blank else x.isNotNull() & (F.trim(x) != "")))

    labels = F.array_sort(F.collect_set("population"))
    grouped = rows.groupBy("entity_id").agg(held.alias("_rows"), F.array_join(labels, "|").alias("populations"), F.size(labels).alias("n_populations"))
    return grouped.select(
        "entity_id", "populations", "n_populations",
        values(NAMES).alias("names"), values(ADDRESSES).alias("addrs"), values(["city"]).alias("cities"), values(["state"]).alias("states"), values(["zip"], blank=True).alias("zips"),
        *(F.try_element_at(F.filter(column(f"i_{c}"), lambda x: x.isNotNull()), F.lit(1)).alias(c) for c in ids),
    )


def resolved(df: DataFrame, ids: Sequence[str] = IDS) -> DataFrame:
    """Adds ref_id (the first id that isn't null), ref_id_source and ref_id_conflict (the first two differ)."""
    source = F.lit("None")
    for c in reversed(ids):
        source = F.when(F.col(c).isNotNull(), c).otherwise(source)
    conflict = (F.col(ids[0]) != F.col(ids[1])) if len(ids) > 1 else F.lit(False)
    return df.withColumns({"ref_id": F.coalesce(*ids), "ref_id_source": source, "ref_id_conflict": F.coalesce(conflict, F.lit(False))})


def normalised(df: DataFrame) -> DataFrame:
    """Adds cities_n, states_n, zips_n: cleaned cities in order, sorted distinct states and zips, without empty ones."""
    kept = lambda c, f: F.filter(F.transform(c, f), lambda x: x != "")
    return df.withColumns({"cities_n": kept("cities", clean), "states_n": F.array_sort(F.array_distinct(kept("states", norm_state))), "zips_n": F.array_sort(F.array_distinct(kept("zips", norm_zip5)))})


def flattened(df: DataFrame, columns: Sequence[str] = ("names", "addrs", "cities", "states", "zips")) -> DataFrame:
    """Each list as its first value and as all values joined by ' | '."""
    out = df
    for c in columns:
        out = out.withColumn(f"{c}_first", F.coalesce(F.try_element_at(F.col(c), F.lit(1)), F.lit(""))).withColumn(f"{c}_all", F.array_join(c, " | ")).drop(c)
    return out

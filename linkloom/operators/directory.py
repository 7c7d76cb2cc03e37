"""The reference directory: identities, service locations, and what may identify a record."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom import constants as C
from linkloom.functions.normalize import clean, core_of, name_core, norm_state, norm_zip5, split_name, to_id, words
from linkloom.sources.shared import kept

SALTS = 16
#: Parts of the parents of a name, of which the ends are noted.
PARTS = 4
#: Names, and lines, of an id's locations that a row holds at most.
PIECE = 1024
ROLES = ("name", "addr1", "addr2", "city", "state", "zip")


def identities(blocks: Sequence[tuple[str, DataFrame]], extra: DataFrame | None = None) -> DataFrame:
    """ref_id, entity_type, roles of all exports, ids that aren't whole numbers dropped, the first row of each id (by export, then columns), normalised."""
    rows = None
    for i, (kind, df) in enumerate(blocks):
        own = df.select(to_id("ref_id").alias("ref_id"), F.lit(kind).alias("entity_type"), *(F.col(c).cast("string").alias(c) for c in ROLES), F.lit(i).alias("_ord"))
        rows = own if rows is None else rows.unionByName(own)
    if extra is not None:
        rows = rows.unionByName(extra.withColumn("_ord", F.lit(len(blocks))))
    w = Window.partitionBy("ref_id").orderBy("_ord", *(F.col(c).asc_nulls_last() for c in ROLES))
    rows = rows.where("ref_id IS NOT NULL").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_ord")
    return rows.withColumn("_s", split_name("name")).select("*", F.col("_s.primary").alias("primary"), F.col("_s.aliases").alias("aliases"), clean("city").alias("city_n"), norm_state("state").alias("state_n"), norm_zip5("zip").alias("zip5")).drop("_s")


def identity_counts(blocks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """entity_type, rows, without_id (no whole number), repeated (rows beyond the first of an id in the export)."""
    rows = None
    for kind, df in blocks:
        own = df.select(F.lit(kind).alias("entity_type"), to_id("ref_id").alias("id"))
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy("entity_type").agg(F.count("*").alias("rows"), F.count_if(F.col("id").isNull()).alias("without_id"), (F.count("id") - F.countDistinct("id")).alias("repeated"))


def location_counts(blocks: Sequence[DataFrame]) -> DataFrame:
    """rows, without_id, ids: one row over all location exports."""
    rows = None
    for df in blocks:
        own = df.select(to_id("ref_id").alias("id"))
        rows = own if rows is None else rows.unionByName(own)
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.col("id").isNull()).alias("without_id"), F.countDistinct("id").alias("ids"))


def pool_sizes(space: DataFrame, states: DataFrame) -> DataFrame:
    """state, n: the search rows that each state's entities meet."""
    return space.select("ref_id").join(states, "ref_id").groupBy("state").agg(F.count("*").alias("n"))


def locations(blocks: Sequence[DataFrame]) -> DataFrame:
    """ref_id and roles of all location exports, with the order of rows fixed by their columns."""
    rows = None
    for i, df in enumerate(blocks):
        own = df.select(to_id("ref_id").alias("ref_id"), *(F.col(c).cast("string").alias(c) for c in ROLES), F.lit(i).alias("ord"))
        rows = own if rows is None else rows.unionByName(own)
    return rows.where("ref_id IS NOT NULL")


def _order():
    return F.struct("ord", *(F.coalesce(F.col(c), F.lit("")) for c in ROLES))


def locations_as_identity(located: DataFrame, known: DataFrame) -> DataFrame:
    """An identity for each id that has locations only: the first value that isn't null of each column."""
    rest = located.join(known.select("ref_id").distinct(), "ref_id", "left_anti")
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), _order())).alias(c)
    return rest.groupBy("ref_id").agg(*(first(c) for c in ROLES)).select("ref_id", F.lit("PracticeLocation").alias("entity_type"), *ROLES)


def _values(rows: DataFrame) -> DataFrame:
    """ref_id, k (name or addr), v: distinct values, and o, their first place, so that a large id is reduced before it is collected."""
    long = rows.select("ref_id", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(c).alias("v"), F.lit(i).alias("i")) for i, (k, c) in enumerate((("name", "name"), ("addr", "addr1"), ("addr", "addr2")))))).alias("x"), _order().alias("o"))
    long = long.where("x.v IS NOT NULL AND trim(x.v) != ''").groupBy("ref_id", "x.k", "x.v").agg(F.min(F.struct("x.i", "o")).alias("o"))
    return long.withColumn("_n", F.row_number().over(Window.partitionBy("ref_id", "k").orderBy("o", "v")))


def _listed(k: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.when(F.col("k") == k, F.struct("_n", "v")))), lambda x: x["v"])


def _sets(rows: DataFrame) -> DataFrame:
    held = lambda e: F.array_sort(F.filter(F.collect_set(e), lambda x: x != ""))
    return rows.groupBy("ref_id").agg(F.count("*").alias("loc_n"), held(clean("city")).alias("loc_cities"), held(norm_state("state")).alias("loc_states"), held(norm_zip5("zip")).alias("loc_zips"))


def location_index(located: DataFrame, cap: int = C.LOCATION_CAP, need: DataFrame | None = None) -> DataFrame:
    """For each id: loc_n (uncapped), distinct loc_names and loc_addrs in order (the first cap of each: a limit of the audit itself), sets of cleaned cities, states, zips.

    At most cap values of an id are collected, never its rows; need prunes the scan to the ids asked for.
    """
    rows = located if need is None else located.join(need.select("ref_id").distinct(), "ref_id", "left_semi")
    # The first cap of each are known before anything is collected.
    listed = _values(rows).where(F.col("_n") <= cap).groupBy("ref_id").agg(_listed("name").alias("loc_names"), _listed("addr").alias("loc_addrs"))
    empty = F.array().cast("array<string>")
    return _sets(rows).join(listed, "ref_id", "left").withColumns({c: F.coalesce(c, empty) for c in ("loc_names", "loc_addrs")})


def location_pieces(located: DataFrame, need: DataFrame | None = None, barred: DataFrame | None = None) -> DataFrame:
    """location_index over every name and line of the ids, without the barred names (ref_id, name): a row for each piece of PIECE names and lines of an id; loc_n and sets are in piece 0."""
    rows = located if need is None else located.join(need.select("ref_id").distinct(), "ref_id", "left_semi")
    found = _values(rows)
    if barred is not None:
        found = found.join(barred.select("ref_id", F.lit("name").alias("k"), F.col("name").alias("v")), ["ref_id", "k", "v"], "left_anti")
    listed = found.withColumn("piece", F.floor((F.col("_n") - 1) / PIECE).cast("int")).groupBy("ref_id", "piece").agg(_listed("name").alias("loc_names"), _listed("addr").alias("loc_addrs"))
    return _sets(rows).withColumn("piece", F.lit(0)).join(listed, ["ref_id", "piece"], "full")


def location_names(located: DataFrame) -> DataFrame:
    """ref_id, name, core, city and whether each location's name may identify its parent.

    A core that SHARED_NAME_PARENTS or more parents use may not, nor one without a word besides its own
    city and compass words.
    """
    rows = located.select("ref_id", "name", "city").where("name IS NOT NULL").withColumn("core", name_core("name"))
    shared = rows.where("core != ''").groupBy("core").agg(F.countDistinct("ref_id").alias("parents"))
    compass = F.array(*[F.lit(x) for x in C.COMPASS])
    label = F.size(F.array_except(F.array_except(words(F.col("core")), words(clean("city"))), compass)) == 0
    # A common core may hold a third of all rows: its rows are dealt to SALTS parts.
    shared = shared.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("ref_id", "name", "city"), F.lit(SALTS)).cast("int")).join(shared, ["core", "_salt"], "left")
    return rows.select("ref_id", "name", "city", "core", F.coalesce("parents", F.lit(0)).alias("parents"), ((F.col("core") != "") & (F.col("parents") < C.SHARED_NAME_PARENTS) & ~label).alias("usable"))


def name_rules(located: DataFrame) -> DataFrame:
    """name, city, core, usable as in location_names, once for each distinct name and city.

    One pass notes the least and the greatest parent of each of PARTS parts of the parents. A core with SHARED_NAME_PARENTS of
    them is shared; only where there are fewer, and some may lie between the two, are parents counted.
    """
    rows = located.where("name IS NOT NULL")
    parted = rows.select("name", "city", "ref_id", F.pmod(F.xxhash64("ref_id"), F.lit(PARTS)).alias("_part"))
    ends = [f(F.when(F.col("_part") == i, F.col("ref_id"))).alias(f"{n}{i}") for i in range(PARTS) for n, f in (("low", F.min), ("high", F.max))]
    names = kept(parted.groupBy("name", "city").agg(*ends).withColumn("core", name_core("name")))
    by_core = names.where("core != ''").groupBy("core").agg(*(f(f"{n}{i}").alias(f"{n}{i}") for i in range(PARTS) for n, f in (("low", F.min), ("high", F.max))))
    found = F.array_distinct(F.filter(F.array(*(F.col(f"{n}{i}") for i in range(PARTS) for n in ("low", "high"))), lambda x: x.isNotNull()))
    more = reduce(or_, (F.coalesce(F.col(f"low{i}") < F.col(f"high{i}"), F.lit(False)) for i in range(PARTS)))
    by_core = by_core.select("core", (F.size(found) >= C.SHARED_NAME_PARENTS).alias("shared"), more.alias("more"))
    shared = by_core.where("shared").select("core")
    unsure = kept(names.join(by_core.where("NOT shared AND more").select("core"), "core", "left_semi").select("name", "core").distinct())
    if not unsure.isEmpty():
        counted = rows.select("name", "ref_id").distinct().join(unsure, "name").groupBy("core").agg(F.countDistinct("ref_id").alias("parents"))
        shared = shared.unionByName(counted.where(F.col("parents") >= C.SHARED_NAME_PARENTS).select("core"))
    compass = F.array(*[F.lit(x) for x in C.COMPASS])
    label = F.size(F.array_except(F.array_except(words(F.col("core")), words(clean("city"))), compass)) == 0
    out = names.select("name", "city", "core").join(shared.withColumn("_shared", F.lit(True)), "core", "left")
    return out.select("name", "city", "core", ((F.col("core") != "") & F.col("_shared").isNull() & ~label).alias("usable"))


def ruled(located: DataFrame, rules: DataFrame) -> DataFrame:
    """ref_id, name, core, usable of the located rows whose name and city the rules hold, each once."""
    # An eqNullSafe of cities alone would leave the join by name; a blank stands for a null beside the flag of it.
    keys = lambda df: df.withColumns({"_city": F.coalesce("city", F.lit("")), "_none": F.col("city").isNull()}).drop("city")
    own = keys(located.select("ref_id", "name", "city").where("name IS NOT NULL"))
    return own.join(keys(rules), ["name", "_city", "_none"]).select("ref_id", "name", "core", "usable").distinct()


def candidate_states(known: DataFrame, located: DataFrame) -> DataFrame:
    """ref_id, state: the record's own state and those of its locations, where not empty."""
    own = known.select("ref_id", F.col("state_n").alias("state"))
    theirs = located.select("ref_id", "state").distinct().join(known.select("ref_id"), "ref_id", "left_semi").select("ref_id", norm_state("state").alias("state"))
    return own.unionByName(theirs).where("state != ''").distinct()


def search_space(known: DataFrame, named: DataFrame) -> DataFrame:
    """ref_id, kind, core, full: every primary name, first alias, and usable location name (once for each id and core)."""
    primary = known.select("ref_id", F.lit("Name").alias("kind"), clean("primary").alias("full"))
    alias = known.where(F.size("aliases") > 0).select("ref_id", F.lit("Alias").alias("kind"), clean(F.col("aliases")[0]).alias("full"))
    place = named.where("usable").join(known.select("ref_id"), "ref_id", "left_semi").select("ref_id", F.lit("Location").alias("kind"), clean("name").alias("full"))
    place = place.groupBy("ref_id", "kind", core_of(F.col("full")).alias("core")).agg(F.min("full").alias("full")).select("ref_id", "kind", "full")
    return primary.unionByName(alias).unionByName(place).withColumn("core", core_of(F.col("full")))

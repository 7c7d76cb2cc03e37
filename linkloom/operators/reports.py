"""The audit's reports as aggregates; shares are rounded to four decimals and guarded against empty tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom import constants as C


def share(n: Column, total: Column) -> Column:
    return F.rint(n / F.greatest(total, F.lit(1)) * 10000) / 10000


def distribution(df: DataFrame, by: str) -> DataFrame:
    """Rows and share of each value."""
    total = df.agg(F.count("*").alias("total"))
    return df.groupBy(by).agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select(by, "n", share(F.col("n"), F.col("total")).alias("share"))  # one row


def in_order(df: DataFrame, by: str, order: tuple[str, ...]) -> DataFrame:
    """A distribution in the given order, with zeros for absent values."""
    names = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(order)], f"place int, {by} string")
    return names.join(distribution(df, by), by, "left").select("place", by, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("share", F.lit(0.0)).alias("share")).orderBy("place")


def funnel(rows: DataFrame, entities: DataFrame, known: DataFrame) -> DataFrame:
    """step, n: entities supplied, with an id, without, with an id too wide, found in the directory, not found."""
    widest = F.broadcast(known.agg(F.max(F.length(F.col("ref_id").cast("string"))).alias("widest")))  # one row
    wide = rows.crossJoin(widest).groupBy("entity_id").agg(F.bool_or(F.coalesce((F.length(F.col("entity_ref_id").cast("string")) > F.col("widest")) | (F.length(F.col("link_ref_id").cast("string")) > F.col("widest")), F.lit(False))).alias("wide"))
    found = entities.select("entity_id", "ref_id").join(known.select("ref_id", F.lit(True).alias("found")), "ref_id", "left").join(wide, "entity_id")
    one = found.agg(
        F.count("*").alias("supplied"), F.count("ref_id").alias("populated"), F.count_if(F.col("ref_id").isNull()).alias("blank"), F.count_if("wide").alias("implausible"),
        F.count_if("found").alias("resolves"), F.count_if(F.col("found").isNull() & F.col("ref_id").isNotNull()).alias("not_in_directory"),
    )
    return one.select(F.stack(F.lit(6), *[x for c in one.columns for x in (F.lit(c), F.col(c))]).alias("step", "n"))


def funnel_shares(steps: DataFrame) -> DataFrame:
    """The funnel with each step's share of the entities supplied."""
    total = steps.where("step = 'supplied'").select(F.col("n").alias("total"))
    return steps.crossJoin(F.broadcast(total)).select("step", "n", share(F.col("n"), F.col("total")).alias("share"))  # one row


def by_population(df: DataFrame, flag: Column, name: str) -> DataFrame:
    """Entities of each population label, those with the flag, and their share; an entity counts in each of its labels."""
    long = df.withColumn("_flag", flag).select(F.explode(F.split("populations", r"\|")).alias("population"), "_flag")
    out = long.groupBy("population").agg(F.count("*").alias("n"), F.count_if("_flag").alias(name))
    return out.withColumn("share", share(F.col(name), F.col("n")))


def by_type(audited: DataFrame) -> DataFrame:
    out = audited.groupBy("entity_type").agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == C.VERDICTS[1]).alias("corroborated"))
    return out.withColumn("share", share(F.col("corroborated"), F.col("n")))


def outcome(audited: DataFrame, untestable: DataFrame) -> DataFrame:
    """outcome, n: over all entities that carry an id."""
    kind = F.when(F.col("verdict") == C.VERDICTS[1], "confirmed").when(F.col("verdict").startswith("Probable"), "probable").when(F.col("verdict") == C.VERDICTS[4], "review").otherwise("wrong")
    every = audited.select(kind.alias("outcome")).unionByName(untestable.select(F.lit("untestable").alias("outcome")))
    return every.groupBy("outcome").agg(F.count("*").alias("n"))


def duplicate_ids(entities: DataFrame) -> DataFrame:
    """Entities that share their ref_id with others, and how many share it."""
    shared = entities.where("ref_id IS NOT NULL").groupBy("ref_id").agg(F.count("*").alias("holders")).where("holders > 1")
    return entities.select("entity_id", "ref_id").join(shared, "ref_id")


def id_conflicts(entities: DataFrame) -> DataFrame:
    return entities.where("ref_id_conflict").select("entity_id", "entity_ref_id", "link_ref_id")


def unreferenced(known: DataFrame, entities: DataFrame) -> DataFrame:
    return known.select("ref_id", "entity_type", "name").join(entities.where("ref_id IS NOT NULL").select("ref_id"), "ref_id", "left_anti")


def gains(now: DataFrame, before: DataFrame) -> DataFrame:
    """measure, baseline, now: both runs over the entities that both hold."""

    def measured(df: DataFrame, other: DataFrame, as_: str) -> DataFrame:
        own = df.join(other.select("entity_id"), "entity_id", "left_semi")
        one = own.agg(
            F.count_if(F.col("verdict") == C.VERDICTS[1]).alias("corroborated"), F.count_if("address_divergent").alias("divergent"),
            F.count_if("geo_conflict").alias("geo_conflict"), F.count_if(F.col("address_source") == "Location").alias("satellite"),
        )
        return one.select(F.stack(F.lit(4), *[x for c in one.columns for x in (F.lit(c), F.col(c))]).alias("measure", as_))

    return measured(before, now, "baseline").join(measured(now, before, "now"), "measure")


def strong_evidence(proposed: DataFrame) -> DataFrame:
    """evidence, n: what speaks for the proposals that are ready to load."""
    strong = proposed.where(F.col("tier") == C.TIERS[0])
    one = strong.agg(
        F.count("*").alias("strong"), F.count_if("exact_name_and_geo").alias("exact_name_and_geo"), F.count_if(F.col("address_score") >= 85).alias("street"),
        F.count_if(F.col("name_score") >= 99.9).alias("name"), F.count_if(F.col("match_margin") >= 10).alias("margin"), F.count_if(F.col("matched_via") == "Name").alias("own_name"),
    )
    return one.select(F.stack(F.lit(6), *[x for c in one.columns for x in (F.lit(c), F.col(c))]).alias("evidence", "n"))


def load_flags(proposed: DataFrame) -> DataFrame:
    """flag, n over strong proposals: id linked already, id proposed more than once, by a location, with a status note."""
    strong = proposed.where(F.col("tier") == C.TIERS[0])
    times = F.count("*").over(Window.partitionBy("ref_id"))
    one = strong.withColumn("_times", times).agg(
        F.count_if("id_already_linked").alias("already_linked"), F.count_if(F.col("_times") > 1).alias("shared_id"),
        F.count_if(F.col("matched_via") == "Location").alias("via_location"), F.count_if(F.col("status_note") != "").alias("status_note"),
    )
    return one.select(F.stack(F.lit(4), *[x for c in one.columns for x in (F.lit(c), F.col(c))]).alias("flag", "n"))


def estate(linked: DataFrame, proposed: DataFrame) -> DataFrame:
    """Linked and unlinked entities, and coverage now and with strong proposals loaded."""
    a = linked.agg(F.countDistinct("entity_id").alias("linked"))
    b = proposed.agg(F.count("*").alias("unlinked"), F.count_if(F.col("tier") == C.TIERS[0]).alias("strong"))
    both = a.crossJoin(F.broadcast(b))  # one row each
    total = F.col("linked") + F.col("unlinked")
    return both.select("linked", "unlinked", "strong", total.alias("total"), share(F.col("linked"), total).alias("coverage"), share(F.col("linked") + F.col("strong"), total).alias("coverage_if_loaded"))


def population_checks(proposed: DataFrame, supplied: DataFrame) -> DataFrame:
    """The identities that must hold: rows, distinct entities and the sum over tiers are all the population."""
    a = proposed.agg(F.count("*").alias("rows"), F.countDistinct("entity_id").alias("entities"), F.count("tier").alias("tiered"))
    return a.crossJoin(F.broadcast(supplied.agg(F.countDistinct("entity_id").alias("supplied")))).withColumn("holds", F.expr("rows = entities AND tiered = rows AND supplied = rows"))


#: A sheet: its rows, and the columns it is sorted by (descending with a minus).
Sheet = tuple[DataFrame, tuple[str, ...]]


def _order(by: tuple[str, ...]) -> list[Column]:
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in by]


def sorted_sheets(sheets: dict[str, Sheet]) -> dict[str, DataFrame]:
    return {title: df.orderBy(*_order(by)) for title, (df, by) in sheets.items()}


def sheet_places(sheets: dict[str, Sheet]) -> DataFrame:
    """sheet, place, entity_id, ref_id: where each row stands; a sheet holds a million rows at most, so one task may sort it."""
    out = None
    for title, (df, by) in sheets.items():
        entity = F.col("entity_id") if "entity_id" in df.columns else F.lit(None).cast("long")
        own = df.select(F.lit(title).alias("sheet"), F.row_number().over(Window.partitionBy(F.lit(title)).orderBy(*_order(by))).alias("place"), entity.alias("entity_id"), *([F.col("ref_id")] if "ref_id" in df.columns else [F.lit(None).cast("long").alias("ref_id")]))
        out = own if out is None else out.unionByName(own)
    return out


def accuracy_sheets(corrected: DataFrame, entities: DataFrame, known: DataFrame) -> dict[str, Sheet]:
    return {
        "Review_Queue": (corrected.where(F.col("verdict").isin(*C.VERDICTS[4:])), ("name_score", "entity_id")),
        "Geo_Conflict": (corrected.where("geo_conflict"), ("-name_score", "entity_id")),
        "Address_Divergence": (corrected.where("address_divergent"), ("address_score", "entity_id")),
        "Corrections_Recommended": (corrected.where("correction_recommended"), ("-suggested_name_score", "entity_id")),
        "Duplicate_IDs": (duplicate_ids(entities), ("ref_id", "entity_id")),
        "ID_Conflicts": (id_conflicts(entities), ("entity_id",)),
        "Scored_Detail": (corrected, ("entity_id",)),
        "Unreferenced_Records": (unreferenced(known, entities), ("ref_id",)),
    }


def coverage_sheets(proposed: DataFrame) -> dict[str, Sheet]:
    by = lambda c, *order: (proposed.where(c), order or ("-match_score", "entity_id"))
    tiered = lambda i: F.col("tier") == C.TIERS[i]
    shared = proposed.where(tiered(0)).withColumn("_n", F.count("*").over(Window.partitionBy("ref_id"))).where("_n > 1").drop("_n")
    return {
        "Ready_To_Load": by(tiered(0)),
        "Review_Probable": by(tiered(1)),
        "Ambiguous_Rivals": by(tiered(2), "match_margin", "entity_id"),
        "Review_Weak": by(tiered(3)),
        "Parent_Id_Proposals": by(tiered(0) & (F.col("matched_via") == "Location")),
        "Shared_Id_Proposals": (shared, ("ref_id", "entity_id")),
        "Id_Already_Linked": by(tiered(0) & F.col("id_already_linked")),
        "Status_Flagged": by(F.col("status_note") != ""),
        "No_Credible_Match": by(tiered(4), "entity_id"),
        "Candidates_Detail": by(~tiered(4), "entity_id"),
    }

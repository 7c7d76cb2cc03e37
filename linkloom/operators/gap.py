"""Which record should an entity without an id point at, and how strong is the evidence?"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom import constants as C
from linkloom.functions.normalize import clean, core_of, round1, status_note, usable_names
from linkloom.functions.scores import tier
from linkloom.operators.blocking import best_of_names, with_fallback
from linkloom.operators.directory import candidate_states, location_index, location_pieces, name_rules, ruled, search_space
from linkloom.operators.scoring import prepared_entities, prepared_records, scored
from linkloom.sources.shared import kept


def _forms(core, full):
    return F.array(F.when(core != "", core).otherwise(full), full)


def retrieve(entities: DataFrame, known: DataFrame, located: DataFrame, k: int = C.TOP_K, rules: DataFrame | None = None) -> DataFrame:
    """entity_id, ref_id, stage_a: the k best records by name in the entity's states, nationwide if it has none with records.

    Each (name, state) keeps k * OVER_FETCH rows of the search space before they are reduced to records.
    """
    rules = name_rules(located) if rules is None else rules
    space = search_space(known, ruled(located, rules.where("usable"))).where("full != ''")
    every = space.select(F.col("ref_id").alias("target"), _forms(F.col("core"), F.col("full")).alias("forms"))
    targets = every.join(candidate_states(known, located).select(F.col("ref_id").alias("target"), F.col("state").alias("block")), "target")
    named = entities.select("entity_id", F.posexplode(usable_names("names")).alias("pos", "n"), "states_n").withColumn("full", clean("n"))
    # One query for each entity and name.
    queries = named.select("entity_id", F.struct("entity_id", "pos").alias("query"), _forms(core_of(F.col("full")), F.col("full")).alias("forms"), F.explode_outer("states_n").alias("block"))
    # Both are read several times; what they are made of is the whole of the locations.
    queries, targets = with_fallback(kept(queries), kept(targets.select("target", "forms", "block")), every)
    best = best_of_names(queries, targets, k * C.OVER_FETCH, C.FLOOR).groupBy("block", "forms", "target").agg(F.max("score").alias("score"))
    # A record that k others precede for a name is preceded by them for the entity too.
    place = F.row_number().over(Window.partitionBy("block", "forms").orderBy(F.desc("score"), "target"))
    best = best.withColumn("_n", place).where(F.col("_n") <= k).groupBy("block", "forms").agg(F.collect_list(F.struct("target", "score")).alias("best"))
    # Dealt out once, by entity, before each name's records are spread.
    best = queries.select("entity_id", "block", "forms").distinct().join(best, ["block", "forms"]).select("entity_id", "best").repartition("entity_id").select("entity_id", F.inline("best"))
    best = best.groupBy("entity_id", F.col("target").alias("ref_id")).agg(F.max("score").alias("stage_a"))
    rank = F.row_number().over(Window.partitionBy("entity_id").orderBy(F.desc("stage_a"), "ref_id"))
    return best.withColumn("_n", rank).where(F.col("_n") <= k).drop("_n")


def score_candidates(found: DataFrame, entities: DataFrame, known: DataFrame, located: DataFrame, rules: DataFrame | None = None, cap: int | None = C.GAP_LOCATION_CAP) -> DataFrame:
    """All scores of retrieved pairs; location names that may not identify go, after the cap, and their addresses stay. Without a cap every other name and every line is met."""
    rules = name_rules(located) if rules is None else rules
    need = kept(found.select("ref_id").distinct())
    theirs = kept(located.join(need, "ref_id", "left_semi"))
    barred = ruled(theirs, rules.where("NOT usable AND core != ''"))
    if cap is None:
        index = location_pieces(theirs, barred=barred.select("ref_id", "name").distinct())
    else:
        index = location_index(theirs, cap).join(barred.groupBy("ref_id").agg(F.collect_set("name").alias("barred")), "ref_id", "left")
        index = index.withColumn("loc_names", F.when(F.col("barred").isNull(), F.col("loc_names")).otherwise(F.array_except("loc_names", "barred"))).drop("barred")
    own = prepared_entities(entities.withColumn("names", usable_names("names")))
    return scored(found, own, prepared_records(known, index))


def ranked(candidates: DataFrame) -> DataFrame:
    """Adds rank by match_score, margin to the runner-up (100 if alone), rivals by name, and the number considered."""
    w = Window.partitionBy("entity_id")
    order = w.orderBy(F.desc_nulls_last("match_score"), "ref_id")
    out = candidates.withColumns({"rank": F.row_number().over(order), "_next": F.lead("match_score").over(order), "candidates_considered": F.count("*").over(w), "_best": F.first("name_score").over(order)})
    out = out.withColumn("same_name_rivals", F.count_if(F.col("name_score") >= F.col("_best") - 2).over(w) - 1)
    return out.withColumn("match_margin", F.coalesce(round1(F.col("match_score") - F.col("_next")), F.lit(100.0))).drop("_next", "_best")


def proposals(entities: DataFrame, candidates: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """A row for each entity: the best record, evidence, tier, two alternates; entities without names or candidates too."""
    every = ranked(candidates)
    alternate = lambda r, c: F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"alt{r - 1}_{c}")
    others = every.where("rank IN (2, 3)").groupBy("entity_id").agg(*(alternate(r, c) for r in (2, 3) for c in ("ref_id", "ref_name", "match_score")))
    out = entities.select("entity_id", "populations", "names", "cities_n", F.size(usable_names("names")).alias("_usable")).join(every.where("rank = 1").drop("rank"), "entity_id", "left").join(others, "entity_id", "left")
    rule = tier(*(F.col(c) for c in ("name_score", "address_score", "city_score", "state_score", "zip_score", "match_margin", "matched_via", "matched_words")))
    exact = F.exists(usable_names("names"), lambda n: clean(n) == clean("ref_name")) & ((F.col("zip_score") == 100) | ((F.col("city_score") >= 95) & (F.col("state_score") == 100)))
    out = out.withColumns({
        "tier": F.when(F.col("_usable") == 0, C.TIERS[5]).when(F.col("ref_id").isNull(), C.TIERS[4]).otherwise(rule),
        "exact_name_and_geo": F.coalesce(exact, F.lit(False)),
        "status_note": status_note("ref_name"),
    })
    if claimed is not None:
        known = claimed.where("ref_id IS NOT NULL").select("ref_id").distinct().withColumn("id_already_linked", F.lit(True))
        out = out.join(known, "ref_id", "left").withColumn("id_already_linked", F.coalesce("id_already_linked", F.lit(False)))
    for c in ("name_score", "number_score", "body_score", "city_score", "state_score", "zip_score", "address_score", "match_score"):
        out = out.withColumn(c, round1(c))
    return out.drop("_usable")

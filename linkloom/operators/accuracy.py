"""Is the id that an entity carries right, and if not, which would be?"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom import constants as C
from linkloom.functions.normalize import clean, core_of, round1
from linkloom.functions.scores import correction, verdict
from linkloom.operators.blocking import best_in_blocks, with_fallback
from linkloom.operators.directory import location_index, location_pieces
from linkloom.operators.scoring import prepared_entities, prepared_records, scored


def _python_round(c: str) -> Column:
    """To one decimal of the exact binary value, unlike round1: suggestions are rounded so."""

    def rounded(c: pd.Series) -> pd.Series:
        return c.map(lambda x: round(x, 1), na_action="ignore")

    rounded.__annotations__ = {"c": pd.Series, "return": pd.Series}
    return F.pandas_udf(rounded, "double")(c)


SCORES = ("name_score", "number_score", "body_score", "city_score", "state_score", "zip_score", "address_score", "match_score")


def split_found(entities: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities whose ref_id the directory has, the others, null ids included)."""
    ids = known.select("ref_id")
    return entities.join(ids, "ref_id", "left_semi"), entities.join(ids, "ref_id", "left_anti")


def score_pairs(pairs: DataFrame, entities: DataFrame, known: DataFrame, located: DataFrame, cap: int | None = C.LOCATION_CAP) -> DataFrame:
    """Scores of pairs (entity_id, ref_id): locations are indexed for the ids in question only; a record's first cap names and lines of locations, or all of them."""
    need = pairs.select("ref_id")
    index = location_pieces(located, need) if cap is None else location_index(located, cap, need)
    return scored(pairs, prepared_entities(entities), prepared_records(known, index))


def audit(entities: DataFrame, known: DataFrame, located: DataFrame, cap: int | None = C.LOCATION_CAP) -> DataFrame:
    """Scores rounded to a decimal, verdict and flags for each testable entity (entities: pooled, resolved, normalised)."""
    found, _ = split_found(entities, known)
    out = score_pairs(found.select("entity_id", "ref_id"), found, known, located, cap)
    out = out.withColumns({c: round1(c) for c in SCORES})
    out = out.withColumn("verdict", verdict(F.col("name_score"), F.col("address_score")))
    return out.withColumns({
        "address_divergent": F.coalesce((F.col("verdict") == "ID corroborated") & (F.col("address_score") < 60), F.lit(False)),
        "geo_conflict": F.coalesce((F.col("name_score") >= 92) & (F.col("state_score") == 0), F.lit(False)),
    })


def reverse_lookup(entities: DataFrame, known: DataFrame) -> DataFrame:
    """entity_id, suggested_ref_id: the record of the best name among those in the entity's states (among all, if there are none there).

    Cores are compared with the record's core and the core of its first alias; an entity without names gets the smallest id.
    """
    named = entities.select("entity_id", F.explode_outer("names").alias("n"), "states_n").withColumn("full", clean("n"))
    text = F.when(core_of(F.col("full")) != "", core_of(F.col("full"))).otherwise(F.col("full"))
    queries = named.select(F.col("entity_id").alias("query"), F.monotonically_increasing_id().alias("name"), F.array(text).alias("forms"), F.explode_outer("states_n").alias("block"))
    every = known.select(F.col("ref_id").alias("target"), F.explode(F.filter(F.array(F.array(core_of(clean("primary"))), F.array(core_of(clean(F.try_element_at("aliases", F.lit(1)))))), lambda x: x.isNotNull())).alias("forms"), "state_n")
    queries, targets = with_fallback(queries, every.select("target", "forms", F.col("state_n").alias("block")).where("block != ''"), every.select("target", "forms"))
    best = best_in_blocks(queries.select("query", "block", "forms"), targets, 1)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "target"))
    return best.withColumn("_n", rank).where("_n = 1").select(F.col("query").alias("entity_id"), F.col("target").alias("suggested_ref_id"))


def corrections(audited: DataFrame, entities: DataFrame, known: DataFrame, located: DataFrame) -> DataFrame:
    """audited with a suggestion for each entity that isn't corroborated, scored by the same rules."""
    need = entities.join(audited.where("verdict != 'ID corroborated'").select("entity_id"), "entity_id", "left_semi")
    picks = reverse_lookup(need, known).withColumnRenamed("suggested_ref_id", "ref_id")
    again = score_pairs(picks, need, known, located).select(
        "entity_id", F.col("ref_id").alias("suggested_ref_id"), F.col("ref_name").alias("suggested_name"), F.col("entity_type").alias("suggested_type"), _python_round("name_score").alias("suggested_name_score"), _python_round("address_score").alias("suggested_address_score")
    )
    out = audited.join(again, "entity_id", "left").withColumn("suggestion_differs", F.col("suggested_ref_id") != F.col("ref_id"))
    return out.withColumn("correction_recommended", correction(F.col("suggestion_differs"), F.col("suggested_name_score"), F.col("name_score"), F.col("suggested_address_score"), F.col("address_score")))

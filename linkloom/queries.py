"""The audit's operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import proxies
from linkloom.constants import ADDRESS_WEIGHTS, TIERS, VERDICTS
from linkloom.functions import fuzzy, normalize, scores
from linkloom.operators import accuracy, directory, gap, pool, populations, reports
from linkloom.plans.audit import Audit
from linkloom.sources.shared import kept

POPULATIONS = tuple(populations.Population(label, flag, excluded=proxies.EXCLUDED) for label, flag in proxies.POPULATIONS)


def audit(spark: SparkSession, sf_dir: str) -> Audit:
    r = proxies.relations(spark, sf_dir)
    return Audit(r, POPULATIONS, [("Hospital", r["identity"])], [r["location"]])


def eval_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return populations.with_id(proxies.relations(spark, sf_dir), POPULATIONS[0])


def gap_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return populations.without_id(proxies.relations(spark, sf_dir), POPULATIONS[0])


def population_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, p = proxies.relations(spark, sf_dir), POPULATIONS[0]
    count = lambda df, name: df.agg(F.countDistinct("entity_id").alias("n")).select(F.lit(name).alias("part"), "n")
    return count(populations.with_id(r, p), "linked").unionByName(count(populations.without_id(r, p), "unlinked"))


def other_sources_listagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return populations.other_sources(proxies.relations(spark, sf_dir))


def canonical_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).rows().drop("ord")


def pool_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ("names", "addrs", "cities", "states", "zips")
    return pool.pooled(audit(spark, sf_dir).rows()).withColumns({c: F.array_join(c, " | ") for c in lists})


def resolve_id_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).entities().select("entity_id", "ref_id", "ref_id_source", "ref_id_conflict")


def normalised_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).entities().select("entity_id", *(F.array_join(c, "|").alias(c) for c in ("cities_n", "states_n", "zips_n")))


def street_number_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxies.relations(spark, sf_dir)["address"].select("info_id", normalize.street_number("address1").alias("number"), normalize.street_body("address1").alias("body"))


def split_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = normalize.split_name("name")
    return proxies.relations(spark, sf_dir)["identity"].select("ref_id", s["primary"].alias("primary"), F.array_join(s["aliases"], " | ").alias("aliases"), normalize.status_note("name").alias("note"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of part names: 64 distinct ones at any scale."""
    names = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_name").distinct()
    return names.select(F.col("p_name").alias("a")).crossJoin(F.broadcast(names.select(F.concat("p_name", F.lit(" inc")).alias("b"))))  # a fixed list of names


def indel_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("a", "b", normalize.round1(fuzzy.ratio_udf(F.col("a"), F.col("b"))).alias("score"))


def token_sort_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("a", "b", normalize.round1(fuzzy.token_sort_udf(F.col("a"), F.col("b"))).alias("score"))


def token_set_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("a", "b", normalize.round1(fuzzy.token_set_udf(F.col("a"), F.col("b"))).alias("score"))


def pair_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("a", "b", normalize.round1(fuzzy.pair_score_udf(F.col("a"), F.col("b"))).alias("score"))


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores from line items, with nulls."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    maybe = lambda c, k: F.when(F.col("l_partkey") % k != 0, c)
    return items.select(
        "l_orderkey", "l_linenumber", maybe(F.col("l_quantity") * 2, 13).alias("name"), maybe(F.col("l_discount") * 1000, 7).alias("address"), maybe(F.col("l_quantity") + 50, 5).alias("city"),
        maybe(F.when(F.col("l_suppkey") % 2 == 0, 100.0).otherwise(0.0), 3).alias("state"), maybe(F.when(F.col("l_suppkey") % 3 == 0, 100.0).otherwise(0.0), 4).alias("zip"),
        (F.col("l_tax") * 100).alias("margin"), F.when(F.col("l_returnflag") == "R", "Name").when(F.col("l_returnflag") == "A", "Alias").otherwise("Location").alias("via"), (F.col("l_linenumber") % 3).alias("words"),
    )


def weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"number": F.col("name"), "body": F.col("address"), "city": F.col("city"), "state": F.col("state"), "zip": F.col("zip")}
    return _graded(spark, sf_dir).select("l_orderkey", "l_linenumber", normalize.round1(scores.weighted(parts, ADDRESS_WEIGHTS)).alias("score"))


def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _graded(spark, sf_dir).select("l_orderkey", "l_linenumber", scores.verdict(F.col("name"), F.col("address")).alias("verdict"))


def tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = scores.tier(*(F.col(c) for c in ("name", "address", "city", "state", "zip", "margin", "via", "words")))
    return _graded(spark, sf_dir).select("l_orderkey", "l_linenumber", rule.alias("tier"))


def location_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return directory.locations_as_identity(a.located, directory.identities(a.exports))


def location_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = directory.location_index(audit(spark, sf_dir).located)
    return out.withColumns({c: F.array_join(c, "|") for c in ("loc_names", "loc_addrs", "loc_cities", "loc_states", "loc_zips")})


def location_name_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory.location_names(audit(spark, sf_dir).located)


def candidate_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return directory.candidate_states(a.known, a.located)


def search_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return directory.search_space(a.known, directory.location_names(a.located))


def identity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return directory.identity_counts([*a.exports, ("Repeated", a.exports[0][1].unionByName(a.exports[0][1].withColumn("ref_id", F.when(F.col("ref_id") % 3 != 0, F.col("ref_id")))))])


def location_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory.location_counts(audit(spark, sf_dir).places)


def pool_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return directory.pool_sizes(directory.search_space(a.known, directory.location_names(a.located)), directory.candidate_states(a.known, a.located))


def blocked_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).retrieved.withColumn("stage_a", normalize.round1("stage_a"))


def exact_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).candidates.withColumns({c: normalize.round1(c) for c in (*accuracy.SCORES, "stage_a")})


def accuracy_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).audited


def name_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).audited.select("entity_id", "ref_id", "name_score", "matched_name", "matched_ref_name", "matched_via", "matched_words")


def addr_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).audited_whole.select("entity_id", "ref_id", "number_score", "body_score", "city_score", "state_score", "zip_score", "address_score", "address_source")


def audited_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(audit(spark, sf_dir).audited, "verdict")


def corroborated_by_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return reports.by_population(a.audited.join(a.entities().select("entity_id", "populations"), "entity_id"), F.col("verdict") == VERDICTS[1], "corroborated")


def proposed_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(audit(spark, sf_dir).proposed, "tier")


def reverse_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).corrected


def gap_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audit(spark, sf_dir).proposed
    lists = {c: F.array_join(c, " | ") for c in ("names", "cities_n")}
    return out.withColumns(lists | {c: normalize.round1(c) for c in ("stage_a", "alt1_match_score", "alt2_match_score")})


def margin_rivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking, margins and rivals, over line items as candidates of their orders."""
    rows = _graded(spark, sf_dir).groupBy(F.col("l_orderkey").alias("entity_id"), F.col("l_linenumber").cast("long").alias("ref_id"))
    return gap.ranked(rows.agg(F.max("city").alias("match_score"), F.max(F.coalesce("name", F.lit(0.0))).alias("name_score")))


def exact_name_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).proposed.select("entity_id", "exact_name_and_geo")


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return reports.funnel(a.rows(), a.entities(), a.known)


def outcome_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return reports.outcome(a.audited, a.unverifiable)


def verdict_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(verdict(spark, sf_dir), "verdict")


def tier_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(tier(spark, sf_dir), "tier")


def by_entity_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_type(audit(spark, sf_dir).audited_whole)


def by_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_population(audit(spark, sf_dir).entities(), F.col("ref_id_conflict"), "conflicts")


def baseline_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a run that knows no service locations."""
    a = audit(spark, sf_dir)
    return reports.gains(a.audited, accuracy.audit(a.entities(), a.known, a.located.where("false")))


def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.duplicate_ids(audit(spark, sf_dir).entities())


def id_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.id_conflicts(audit(spark, sf_dir).entities())


def unverifiable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).unverifiable.select("entity_id", "ref_id")


def unreferenced_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return reports.unreferenced(a.known, a.entities())


def estate_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return reports.estate(a.entities(), a.proposed_whole)


def load_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.load_flags(audit(spark, sf_dir).proposed_whole)


def strong_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.strong_evidence(audit(spark, sf_dir).proposed)


def population_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return reports.population_checks(a.proposed, a.rows(False))


def flattened_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pool.flattened(audit(spark, sf_dir).entities().select("entity_id", "names", "addrs", "cities", "states", "zips"))


def usable_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, sf_dir).entities(False).select("entity_id", F.array_join(normalize.usable_names("names"), " | ").alias("usable"))


def first_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit of a trial run: so many entities of least id."""
    return audit(spark, sf_dir).entities(False).select("entity_id", "populations").orderBy("entity_id").limit(20)


def coverage_by_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_population(audit(spark, sf_dir).proposed, F.col("tier") == TIERS[0], "strong")


def proposed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(audit(spark, sf_dir).proposed.where(F.col("tier") == TIERS[0]), "entity_type")


def accuracy_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return reports.sheet_places(reports.accuracy_sheets(kept(a.corrected), a.entities(), a.known))


def coverage_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sheet_places(reports.coverage_sheets(kept(audit(spark, sf_dir).proposed)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        eval_population, gap_population, population_partition_counts, other_sources_listagg, canonical_union_dedup, pool_entities, resolve_id_conflict, normalised_arrays, street_number_body,
        split_name, indel_ratio, token_sort_ratio, token_set_ratio, pair_score, weighted_score, verdict, tier, location_identity, location_index, location_name_filter, candidate_states,
        search_space, identity_counts, location_counts, pool_sizes, blocked_topk, exact_scores, accuracy_audit, name_score, addr_scores, audited_verdicts, corroborated_by_population, proposed_tiers, reverse_lookup, gap_proposals, margin_rivals, exact_name_geo, funnel, outcome_overall, verdict_distribution, tier_distribution,
        by_entity_type, by_population, baseline_gains, duplicate_ids, id_conflicts, unverifiable, unreferenced_reference, estate_coverage, load_flags, strong_evidence, population_checks,
        flattened_lists, usable_names, first_entities, coverage_by_population, proposed_types, accuracy_sheets, coverage_sheets,
    )
}
QUERIES |= {
    "clean_text": lambda spark, sf_dir: proxies.relations(spark, sf_dir)["entity"].select("entity_id", normalize.clean("entity_name").alias("cleaned")),
    "name_core": lambda spark, sf_dir: proxies.relations(spark, sf_dir)["entity"].select("entity_id", normalize.name_core("entity_name").alias("core")),
    "norm_addr": lambda spark, sf_dir: proxies.relations(spark, sf_dir)["address"].select("info_id", normalize.norm_address("address1").alias("line")),
    "norm_state": lambda spark, sf_dir: proxies.relations(spark, sf_dir)["state"].select("state_id", normalize.norm_state("state_name").alias("code")),
    "norm_zip5": lambda spark, sf_dir: proxies.relations(spark, sf_dir)["address"].select("info_id", normalize.norm_zip5("zip").alias("zip5")),
}

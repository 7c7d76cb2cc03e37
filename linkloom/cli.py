"""Commands: inspect, run (accuracy), gap, accuracy-report, coverage-report.

A configuration names populations (label, path or query file, roles), identities and locations.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import constants as C
from linkloom.operators import accuracy, gap, reports
from linkloom.operators.directory import identities, identity_counts, location_counts, locations, locations_as_identity
from linkloom.operators.pool import IDS, canonical, flattened, normalised, pooled, resolved, union_first
from linkloom.sources import config, files, store, xlsx
from linkloom.sources.shared import kept


def note(text: str) -> None:
    print(text, flush=True)


def load_rows(spark: SparkSession, cfg: dict, query_key: str, extract: str | None) -> DataFrame:
    """The canonical rows: replayed from an extract, or read from the store or files and deduplicated."""
    if extract:
        note(f"replaying {extract}")
        rows = files.replay(spark, extract)
        return rows if "ord" in rows.columns else rows.withColumn("ord", F.lit(0))
    if connection := cfg.get("connection"):
        answer = store.query(spark, store.jdbc_options(connection), store.UPDATEABILITY_SQL).first()
        store.check_read_only(answer[0] if answer else None, connection.get("intent", "ReadOnly"))
    parts = []
    for p in cfg["populations"]:
        if p.get("path"):
            df = files.read_any(spark, p["path"])
        elif not p.get(query_key):
            raise ValueError(f"population {p['label']!r} has no {query_key}")
        else:
            with open(p[query_key], encoding="utf-8") as f:
                df = store.query(spark, store.jdbc_options(cfg["connection"]), f.read())
        parts.append(canonical(df, p["label"], p["roles"], p.get("ids", IDS), p.get("key", "entity_id")).toDF(*(*("entity_id", "population", "name1", "name2", "addr1", "addr2", "addr3", "city", "state", "zip"), *IDS)))
    supplied = [kept(p) for p in parts]
    for p, df in zip(cfg["populations"], supplied):
        note(f"  {p['label']}: {df.count():,} rows")
    out = kept(union_first(supplied))
    if again := sum(df.count() for df in supplied) - out.count():
        note(f"  {again:,} repeated rows left out")
    return out


def load_entities(cfg: dict, rows: DataFrame) -> DataFrame:
    """Pooled, resolved, normalised; says how many there are, and whether that was expected."""
    entities = kept(normalised(resolved(pooled(rows))))
    n, several = entities.agg(F.count("*"), F.count_if(F.col("n_populations") > 1)).first()
    note(f"{rows.count():,} rows of {n:,} entities, {several:,} of them in several populations")
    if text := store.drift(n, cfg.get("expected_entities")):
        note(f"NOTE: {text}")
    return entities


def load_directory(spark: SparkSession, cfg: dict) -> tuple[DataFrame, DataFrame]:
    places = [files.read_roles(spark, b, b["roles"]) for b in cfg["locations"]]
    exports = [(b["type"], files.read_roles(spark, b, b["roles"])) for b in cfg["identities"]]
    for r in identity_counts(exports).collect():
        note(f"  {r['entity_type']}: {r['rows']:,} rows, {r['without_id']:,} without an id, {r['repeated']:,} repeated ids left out")
    if places:
        r = location_counts(places).first()
        note(f"  locations: {r['rows']:,} rows of {r['ids']:,} ids, {r['without_id']:,} without an id")
    located = kept(locations(places))
    return kept(identities(exports, locations_as_identity(located, identities(exports)))), located


def run(spark: SparkSession, cfg: dict, out: str, extract: str | None = None, reverse: bool = True) -> DataFrame:
    rows = load_rows(spark, cfg, "query_file", extract)
    files.snapshot(rows, f"{out}_extract.parquet")
    known, located = load_directory(spark, cfg)
    entities = load_entities(cfg, rows)
    audited = kept(accuracy.audit(entities, known, located))
    scored = accuracy.corrections(audited, entities, known, located) if reverse else audited
    full = flattened(scored.join(entities.select("entity_id", "populations", "ref_id_source", "ref_id_conflict", "entity_ref_id", "link_ref_id", "names", "addrs", "cities", "states", "zips"), "entity_id"))
    files.snapshot(files.lead(full, ("entity_id", "populations", "ref_id", "ref_name", "verdict", "name_score", "address_score", "match_score")), f"{out}_scored.parquet")
    # Always written, also if empty, so that no older file of the name is counted.
    files.snapshot(flattened(accuracy.split_found(entities, known)[1]), f"{out}_unverifiable.parquet")
    return spark.read.parquet(f"{out}_scored.parquet")


def run_gap(spark: SparkSession, cfg: dict, out: str, extract: str | None = None, claimed: str | None = None, limit: int | None = None) -> DataFrame:
    rows = load_rows(spark, cfg, "gap_query_file", extract)
    if not extract:
        files.snapshot(rows, f"{out}_extract.parquet")
    known, located = load_directory(spark, cfg)
    entities = load_entities(cfg, rows)
    if limit:
        entities = entities.orderBy("entity_id").limit(limit)
    found = kept(gap.retrieve(entities, known, located))
    scored = kept(gap.score_candidates(found, entities, known, located))
    ids = files.read_any(spark, claimed).select(F.col("ref_id").try_cast("bigint").alias("ref_id")) if claimed else None
    proposed = kept(gap.proposals(entities, scored, ids))
    proposed = proposed if ids is not None else proposed.withColumn("id_already_linked", F.lit(False))
    flat = flattened(proposed, ("names", "cities_n"))
    files.snapshot(flat.where(F.col("tier") != C.TIERS[4]), f"{out}_gap_candidates.parquet")
    none = flat.where(F.col("tier") == C.TIERS[4])
    files.snapshot(none.select(*(c for c in none.columns if not c.startswith(("ref_", "alt"))), F.lit(None).cast("bigint").alias("ref_id")), f"{out}_gap_nomatch.parquet")
    return proposed


def accuracy_report(spark: SparkSession, scored: DataFrame, unverifiable: DataFrame, known: DataFrame, path: str, baseline: DataFrame | None = None, rows: DataFrame | None = None) -> None:
    """rows: the extract, for the funnel."""
    book = xlsx.Workbook(path)
    every = scored.select("entity_id", "ref_id", "ref_id_conflict", "entity_ref_id", "link_ref_id").unionByName(unverifiable.select("entity_id", "ref_id", "ref_id_conflict", "entity_ref_id", "link_ref_id"))
    if rows is not None:
        book.table("Funnel", reports.funnel_shares(reports.funnel(rows, every, known)), True)
    book.table("Outcome", reports.outcome(scored, unverifiable), True)
    book.table("Verdicts", reports.in_order(scored, "verdict", C.VERDICTS), True)
    book.table("By_Type", reports.by_type(scored), True)
    book.table("By_Population", reports.by_population(scored, F.col("verdict") == C.VERDICTS[1], "corroborated"), True)
    if baseline is not None:
        book.table("Gains", reports.gains(scored, baseline), True)
    book.sheet("Methodology", ["topic", "rule"], METHODOLOGY)
    for title, df in reports.sorted_sheets(reports.accuracy_sheets(scored, every, known)).items():
        book.table(title, df)
    book.close()


def coverage_report(spark: SparkSession, proposed: DataFrame, path: str, linked: DataFrame | None = None, rows: DataFrame | None = None) -> None:
    """rows: the extract. Fails if the rows, entities and tiers, or the extract's entities, aren't one population."""
    checks = reports.population_checks(proposed, proposed if rows is None else rows).first()
    if not checks["holds"]:
        raise ValueError(f"the population is not what it claims to be: {checks.asDict()}")
    book = xlsx.Workbook(path)
    book.table("Tiers", reports.in_order(proposed, "tier", C.TIERS), True)
    book.table("Strong_Evidence", reports.strong_evidence(proposed), True)
    book.table("By_Population", reports.by_population(proposed, F.col("tier") == C.TIERS[0], "strong").orderBy(F.desc("n")), True)
    book.table("By_Type", reports.distribution(proposed.where(F.col("tier") == C.TIERS[0]), "entity_type"), True)
    book.table("Load_Flags", reports.load_flags(proposed), True)
    if linked is not None:
        book.table("Estate", reports.estate(linked, proposed), True)
    book.sheet("Methodology", ["topic", "rule"], METHODOLOGY)
    for title, df in reports.sorted_sheets(reports.coverage_sheets(proposed)).items():
        book.table(title, df)
    book.close()
    tiers = {r["tier"]: r["n"] for r in reports.distribution(proposed, "tier").collect()}
    note(f"tiers sum to the population: {sum(tiers.values()):,} = {checks['rows']:,}")
    reviewed = sum(tiers.get(t, 0) for t in C.TIERS[:4]) + tiers.get(C.TIERS[5], 0) + tiers.get(C.TIERS[4], 0)
    note(f"sheets and no-match are the population: {reviewed:,} = {checks['rows']:,}")
    if rows is not None:
        note(f"the extract's entities are the population: {checks['supplied']:,} = {checks['entities']:,}")


def show_accuracy(scored: DataFrame) -> None:
    """Verdicts, flags, and counts by type and population."""
    reports.in_order(scored, "verdict", C.VERDICTS).show(truncate=False)
    good, divergent, conflict, single = scored.agg(
        F.count_if((F.col("verdict") == C.VERDICTS[1]) | F.col("verdict").startswith("Probable")), F.count_if("address_divergent"), F.count_if("geo_conflict"), F.count_if(~F.col("populations").contains("|"))
    ).first()
    note(f"corroborated or probable: {good:,}; divergent address: {divergent:,}; geographic conflict: {conflict:,}; in one population only: {single:,}")
    reports.by_type(scored).orderBy("entity_type").show(truncate=False)
    reports.by_population(scored, F.col("verdict") == C.VERDICTS[1], "corroborated").orderBy("population").show(truncate=False)


def show_coverage(proposed: DataFrame) -> None:
    """Tiers, counts by population, and what the strong proposals rest on."""
    reports.in_order(proposed, "tier", C.TIERS).show(truncate=False)
    strong = proposed.where(F.col("tier") == C.TIERS[0])
    ready, review, exact = proposed.agg(F.count_if(F.col("tier") == C.TIERS[0]), F.count_if(F.col("tier").isin(*C.TIERS[1:4])), F.count_if("exact_name_and_geo")).first()
    note(f"proposable: {ready:,}; for a reader: {review:,}; exact name and place: {exact:,}")
    reports.by_population(proposed, F.col("tier") == C.TIERS[0], "strong").orderBy("population").show(truncate=False)
    reports.distribution(strong, "matched_via").orderBy(F.desc("n"), "matched_via").show(truncate=False)
    reports.distribution(strong, "entity_type").orderBy(F.desc("n"), "entity_type").show(truncate=False)


METHODOLOGY = [
    ("Pooling", "Every name and address of every population an entity belongs to is a candidate; the best match counts."),
    ("Names", "35 % words in common, 65 % words in order, over full names and over names without corporate and health-care words; the higher."),
    ("Addresses", "Street number 30 %, street 22 %, city 18 %, state 8 %, zip 22 %, over the parts that both sides have."),
    ("Locations", "Service locations count as evidence of a record; names shared by five records or made of place words alone identify none."),
    ("Tiers", "Strong takes two agreements: the street, or the record's own name and the place. Rivals within 3 points make a case ambiguous."),
]


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="linkloom")
    sub = p.add_subparsers(dest="command", required=True)
    (c := sub.add_parser("inspect")).add_argument("files", nargs="+")
    for name, prefix in (("run", "audit"), ("gap", "gap")):
        c = sub.add_parser(name)
        c.add_argument("--config", required=True)
        c.add_argument("--extract")
        c.add_argument("--out", default=prefix)
        if name == "run":
            c.add_argument("--no-reverse", action="store_true")
        else:
            c.add_argument("--claimed")
            c.add_argument("--limit", type=int)
    c = sub.add_parser("accuracy-report")
    for flag in ("--scored", "--unverifiable", "--config"):
        c.add_argument(flag, required=True)
    for flag in ("--baseline", "--extract"):
        c.add_argument(flag)
    c.add_argument("--out", default="accuracy.xlsx")
    c = sub.add_parser("coverage-report")
    c.add_argument("--candidates", required=True)
    c.add_argument("--nomatch", required=True)
    for flag in ("--accuracy", "--extract"):
        c.add_argument(flag)
    c.add_argument("--out", default="coverage.xlsx")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("linkloom").getOrCreate()
    extract = lambda: files.replay(spark, a.extract) if a.extract else None
    if a.command == "inspect":
        for path in a.files:
            found = config.starter(path, files.read_any(spark, path).columns)
            note(json.dumps(found, indent=2))
            if missing := config.missing_roles(found["roles"]):
                note(f"set by hand: {', '.join(missing)}")
    elif a.command == "run":
        show_accuracy(run(spark, config.load(a.config), a.out, a.extract, not a.no_reverse))
    elif a.command == "gap":
        show_coverage(run_gap(spark, config.load(a.config), a.out, a.extract, a.claimed, a.limit))
    elif a.command == "accuracy-report":
        known, _ = load_directory(spark, config.load(a.config))
        accuracy_report(spark, spark.read.parquet(a.scored), spark.read.parquet(a.unverifiable), known, a.out, spark.read.parquet(a.baseline) if a.baseline else None, extract())
    else:
        proposed = spark.read.parquet(a.candidates).unionByName(spark.read.parquet(a.nomatch), allowMissingColumns=True)
        coverage_report(spark, proposed, a.out, spark.read.parquet(a.accuracy) if a.accuracy else None, extract())


if __name__ == "__main__":
    main()

"""Queries over every location of a record, however many."""

import pytest
from pyspark.sql import functions as F

from linkloom import proxies, queries
from linkloom.operators import accuracy, directory, scoring
from linkloom.plans.audit import Audit

SF = "/root/testdata/sf0.001"
PLACE = "ref_id long, name string, addr1 string, addr2 string, city string, state string, zip string"


@pytest.fixture()
def large(spark, monkeypatch):
    """An audit of one record of 300 locations, the last of which is an entity's own; all queries read it."""
    rows = [(1, f"Branch {i:03} Quill {chr(97 + i % 26)}{i}", f"{i} Oak Road", None, "Salem", "OH", "44001") for i in range(299)]
    rows.append((1, "Zephyr Harbor Annex", "9000 Zulu Parkway", None, "Salem", "OH", "44001"))
    known = [(1, "Quite Another Name", "1 Elm Street", None, "Dayton", "TX", "70001")]
    a = Audit({}, queries.POPULATIONS, [("Hospital", spark.createDataFrame(known, PLACE))], [spark.createDataFrame(rows, PLACE).repartition(3)])
    entity = [(7, "Client", ["Zephyr Harbor Annex"], ["9000 Zulu Pkwy"], ["salem"], ["OH"], ["44001"], ref) for ref in (1, None)]
    for linked, row in zip((True, False), entity):
        a._held["entities", linked] = spark.createDataFrame([row], "entity_id long, populations string, names array<string>, addrs array<string>, cities_n array<string>, states_n array<string>, zips_n array<string>, ref_id long")
    monkeypatch.setattr(queries, "audit", lambda spark, sf_dir: a)
    return a


def test_lines_of_all_locations_are_met(spark, large):
    (row,) = queries.addr_scores(spark, SF).collect()
    assert (row.number_score, row.body_score, row.address_score, row.address_source) == (100.0, 100.0, 100.0, "Location")


def test_names_of_all_locations_corroborate(spark, large):
    assert [tuple(r) for r in queries.by_entity_type(spark, SF).collect()] == [("Hospital", 1, 1, 1.0)]


@pytest.fixture()
def sought(spark, large):
    """The record is found by its own name, and only its last location agrees with the entity in its street."""
    large.__dict__["retrieved"] = spark.createDataFrame([(7, 1, 60.0)], "entity_id long, ref_id long, stage_a double")
    return large


def test_lines_and_names_of_all_locations_are_proposed(spark, sought):
    (row,) = queries.estate_coverage(spark, SF).collect()
    assert (row.linked, row.unlinked, row.strong) == (1, 1, 1)


def test_flags_rest_on_all_locations(spark, sought):
    assert {r.flag: r.n for r in queries.load_flags(spark, SF).collect()} == {"already_linked": 1, "shared_id": 0, "via_location": 1, "status_note": 0}


def test_barred_names_go_from_every_piece(spark, monkeypatch):
    monkeypatch.setattr(directory, "PIECE", 2)
    rows = spark.createDataFrame([(i % 2, f"Name {j}", f"{j} Oak Road", None, None, None, None) for i in (0, 1) for j in range(5)], PLACE)
    barred = spark.createDataFrame([(0, "Name 1"), (0, "Name 4")], "ref_id long, name string")
    found = directory.location_pieces(rows.withColumn("ord", F.lit(0)), barred=barred).orderBy("ref_id", "piece").collect()
    lines = [f"{j} Oak Road" for j in range(5)]
    assert [r.loc_addrs for r in found] == [lines[:2], lines[2:4], lines[4:]] * 2
    assert [r.loc_names for r in found] == [["Name 0"], ["Name 2", "Name 3"], [], ["Name 0", "Name 1"], ["Name 2", "Name 3"], ["Name 4"]]
    assert [r.loc_n for r in found] == [5, None, None] * 2


def test_pieces_of_a_record_score_as_one(spark, monkeypatch):
    r = proxies.relations(spark, SF)
    a = Audit(r, queries.POPULATIONS, [("Hospital", r["identity"])], [r["location"]])
    whole = sorted(map(str, accuracy.audit(a.entities(), a.known, a.located, 10**9).collect()))
    monkeypatch.setattr(directory, "PIECE", 9)
    monkeypatch.setattr(scoring, "ROWS", 5)
    monkeypatch.setattr(scoring, "PAIRS", 3)
    assert directory.location_pieces(a.located, a.known).where("piece > 2").count()
    assert sorted(map(str, accuracy.audit(a.entities(), a.known, a.located, None).collect())) == whole

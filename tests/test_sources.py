import json

import pytest

from linkloom import cli
from linkloom.sources import config, files, store, xlsx


def test_workbook_round_trip(spark, tmp_path):
    path = str(tmp_path / "a.xlsx")
    book = xlsx.Workbook(path)
    book.sheet("One", ["name", "n", "share"], [("a & <b>", 1, 0.5), (None, float("nan"), 1.0)], True)
    book.table("Two/with a very long title beyond the limit", spark.createDataFrame([(1, "x")], "id long, zip string"))
    book.close()
    assert list(xlsx.rows_of(path)) == [["name", "n", "share"], ["a & <b>", "1", "0.5"], [None, None, "1.0"]]
    assert [tuple(r) for r in files.read_any(spark, path).collect()] == [("a & <b>", "1", "0.5"), (None, None, "1.0")]


def test_delimited_files_stay_strings(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id;zip\n1;01234\n2;\n")
    assert [tuple(r) for r in files.read_any(spark, str(path)).collect()] == [("1", "01234"), ("2", None)]


def test_store_options():
    c = {"server": "db.example", "database": "d", "user": "u"}
    with pytest.raises(ValueError):
        store.jdbc_options(c, {})
    o = store.jdbc_options(c, {"AUDIT_DB_PASSWORD": "secret"})
    assert "applicationIntent=ReadOnly" in o["url"] and "secret" not in o["url"] and store.redacted(o)["password"] == "***"
    assert store.check_read_only("READ_ONLY")
    with pytest.warns(UserWarning):
        assert not store.check_read_only("READ_WRITE")
    assert store.drift(5, 5) is None and "+1" in store.drift(6, 5)


def test_the_store_is_asked_whether_it_is_read_only(spark, monkeypatch, tmp_path):
    asked = []

    def query(_, options, sql):
        asked.append((options["user"], sql))
        return spark.createDataFrame([("READ_WRITE",)], "answer string") if sql == store.UPDATEABILITY_SQL else spark.createDataFrame([(1, "A")] * 2, "entity_id long, n string").selectExpr("*", "1 AS entity_ref_id", "2 AS link_ref_id")

    monkeypatch.setattr(store, "query", query)
    monkeypatch.setenv("AUDIT_DB_PASSWORD", "secret")
    (tmp_path / "q.sql").write_text("SELECT 1")
    cfg = {"connection": {"server": "db.example", "database": "d", "user": "u"}, "populations": [{"label": "Client", "query_file": str(tmp_path / "q.sql"), "roles": {"name": ["n"]}}]}
    with pytest.warns(UserWarning, match="read-only"):
        assert cli.load_rows(spark, cfg, "query_file", None).count() == 1
    assert asked == [("u", store.UPDATEABILITY_SQL), ("u", "SELECT 1")]
    with pytest.warns(UserWarning), pytest.raises(ValueError, match="gap_query_file"):
        cli.load_rows(spark, cfg, "gap_query_file", None)


def test_roles():
    got = config.guess_roles(["TaxId", "RecordId", "RecordName", "HqAddress", "EmailAddress", "HqCity", "HqState", "HqZipCode"])
    assert got == {"id": "RecordId", "name": "RecordName", "address": ["HqAddress"], "city": "HqCity", "state": "HqState", "zip": "HqZipCode"}


def test_roles_screen_other_columns():
    got = config.guess_roles(["NetworkId", "Id", "ProviderName", "ListName", "IPAddress", "RealEstateValue", "CbsaCity", "Town City", "MailState", "PostalCode"])
    assert got == {"id": "Id", "name": "ListName", "address": [], "city": "Town City", "state": "MailState", "zip": "PostalCode"}
    assert config.missing_roles(got) == ["address"]
    assert config.guess_roles(["X_ID", "x_name", "Other Name"])["name"] == "x_name" and config.starter("a", ["FACILITY_ID"])["type"] == "FACILITY"
    assert config.guess_roles([]) == {"id": None, "name": None, "address": [], "city": None, "state": None, "zip": None}


def test_commands_end_to_end(spark, tmp_path, capsys):
    (tmp_path / "pop.csv").write_text("entity_id,n,addr,city,st,z,entity_ref_id,link_ref_id\n1,Reid Health,1 Main Street,Richmond,Indiana,47374,10,\n2,Acme Cardiology,9 Oak Rd,Dayton,OH,45402,10,\n3,Lost,,,,,99,\n")
    (tmp_path / "gap.csv").write_text("entity_id,n,addr,city,st,z,entity_ref_id,link_ref_id\n7,Acme Cardiology,9 Oak Road,Dayton,OH,45402,,\n8,..,,,,,,\n")
    (tmp_path / "dir.csv").write_text("RecordId,RecordName,Addr,City,State,Zip\n10,Reid Health (FKA Reid Hospital),1 Main St,Richmond,IN,47374\n11,Acme Cardiology,9 Oak Rd,Dayton,OH,45402\n")
    (tmp_path / "loc.csv").write_text("RecordId,RecordName,Addr,City,State,Zip\n10,Reid Urgent Care,2 Elm St,Dayton,OH,45402\n12,Solo Place,3 Elm St,Dayton,OH,45402\n")
    roles = {"name": ["n"], "address": ["addr"], "city": "city", "state": "st", "zip": "z"}
    ref = {"id": "RecordId", "name": "RecordName", "address": ["Addr"], "city": "City", "state": "State", "zip": "Zip"}
    cfg = {"populations": [{"label": "Client", "path": str(tmp_path / "pop.csv"), "roles": roles}], "identities": [{"type": "Hospital", "path": str(tmp_path / "dir.csv"), "roles": ref}], "locations": [{"path": str(tmp_path / "loc.csv"), "roles": ref}]}
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    cfg = config.load(str(tmp_path / "c.json"))
    out = str(tmp_path / "audit")
    scored = {r.entity_id: r for r in cli.run(spark, cfg, out).collect()}
    assert scored[1].verdict == "ID corroborated" and scored[2].suggested_ref_id == 11 and scored[2].correction_recommended
    assert [r.entity_id for r in spark.read.parquet(f"{out}_unverifiable.parquet").collect()] == [3]
    cfg["populations"][0]["path"] = str(tmp_path / "gap.csv")
    cfg["expected_entities"] = 3
    proposed = {r.entity_id: r for r in cli.run_gap(spark, cfg, str(tmp_path / "gap")).collect()}
    assert proposed[7].ref_id == 11 and proposed[7].tier == "Strong match - ready to load" and proposed[8].tier == "No usable name"
    known, _ = cli.load_directory(spark, cfg)
    cli.accuracy_report(spark, spark.read.parquet(f"{out}_scored.parquet"), spark.read.parquet(f"{out}_unverifiable.parquet"), known, str(tmp_path / "a.xlsx"))
    every = spark.read.parquet(str(tmp_path / "gap_gap_candidates.parquet"))
    cli.coverage_report(spark, every, str(tmp_path / "c.xlsx"))
    rows = files.replay(spark, f"{out}_extract.parquet")
    cli.accuracy_report(spark, spark.read.parquet(f"{out}_scored.parquet"), spark.read.parquet(f"{out}_unverifiable.parquet"), known, str(tmp_path / "b.xlsx"), None, rows)
    assert {r[0]: r[1] for r in list(xlsx.rows_of(str(tmp_path / "b.xlsx"), 1))[1:]} == {"supplied": "3", "populated": "3", "blank": "0", "implausible": "0", "resolves": "2", "not_in_directory": "1"}
    cli.show_accuracy(spark.read.parquet(f"{out}_scored.parquet"))
    cli.show_coverage(every)
    said = capsys.readouterr().out
    assert "corroborated or probable: 1" in said and "Hospital: 2 rows, 0 without an id, 0 repeated ids left out" in said and "proposable: 1" in said
    assert "locations: 2 rows of 2 ids" in said and "NOTE: 2 entities, -1 against the baseline of 3" in said and "tiers sum to the population" in said
    with pytest.raises(ValueError, match="not what it claims"):
        cli.coverage_report(spark, every.unionByName(every), str(tmp_path / "d.xlsx"))
    assert len(list(xlsx.rows_of(str(tmp_path / "a.xlsx"), 1))) >= 2 and list(xlsx.rows_of(str(tmp_path / "c.xlsx"), 1))[0] == ["place", "tier", "n", "share"]

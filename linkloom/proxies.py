"""The audit's relations, derived from the star-schema test tables in SQL that Spark and DuckDB both read.

Names come from part, entities from customer, the directory from supplier, its service locations from
all line items, link rows from all orders; those of other than pending orders point at no entity, and one in ten
suppliers has locations only, as its identity has another id.  Nulls, zeros, notes in parentheses and blanks are put in on purpose.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = """CASE {k} % 7 WHEN 0 THEN 'The ' || {n} || ' Medical Group, Inc.' WHEN 1 THEN {n} || ' & ' || {b} WHEN 2 THEN {n} || ' (FKA ' || {b} || ' Clinic)'
 WHEN 3 THEN {n} || ' Hospital (Closed 2020)' WHEN 4 THEN 'St. ' || {n} || ' (' || {b} || ')' WHEN 5 THEN upper({n}) ELSE {n} || ' Health System' END"""
_LINE = """CASE {k} % 9 WHEN 0 THEN 'P.O. Box ' || CAST({k} % 50 AS VARCHAR(20)) WHEN 1 THEN CAST({k} % 300 AS VARCHAR(20)) || ' First Street, Suite ' || CAST({k} % 9 AS VARCHAR(20))
 WHEN 2 THEN CAST({k} % 300 AS VARCHAR(20)) || 'B North ' || {b} || ' Avenue' WHEN 3 THEN '1st Ave' WHEN 4 THEN NULL ELSE CAST({k} % 300 AS VARCHAR(20)) || ' ' || {b} || ' Road' END"""
_ZIP = "CASE {k} % 11 WHEN 0 THEN NULL WHEN 1 THEN CAST({k} % 9000 AS VARCHAR(20)) WHEN 2 THEN '0' || CAST(1000 + {k} % 9000 AS VARCHAR(20)) || '-12' WHEN 3 THEN '' ELSE CAST(10000 + {k} % 60 AS VARCHAR(20)) END"


def _fill(sql: str, **values: str) -> str:
    for k, v in values.items():
        sql = sql.replace("{" + k + "}", v)
    return sql


#: name -> (tables it reads, SQL); later ones may read earlier ones.
RELATIONS: dict[str, str] = {
    "entity": """SELECT c_custkey AS entity_id, """ + _fill(_NAME, k="c_custkey", n="p_name", b="p_type") + """ AS entity_name,
 CASE WHEN c_custkey % 23 = 0 THEN ' Bulk Import ' WHEN c_custkey % 29 = 0 THEN 'Test' WHEN c_custkey % 41 = 0 THEN 'Old Load ' WHEN c_custkey % 5 = 0 THEN NULL ELSE 'manual' END AS description,
 CASE WHEN c_custkey % 31 = 0 THEN 1 ELSE 0 END AS archived,
 CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_custkey % 4 = 0 THEN 1 ELSE 0 END AS is_client,
 CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') OR c_custkey % 3 = 0 THEN 1 ELSE 0 END AS is_agency,
 CASE WHEN c_custkey % 7 = 2 THEN 1 ELSE 0 END AS is_facility, CASE WHEN c_custkey % 11 = 4 THEN 1 ELSE 0 END AS is_system, CASE WHEN c_custkey % 13 = 6 THEN 1 ELSE 0 END AS is_buyer, CASE WHEN c_custkey % 17 = 8 THEN 1 ELSE 0 END AS is_vendor,
 CAST(CASE c_custkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 1 ELSE NULL END AS INT) AS source_name_id,
 CAST(CASE WHEN c_custkey % 6 IN (0, 1) THEN c_custkey % 130 WHEN c_custkey % 6 = 2 THEN 0 ELSE NULL END AS INT) AS source_id, c_nationkey AS nation_id
 FROM customer JOIN part ON p_partkey = c_custkey""",
    "info": """SELECT c_custkey AS info_id, CASE WHEN c_custkey % 8 = 0 THEN ' ' WHEN c_custkey % 8 = 1 THEN NULL ELSE p_name || ' ' || p_brand END AS info_name,
 CASE WHEN c_custkey % 37 = 0 THEN 1 ELSE 0 END AS archived FROM customer JOIN part ON p_partkey = c_custkey""",
    "address": """SELECT c_custkey AS info_id, """ + _fill(_LINE, k="c_custkey", b="p_type") + """ AS address1, CASE WHEN c_custkey % 4 = 0 THEN p_brand ELSE NULL END AS address2,
 CAST(NULL AS VARCHAR(20)) AS address3, p_type || ' City' AS city, """ + _fill(_ZIP, k="c_custkey") + """ AS zip, c_nationkey AS state_id, CASE WHEN c_custkey % 10 = 3 THEN 0 ELSE 1 END AS is_default
 FROM customer JOIN part ON p_partkey = c_custkey""",
    "state": "SELECT n_nationkey AS state_id, CASE n_nationkey % 5 WHEN 0 THEN 'New York' WHEN 1 THEN 'tx' WHEN 2 THEN n_name WHEN 3 THEN 'W. Virginia' ELSE 'Ohio' END AS state_name FROM nation",
    "link": """SELECT CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE o_custkey + 10000000 END AS entity_id, CAST(CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 5 ELSE NULL END AS INT) AS source_name_id,
 CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 130 END AS INT) AS source_id FROM orders""",
    "source_name": "SELECT r_regionkey + 1 AS source_name_id, 'Source ' || r_name AS source_name FROM region",
    "identity": """SELECT CASE WHEN s_suppkey % 10 = 7 THEN s_suppkey + 1000000 ELSE s_suppkey END AS ref_id, """ + _fill(_NAME, k="s_suppkey", n="p_name", b="p_type") + """ AS name, """ + _fill(_LINE, k="s_suppkey", b="p_type") + """ AS addr1, CASE WHEN s_suppkey % 3 = 0 THEN p_brand ELSE NULL END AS addr2,
 p_type || ' City' AS city, state_name AS state, """ + _fill(_ZIP, k="s_suppkey") + """ AS zip FROM supplier JOIN part ON p_partkey = s_suppkey JOIN state ON state_id = s_nationkey""",
    "location": """SELECT DISTINCT l_suppkey AS ref_id, CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'East ' || p_type || ' City' WHEN 2 THEN p_type || ' Center' ELSE p_name || ' ' || p_brand END AS name,
 """ + _fill(_LINE, k="l_partkey", b="p_type") + """ AS addr1, CAST(NULL AS VARCHAR(20)) AS addr2, CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE p_type || ' City' END AS city, CASE l_partkey % 4 WHEN 0 THEN 'Ohio' WHEN 1 THEN 'TX' WHEN 2 THEN NULL ELSE 'new  york' END AS state,
 """ + _fill(_ZIP, k="l_partkey") + """ AS zip FROM lineitem JOIN part ON p_partkey = l_partkey""",
}

#: Label and flag of each population, and the descriptions that leave an entity out.
POPULATIONS = (("Client", "is_client"), ("Agency", "is_agency"), ("Facility", "is_facility"), ("System", "is_system"), ("Buyer", "is_buyer"), ("Vendor", "is_vendor"))
EXCLUDED = ("Bulk Import", "Test", "Old Load")

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every relation as a lazy DataFrame; nothing is registered in the session."""
    have: dict[str, DataFrame] = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    out: dict[str, DataFrame] = {}
    for name, sql in RELATIONS.items():
        used = [t for t in {**have, **out} if re.search(rf"\b(?:FROM|JOIN) {t}\b", sql)]
        for t in used:
            sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
        out[name] = spark.sql(sql.replace("VARCHAR(20)", "STRING"), **{t: {**have, **out}[t] for t in used})
    return out


def with_relations(sql: str) -> str:
    """A DuckDB query over the relations."""
    return "WITH " + ",\n".join(f"{n} AS ({s.replace('VARCHAR(20)', 'VARCHAR')})" for n, s in RELATIONS.items()) + "\n" + sql

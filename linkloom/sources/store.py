"""The operational store over JDBC."""

from __future__ import annotations

import os
import warnings

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(c: dict, environ: dict[str, str] | None = None) -> dict[str, str]:
    """Options from a connection block; the password comes from the environment variable that it names, and only from there."""
    environ = os.environ if environ is None else environ
    secret = environ.get(c.get("password_env", "AUDIT_DB_PASSWORD"))
    if not secret:
        raise ValueError(f"set {c.get('password_env', 'AUDIT_DB_PASSWORD')} to the password")
    if missing := [k for k in ("server", "database", "user") if not c.get(k)]:
        raise ValueError(f"connection lacks {missing}")
    flag = lambda k, default: str(c.get(k, default)).lower()
    parts = {
        "databaseName": c["database"], "encrypt": flag("encrypt", True), "trustServerCertificate": flag("trust_certificate", False),
        "applicationIntent": c.get("intent", "ReadOnly"), "multiSubnetFailover": flag("multi_subnet", False), "loginTimeout": str(c.get("timeout", 30)),
    }
    url = f"jdbc:sqlserver://{c['server']};" + ";".join(f"{k}={v}" for k, v in parts.items())
    return {"url": url, "user": c["user"], "password": secret}


def redacted(options: dict[str, str]) -> dict[str, str]:
    return options | {"password": "***"}


def query(spark: SparkSession, options: dict[str, str], sql: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).option("query", sql).load()


def check_read_only(answer: str | None, intent: str = "ReadOnly") -> bool:
    """Whether the database is read-only; warns if it should be and isn't. answer: what UPDATEABILITY_SQL gave."""
    ok = (answer or "").upper() == "READ_ONLY"
    if intent == "ReadOnly" and not ok:
        warnings.warn(f"read-only intent reached a database that answers {answer!r}", stacklevel=2)
    return ok


UPDATEABILITY_SQL = "SELECT CAST(DATABASEPROPERTYEX(DB_NAME(), 'Updateability') AS VARCHAR(20)) AS answer"


def drift(entities: int, expected: int | None) -> str | None:
    """A note if the number of entities isn't the expected one."""
    if not expected or entities == expected:
        return None
    return f"{entities:,} entities, {entities - expected:+,} against the baseline of {expected:,}"

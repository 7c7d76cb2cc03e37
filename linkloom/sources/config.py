"""Configuration files, and the roles that an export's columns seem to have."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        if path.lower().endswith((".yaml", ".yml")):
            import yaml

            return yaml.safe_load(f) or {}
        return json.load(f)


#: Words in column names that are not the record's own id or name, address, city or state.
NOT_ID = re.compile(r"tax|npi|network|parent|gpo|cbsa|340b|provider|sf|stock|dea|ccn|medicare", re.I)
NOT_ADDRESS = re.compile(r"email|url|web|ip", re.I)
NOT_CITY = re.compile(r"cbsa", re.I)
NOT_STATE = re.compile(r"estate|statement", re.I)


def guess_roles(columns: Sequence[str]) -> dict[str, str | list[str] | None]:
    """id and name (a pair of the same stem if there is one), address lines, city, state and zip by column name."""

    def matching(pattern: str, barred: re.Pattern | None = None) -> list[str]:
        return [c for c in columns if re.search(pattern, c, re.I) and not (barred and barred.search(c))]

    named = {c.lower(): c for c in columns}
    ids = matching(r"id$", NOT_ID)
    pairs = [(c, named[c[:-2].lower() + "name"]) for c in ids if len(c) > 2 and c[:-2].lower() + "name" in named]
    own, name = pairs[0] if pairs else (next(iter(ids), None), next(iter(matching(r"name$", NOT_ID)), None))
    first = {role: next(iter(matching(*rule)), None) for role, rule in (("city", (r"city", NOT_CITY)), ("state", (r"state", NOT_STATE)), ("zip", (r"zip|postal",)))}
    return {"id": own, "name": name, "address": matching(r"address", NOT_ADDRESS), **first}


def missing_roles(roles: dict[str, str | list[str] | None]) -> list[str]:
    """Roles that have to be set by hand."""
    return [r for r, c in roles.items() if not c]


def starter(path: str, columns: Sequence[str]) -> dict:
    """A configuration block for an export, to be corrected by hand; its type is the id column's stem."""
    roles = guess_roles(columns)
    return {"path": path, "type": re.sub(r"[_\s]*id$", "", roles["id"] or "", flags=re.I) or "Unknown", "roles": roles}

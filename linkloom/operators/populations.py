"""The two populations of an operational store: entities that carry a directory id, and those that carry none.

One parameterised builder serves every population; a Population says which flag, info table and
columns it reads.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The source name id of the directory whose ids are audited.
DIRECTORY = 1


@dataclass(frozen=True)
class Population:
    """label: as in results; flag: of entity; info_id, info_name: columns of info; excluded: entity descriptions left out."""

    label: str
    flag: str
    info_id: str = "info_id"
    info_name: str = "info_name"
    excluded: tuple[str, ...] = ()


def _nonzero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)) != 0


def alike(every: Sequence[Population]) -> list[list[Population]]:
    """Populations that differ in label and flag only, together."""
    out: dict[tuple, list[Population]] = {}
    for p in every:
        out.setdefault((p.info_id, p.info_name, p.excluded), []).append(p)
    return list(out.values())


def _universe(tables: Mapping[str, DataFrame], *group: Population) -> DataFrame:
    """Live, not excluded entities that hold one of the flags (of populations that are alike), with their info, default address and state."""
    p = group[0]
    entity = tables["entity"].where((F.col("archived") == 0) & reduce(or_, (F.col(x.flag) == 1 for x in group)))
    if p.excluded:
        entity = entity.where(~F.coalesce(F.trim("description"), F.lit("")).isin(*p.excluded))
    info = tables["info"].where(F.col("archived") == 0).select(F.col(p.info_id).alias("entity_id"), F.col(p.info_name).alias("info_name"))
    # The default flag belongs to the join: entities without a default address stay.
    address = tables["address"].where(F.col("is_default") == 1).select(F.col(p.info_id).alias("entity_id"), "address1", "address2", "address3", "city", "zip", "state_id")
    return entity.join(info, "entity_id").join(address, "entity_id", "left").join(tables["state"], "state_id", "left")


_COLUMNS = ("entity_id", "entity_name", "info_name", "address1", "address2", "address3", "city", "zip", "state_name")


def _flags(group: Sequence[Population]) -> list[str]:
    """What tells populations apart, for several at once."""
    return list(dict.fromkeys(p.flag for p in group)) if len(group) > 1 else []


def with_id(tables: Mapping[str, DataFrame], *group: Population) -> DataFrame:
    """Entities that carry an id themselves or in a link row; one row for each link row. Several populations that are alike: with their flags."""
    link = tables["link"].select("entity_id", F.col("source_name_id").alias("l_name"), F.col("source_id").alias("l_id"))
    rows = _universe(tables, *group).join(link, "entity_id", "left")
    # The ids themselves aren't filtered by source: a row may show another source's id.
    own = (F.col("source_name_id") == DIRECTORY) & _nonzero("source_id")
    linked = (F.col("l_name") == DIRECTORY) & _nonzero("l_id")
    return rows.where(own | linked).select(*_COLUMNS, F.col("source_id").alias("entity_ref_id"), F.col("l_id").alias("link_ref_id"), *_flags(group))


def other_sources(tables: Mapping[str, DataFrame]) -> DataFrame:
    """entity_id, other_sources: the distinct names of linked sources, sorted, comma-joined."""
    link = tables["link"].where(_nonzero("source_id")).select("entity_id", "source_name_id")
    named = link.join(tables["source_name"], "source_name_id").select("entity_id", "source_name")
    return named.groupBy("entity_id").agg(F.array_join(F.array_sort(F.collect_set("source_name")), ", ").alias("other_sources"))


def without_id(tables: Mapping[str, DataFrame], *group: Population) -> DataFrame:
    """Entities without any directory id; ids are typed nulls, other sources stand beside. Several populations that are alike: with their flags."""
    rows = _universe(tables, *group)
    held = (F.coalesce(F.col("source_name_id"), F.lit(0)) == DIRECTORY) & _nonzero("source_id")
    linked = tables["link"].where((F.coalesce(F.col("source_name_id"), F.lit(0)) == DIRECTORY) & _nonzero("source_id")).select("entity_id")
    rows = rows.where(~held).join(linked, "entity_id", "left_anti").join(other_sources(tables), "entity_id", "left")
    none = F.lit(None).cast("int")
    return rows.select(*_COLUMNS, none.alias("entity_ref_id"), none.alias("link_ref_id"), "other_sources", *_flags(group))

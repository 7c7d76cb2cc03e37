"""The audit's plans: from relations to audited entities and to proposals, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators import accuracy, gap
from linkloom.operators.directory import identities, locations, locations_as_identity, name_rules
from linkloom.operators.pool import canonical, normalised, pooled, resolved, union_first
from linkloom.operators.populations import Population, alike, with_id, without_id
from linkloom.sources.shared import kept

ROLES = {"name": ["entity_name", "info_name"], "address": ["address1", "address2", "address3"], "city": "city", "state": "state_name", "zip": "zip"}


@dataclass(eq=False)
class Audit:
    """tables: relations of the store; exports: (type, identities); places: location exports."""

    tables: Mapping[str, DataFrame]
    populations: Sequence[Population]
    exports: Sequence[tuple[str, DataFrame]]
    places: Sequence[DataFrame]
    _held: dict[tuple[str, bool], DataFrame] = field(default_factory=dict)

    @cached_property
    def located(self) -> DataFrame:
        return kept(locations(self.places))

    @cached_property
    def known(self) -> DataFrame:
        """Identities, and one made of locations for each id that has locations only."""
        own = identities(self.exports)
        return kept(identities(self.exports, locations_as_identity(self.located, own)))

    @cached_property
    def rules(self) -> DataFrame:
        return kept(name_rules(self.located))

    def rows(self, linked: bool = True) -> DataFrame:
        if ("rows", linked) not in self._held:
            build = with_id if linked else without_id
            found: dict[Population, DataFrame] = {}
            for group in alike(self.populations):
                # Joined once for all that are alike; each takes its rows by its flag.
                every = kept(build(self.tables, *group)) if len(group) > 1 else build(self.tables, *group)
                found |= {p: every.where(F.col(p.flag) == 1) if len(group) > 1 else every for p in group}
            self._held["rows", linked] = kept(union_first([canonical(found[p], p.label, ROLES) for p in self.populations]))
        return self._held["rows", linked]

    def entities(self, linked: bool = True) -> DataFrame:
        if ("entities", linked) not in self._held:
            self._held["entities", linked] = kept(normalised(resolved(pooled(self.rows(linked)))))
        return self._held["entities", linked]

    @cached_property
    def audited(self) -> DataFrame:
        return kept(accuracy.audit(self.entities(), self.known, self.located))

    @cached_property
    def audited_whole(self) -> DataFrame:
        """audited over every name and line of a record's locations."""
        return kept(accuracy.audit(self.entities(), self.known, self.located, None))

    @cached_property
    def unverifiable(self) -> DataFrame:
        return accuracy.split_found(self.entities(), self.known)[1]

    @cached_property
    def corrected(self) -> DataFrame:
        return accuracy.corrections(self.audited, self.entities(), self.known, self.located)

    @cached_property
    def retrieved(self) -> DataFrame:
        return kept(gap.retrieve(self.entities(False), self.known, self.located, rules=self.rules))

    @cached_property
    def candidates(self) -> DataFrame:
        return kept(gap.score_candidates(self.retrieved, self.entities(False), self.known, self.located, self.rules))

    @cached_property
    def proposed(self) -> DataFrame:
        return gap.proposals(self.entities(False), self.candidates, self.entities().select("ref_id"))

    @cached_property
    def candidates_whole(self) -> DataFrame:
        """candidates over every name and line of a record's locations."""
        return kept(gap.score_candidates(self.retrieved, self.entities(False), self.known, self.located, self.rules, None))

    @cached_property
    def proposed_whole(self) -> DataFrame:
        return gap.proposals(self.entities(False), self.candidates_whole, self.entities().select("ref_id"))

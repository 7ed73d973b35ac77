"""The whole job: records, links, clusters, best records, scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.operators import golden, matching, quality, records
from entityspark.storage import materialize, spread


@dataclass
class Resolution:
    """matches: the links of all rules, those for review included; found when they are first read, unless verdicts on
    them made the clusters."""

    records: DataFrame
    links: Callable[[], DataFrame]
    conflicts: DataFrame
    clustered: DataFrame
    entities: DataFrame

    @cached_property
    def matches(self) -> DataFrame:
        return materialize(self.links())


def resolve(raw: DataFrame, places: DataFrame | None = None, verdicts: DataFrame | None = None, pairs: str = "star") -> Resolution:
    """raw: the unified records. Normalised records and clusters are written once each, since many steps read them;
    pairs='star' keeps shared keys linear and gives the clusters, rules and counts that all pairs give. Only confirmed
    links make clusters, and without verdicts those are the exact rules' links, so similar strings and near points then
    wait for a reader of the matches."""
    d = records.normalize_records(spread(records.drop_in_liquidation(raw)))
    d = materialize(records.standardize_places(d, places) if places is not None else d)
    if verdicts is not None:
        found = materialize(matching.apply_verdicts(matching.all_matches(d, pairs), verdicts))
        links = lambda: found
    else:
        found, links = materialize(matching.exact_matches(d, pairs)), lambda: matching.all_matches(d, pairs)
    fields = {"name": "name_norm", "phone": "phone_norm", "email": "email_norm", "place": "place_norm"}
    clustered = materialize(golden.cluster_records(d, found))
    best = golden.unique_on(golden.merge_golden(clustered)).join(golden.entity_sources(clustered), "entity")
    entities = quality.quality_score(best).join(quality.matches_per_entity(clustered, found, stars=pairs == "star"), "entity", "left").withColumn("public_id", F.substring(F.sha2(F.concat(F.lit("e"), F.col("entity").cast("string")), 256), 1, 16))
    return Resolution(d, links, quality.detect_conflicts(d, fields), clustered, quality.drop_inactive_register_only(entities))

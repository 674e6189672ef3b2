"""The crosswalk build, from raw sources to enriched edges."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import edges, linkage, loads, publish

# The total order of the published crosswalk; key and identifier make it unique.
ORDER = ["company_name", "key_type", "key", "lei"]


def build_crosswalk(
    registrations: DataFrame,
    filed_ciks: DataFrame,
    filed_series: DataFrame,
    register: DataFrame,
    universe: DataFrame,
    filers: DataFrame,
    entities: DataFrame,
    as_of: str | None,
) -> DataFrame:
    """Official edges first, then name matches for the keys that none covers.

    Names are linked, and what that stages is written, when this is called; the rest is lazy. `publish_crosswalk`
    ends the build: it gates the edges and publishes them in order.
    """
    resolved = linkage.resolve_entities(linkage.named(filers), linkage.named(entities))
    tiered = edges.tier_edges(
        loads.type_registrations(registrations),
        edges.admit_identifiers(filed_ciks, register),
        edges.admit_identifiers(filed_series, register),
        resolved,
    )
    return edges.enrich_edges(tiered, register, universe, as_of)


def publish_crosswalk(built: DataFrame, register: DataFrame, folder: str) -> str:
    """End a build: edges staged in total order, audited as written, and published by a manifest row.

    An edge whose identifier fails its check digits and is not in the register publishes nothing (GateError).
    """
    return publish.publish_edges(built, register, folder, ORDER)

"""Declared tables of the record store: columns, natural key, id prefix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PROVENANCE = ("RECORD_ID", "_source", "_added")


@dataclass(frozen=True)
class TableSpec:
    """All cells are text, never null; missing is the empty text."""

    name: str
    prefix: str
    key: tuple[str, ...]
    columns: tuple[str, ...]

    def schema(self, provenance: bool = False) -> T.StructType:
        names = (*PROVENANCE[:1], *self.columns, *PROVENANCE[1:]) if provenance else self.columns
        return T.StructType([T.StructField(c, T.StringType()) for c in names])


def _spec(name: str, prefix: str, key: str, columns: str) -> TableSpec:
    return TableSpec(name, prefix, tuple(key.split()), tuple(columns.split()))


# The published tables and their columns, in published order.
SPECS = {
    s.name: s
    for s in (
        _spec("lineages", "LIN", "LINEAGE_NAME", "LINEAGE_NAME GENBANK_ACC SEQ_LENGTH GENUS_NAME SPECIES_NAME SEQUENCE"),
        _spec(
            "host_records", "HST", "LINEAGE_NAME SPECIES_NAME SITE_NAME REFERENCE_NAME",
            "LINEAGE_NAME ALT_NAME PARASITE_GENUS ORDER_NAME FAMILY_NAME GENUS_NAME SPECIES_NAME SUB_SPECIES_NAME HOST_STATUS HOST_AGE"
            " HOST_ENVIRONMENT CONTINENT_NAME COUNTRY_NAME COUNTRY_REGION_NAME SITE_NAME SITE_COORDINATES NUMBER_FOUND NUMBER_TESTED REFERENCE_NAME COMMENT",
        ),
        _spec("vector_records", "VEC", "LINEAGE_NAME VECTOR_SPECIES SITE_NAME REFERENCE_NAME", "LINEAGE_NAME VECTOR_SPECIES VECTOR_METHOD COUNTRY_NAME SITE_NAME REFERENCE_NAME"),
        _spec("alt_names", "ALT", "LINEAGE_NAME ALT_NAME REFERENCE_NAME", "LINEAGE_NAME ALT_NAME REFERENCE_NAME"),
        _spec("morpho_species", "MSP", "LINEAGE_NAME GENUS_NAME SPECIES_NAME REFERENCE_NAME", "LINEAGE_NAME GENUS_NAME SPECIES_NAME REFERENCE_NAME MORPHOLOGY_COMMENT"),
        _spec("references", "REF", "REFERENCE_NAME", "REFERENCE_NAME PUBLICATION_YEAR TITLE JOURNAL_NAME VOLUME_PAGES STUDY_TYPE"),
        _spec("lineage_history", "HIS", "LINEAGE_NAME EVENT OLD_NAME DATE SOURCE", "LINEAGE_NAME EVENT OLD_NAME NEW_NAME OLD_SEQUENCE NEW_SEQUENCE DATE REASON SOURCE RELEASE"),
        _spec("genomic_resources", "GEN", "LINEAGE_NAME RESOURCE_TYPE ACCESSION", "LINEAGE_NAME RESOURCE_TYPE ACCESSION DATABASE LENGTH_BP DESCRIPTION HOST_SPECIES REFERENCE_NAME DOI SOURCE NOTES"),
    )
}

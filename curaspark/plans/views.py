"""The driver's tables seen as the record store. Each view is one text that Spark and the oracle both read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "v_lineages": """SELECT p_partkey, 'P' || p_partkey AS LINEAGE_NAME, p_brand AS GENUS_NAME, p_name AS SPECIES_NAME,
        CASE WHEN p_size < 10 THEN 'Partial' ELSE 'Full' END AS SEQ_LENGTH FROM {part}""",
    "v_hosts": """SELECT 'P' || l_partkey AS LINEAGE_NAME, c_mktsegment AS ORDER_NAME, o_orderpriority AS FAMILY_NAME,
        'G' || (c_custkey % 97) AS GENUS_NAME,
        CASE WHEN c_custkey % 53 = 0 THEN '' ELSE 'G' || (c_custkey % 97) || ' s' || (c_custkey % 11) END AS SPECIES_NAME,
        n_name AS COUNTRY_NAME, r_name AS CONTINENT_NAME, 'S' || (l_suppkey % 7) AS SITE_NAME, 'R' || (o_orderkey % 20) AS REFERENCE_NAME,
        CAST(l_quantity AS INT) AS NUMBER_FOUND, CAST(l_quantity AS INT) + l_linenumber - 3 AS NUMBER_TESTED,
        l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "v_vectors": """SELECT 'P' || l_partkey AS LINEAGE_NAME, s_name AS VECTOR_SPECIES, n_name AS COUNTRY_NAME, 'S' || (l_suppkey % 7) AS SITE_NAME,
        'R' || (l_orderkey % 20) AS REFERENCE_NAME FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
        JOIN {nation} ON s_nationkey = n_nationkey WHERE l_returnflag = 'R'""",
    "v_references": """SELECT DISTINCT 'R' || (o_orderkey % 20) AS REFERENCE_NAME, 2000 + o_orderkey % 20 AS PUBLICATION_YEAR
        FROM {orders} WHERE (o_orderkey % 20) % 19 <> 0""",
    "v_region_map": """SELECT n_name AS COUNTRY_NAME, r_name AS REGION FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey <> 3""",
    "v_prev": """SELECT LINEAGE_NAME, SPECIES_NAME, SITE_NAME, REFERENCE_NAME, COUNTRY_NAME, CAST(NUMBER_FOUND AS STRING) AS NUMBER_FOUND, 'c0' AS COMMENT,
        l_orderkey * 10 + l_linenumber AS _row_no FROM {v_hosts} WHERE l_shipdate < TIMESTAMP '1997-01-01 00:00:00'""",
    "v_curr": """SELECT LINEAGE_NAME, SPECIES_NAME, SITE_NAME, REFERENCE_NAME, COUNTRY_NAME, CAST(NUMBER_FOUND AS STRING) AS NUMBER_FOUND,
        CASE WHEN l_partkey % 31 = 0 THEN 'c1' ELSE 'c0' END AS COMMENT, l_orderkey * 10 + l_linenumber AS _row_no FROM {v_hosts} WHERE l_suppkey % 29 <> 0""",
    "v_sequences": """SELECT vec_id, variant, 'V' || vec_id || '_' || variant AS name,
        CASE variant WHEN 0 THEN base WHEN 1 THEN base WHEN 2 THEN repeat('-', 16) || substr(base, 17)
          WHEN 3 THEN substr(base, 1, 9) || CASE substr(base, 10, 1) WHEN 'A' THEN 'C' ELSE 'A' END || substr(base, 11)
          ELSE substr(base, 1, 48) || repeat('-', 16) END AS seq
        FROM (SELECT vec_id, array_to_string(BASES, '') AS base FROM {embeddings}) CROSS JOIN (SELECT 0 AS variant UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4)""",
    "v_chain": """SELECT 'P' || p_partkey AS OLD_NAME, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE 'P' || (p_partkey + 1) END AS NEW_NAME
        FROM {part} WHERE p_partkey % 5 <> 0 OR p_partkey % 50 = 0""",
    "v_ledger": """SELECT user_id AS submission, event_id % 7 AS reviewer, ts AS `at`, event_id AS seq,
        CASE event_type WHEN 'signup' THEN 'received' WHEN 'view' THEN 'in_review' WHEN 'purchase' THEN 'approve' WHEN 'error' THEN 'hold' ELSE 'retract' END AS kind
        FROM {events}""",
    "v_sites": """SELECT s_suppkey, s_nationkey, (s_suppkey * 37 % 1800) / 10.0 - 90 AS lat, (s_suppkey * 53 % 3600) / 10.0 - 180 AS lon FROM {supplier}""",
    "v_lin_prev": """SELECT 'P' || p_partkey AS LINEAGE_NAME, p_brand AS GENUS_NAME, p_name AS SPECIES_NAME, 'A' || p_size AS GENBANK_ACC,
        repeat('ACGT', CAST(p_size % 7 AS INT)) AS SEQUENCE FROM {part} WHERE p_partkey % 37 <> 0
        UNION ALL SELECT 'P' || p_partkey, p_brand, p_name, '', '' FROM {part} WHERE p_partkey % 41 = 0""",
    "v_lin_curr": """SELECT CASE WHEN p_partkey % 43 = 0 THEN 'Q' ELSE 'P' END || p_partkey AS LINEAGE_NAME, CASE WHEN p_partkey % 19 = 0 THEN 'Newgenus' ELSE p_brand END AS GENUS_NAME, p_name AS SPECIES_NAME,
        CASE WHEN p_partkey % 23 = 0 THEN '' ELSE 'A' || p_size END AS GENBANK_ACC, repeat('ACGT', CAST(p_size % 7 + CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END AS INT)) AS SEQUENCE
        FROM {part} WHERE p_partkey % 29 <> 0
        UNION ALL SELECT 'P' || p_partkey, p_brand, p_name, '', '' FROM {part} WHERE p_partkey % 31 = 0""",
    "v_synonyms": """SELECT 'Q' || p_partkey AS LINEAGE_NAME, 'P' || p_partkey || ', alt' || (p_partkey % 50) || ',' AS ALT_NAME, 'R' || (p_size % 20) AS REFERENCE_NAME FROM {part} WHERE p_partkey % 43 = 0
        UNION ALL SELECT 'P' || p_partkey, 'syn' || (p_partkey % 90) || ',syn' || (p_partkey % 7), 'R' || (p_size % 20) FROM {part} WHERE p_partkey % 11 = 0""",
    "v_entries": """SELECT c_custkey AS submission, c_custkey % 5 AS state_no, c_custkey % 13 = 0 AS embargoed, 'P' || (c_custkey % 400) AS name,
        CASE WHEN c_custkey % 6 = 0 THEN 'P' || (c_custkey % 400 + 1000) ELSE '' END AS corrected, c_custkey % 3 AS revision, 'u' || (c_custkey % 11) AS author FROM {customer}""",
    "v_cells": """SELECT p_partkey AS k,
        CASE p_partkey % 5 WHEN 0 THEN '  ' || p_name || ' ' WHEN 1 THEN upper(p_name) WHEN 2 THEN replace(p_name, ' ', '   ') WHEN 3 THEN '' ELSE p_name || ' (Sub) x-y' END AS words,
        CASE p_partkey % 5 WHEN 0 THEN 'Smith et al., ' || (1990 + p_size) WHEN 1 THEN 'Jones & Lee ' || (1990 + p_size) WHEN 2 THEN 'Ellis et. al., unpublished'
          WHEN 3 THEN 'Barrow unpub ' || (p_size % 9) ELSE 'Some Title ' || p_size END AS ref,
        CASE p_partkey % 6 WHEN 0 THEN 'PV' || (100000 + p_partkey) || ', pv' || (100000 + p_size) || ';PV' || (100000 + p_partkey) WHEN 1 THEN 'GCA_' || (100000000 + p_partkey) || '.1'
          WHEN 2 THEN 'PRJNA' || p_partkey WHEN 3 THEN 'SRR' || (1000000 + p_partkey) WHEN 4 THEN 'X' || (10000 + p_partkey % 80000) ELSE 'bad-' || p_partkey END AS acc,
        CASE p_partkey % 6 WHEN 0 THEN 'plasmodium ' || 'huffi' WHEN 1 THEN 'Haemoproteus (Parahaemoproteus) majoris' WHEN 2 THEN 'Leucocytozoon sp.' WHEN 3 THEN 'PLASMODIUM' WHEN 4 THEN 'corvus' ELSE '' END AS genus,
        CASE p_partkey % 7 WHEN 0 THEN p_size || '.0' WHEN 1 THEN ' 1,' || (100 + p_size) WHEN 2 THEN p_size || '/7' WHEN 3 THEN p_size || '.5' WHEN 4 THEN '' ELSE '' || p_size END AS cnt,
        CASE p_partkey % 6 WHEN 0 THEN '-' || (p_partkey % 80) || '.5' WHEN 1 THEN (p_partkey % 80) || '.25 S' WHEN 2 THEN '-' || (p_partkey % 80) || 'W' WHEN 3 THEN (p_partkey % 200) || '' WHEN 4 THEN 'x' || p_partkey ELSE (p_partkey % 80) || ',5N' END AS coord,
        CASE p_partkey % 4 WHEN 0 THEN 'https://doi.org/10.1000/A' || p_partkey WHEN 1 THEN 'DOI:10.1000/b' || p_partkey WHEN 2 THEN '' ELSE ' 10.5/C ' END AS doi,
        repeat('ATGTGACC', 1 + p_size % 5) || CASE p_size % 3 WHEN 0 THEN 'TAA' WHEN 1 THEN 'n-r' ELSE 'TAG' END AS seq, p_size AS n FROM {part}""",
    "v_sheet_records": """SELECT REFERENCE_NAME AS document, l_orderkey || '-' || l_linenumber AS id, CASE WHEN l_partkey % 61 = 0 THEN '' ELSE LINEAGE_NAME END AS LINEAGE_NAME, SPECIES_NAME,
        CASE WHEN l_suppkey % 23 = 0 THEN '' ELSE COUNTRY_NAME END AS COUNTRY_NAME, CASE WHEN l_linenumber = 6 THEN NULL ELSE NUMBER_FOUND END AS NUMBER_FOUND,
        CASE WHEN l_linenumber = 5 THEN NULL ELSE NUMBER_TESTED END AS NUMBER_TESTED, CASE WHEN l_partkey % 31 = 0 THEN 'Gametocytes measured' WHEN l_partkey % 31 = 1 THEN 'none' ELSE '' END AS COMMENT
        FROM {v_hosts} WHERE l_shipdate >= TIMESTAMP '1998-06-01 00:00:00'""",
    "v_sheet_cells": """SELECT k, '' || k AS id, CASE WHEN k % 3 = 0 THEN 'GENSPE' || (10 + k % 50) ELSE 'P' || k END AS name, 'Genus species' AS host, genus, acc,
        CASE WHEN k % 6 = 0 THEN 'PV' || (100000 + k) || '.1' ELSE acc END AS one_acc, CASE WHEN k % 37 = 0 THEN repeat(seq, 20) ELSE seq END AS seq, words, coord, ref, n,
        CASE k % 4 WHEN 0 THEN 'Mitogenome' WHEN 1 THEN 'nuclear_genome' WHEN 2 THEN 'genome' ELSE '' END AS kind, 'D' || (k % 90) AS document,
        CASE WHEN k % 11 = 0 THEN 'position' ELSE 'label' END AS found_by FROM {v_cells}""",
}

#: The one thing that the two dialects spell differently. The oracle takes the bounds as floats, Spark would take the floats as doubles.
_BASES = {
    "spark": "transform(embedding, x -> CASE WHEN x < float(-0.08) THEN 'A' WHEN x < 0 THEN 'C' WHEN x < float(0.08) THEN 'G' ELSE 'T' END)",
    "duck": "list_transform(embedding, lambda x: CASE WHEN x < -0.08 THEN 'A' WHEN x < 0 THEN 'C' WHEN x < 0.08 THEN 'G' ELSE 'T' END)",
}


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"{(\w+)}", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a view of it."""
    if name in VIEWS:
        text = VIEWS[name].replace("BASES", _BASES["spark"]).replace("array_to_string(", "array_join(")
        return spark.sql(text, **{n: table(spark, sf_dir, n) for n in _names(text)})
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def oracle(text: str) -> str:
    """A query text whose ``{view}`` marks stand for views, as one statement for the oracle."""
    needed: dict[str, str] = {}

    def add(part: str) -> None:
        for name in _names(part):
            if name in VIEWS and name not in needed:
                add(VIEWS[name])
                needed[name] = VIEWS[name].replace("BASES", _BASES["duck"]).replace("`", '"').format_map(_Bare())

    add(text)
    body = text.strip().format_map(_Bare())
    head = ", ".join(f"{n} AS ({v})" for n, v in needed.items())
    if not head:
        return body
    found = re.match(r"WITH( RECURSIVE)?\s", body)
    return f"WITH{found[1] or ''} {head}, {body[found.end():]}" if found else f"WITH {head} {body}"


class _Bare(dict):
    def __missing__(self, key: str) -> str:
        return key

"""Scalar functions as queries: each over every row of ``v_cells``, with the oracle's own expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curaspark.functions import sequences as S
from curaspark.functions import text as X
from curaspark.plans import views

def c(name: str) -> Column:
    return F.col(name)


def _list(x: Column) -> Column:
    return F.array_join(x, ";")


_WS = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
_REF = _WS.format("ref")
_BEFORE = f"split_part({_REF}, ' unpub', 1)"
_LAST = f"string_split({_REF}, ' ')[-1]"
_IS_UNPUB = f"contains({_REF}, ' unpub')"
_AUTH = f"CASE WHEN {_IS_UNPUB} THEN replace(rtrim({_BEFORE}, ' ,.'), 'et. al', 'et al') ELSE '' END"
_CANON = f"CASE WHEN {_IS_UNPUB} THEN {_AUTH} || ' unpubl' || CASE WHEN TRY_CAST({_LAST} AS INT) IS NOT NULL THEN ' ' || {_LAST} ELSE '' END ELSE {_REF} END"
_ISKEY = f"coalesce(TRY_CAST({_LAST} AS INT) BETWEEN 1900 AND 2099, false)"
_PUB = f"CASE WHEN {_IS_UNPUB} THEN {_CANON} WHEN {_ISKEY} THEN replace({_REF}, ' al.,', ' al') ELSE {_REF} END"
_GENUS = "CASE WHEN contains(lower({0}), 'leucocytozoon') THEN 'Leucocytozoon' WHEN contains(lower({0}), 'haemoproteus') THEN 'Haemoproteus' WHEN contains(lower({0}), 'plasmodium') THEN 'Plasmodium' END"
_GW = "string_split(trim(regexp_replace(replace(regexp_replace(genus, '\\([^)]*\\)', ' ', 'g'), ',', ' '), '\\s+', ' ', 'g')), ' ')"
_CNT = "replace(trim(cnt), ',', '')"
_LET = "CASE WHEN right(trim(coord), 1) IN ('N', 'S', 'E', 'W') THEN right(trim(coord), 1) ELSE '' END"
_NUM = "TRY_CAST(replace(ltrim(trim(rtrim(trim(coord), 'NSEW')), '-+'), ',', '.') AS DOUBLE)"
_LAT = f"CASE WHEN {_LET} NOT IN ('E', 'W') AND {_NUM} <= 90 THEN CASE WHEN starts_with(trim(coord), '-') <> ({_LET} = 'S') THEN -{_NUM} ELSE {_NUM} END END"
_HEM = "'^(-?)(.*?)\\s*([NSEWnsew])$'"
_CODON = "CASE " + " ".join(f"WHEN x = '{k}' THEN '{v}'" for k, v in S.CODONS.items()) + " ELSE 'X' END"
_AMINO = "coalesce((SELECT string_agg(" + _CODON + ", '' ORDER BY i) FROM (SELECT i, upper(substr(seq, 3 * i + 1, 3)) AS x FROM range(0, length(seq) // 3) t(i))), '')"
_DOI = "regexp_replace(lower(trim(doi)), '^(https?://(dx\\.)?doi\\.org/|doi:\\s*)', '')"

#: name: (columns by name, made once a session exists; the oracle's columns)
SCALARS: dict = {
    "norm_ws": (lambda: {"v": X.norm_ws(c("words"))}, f"{_WS.format('words')} AS v"),
    "norm_text": (lambda: {"v": X.norm_text(c("words"))}, f"nullif({_WS.format('words')}, '') AS v"),
    "lineage_name": (lambda: {"v": X.lineage_name(c("words"))}, "nullif(upper(regexp_replace(words, '\\s+', '', 'g')), '') AS v"),
    "norm_country": (lambda: {"v": X.norm_country(c("words"))}, f"upper({_WS.format('words')}) AS v"),
    "norm_species": (lambda: {"v": X.norm_species(c("words"))}, "upper(array_to_string(list_slice(list_filter(string_split(trim(regexp_replace(regexp_replace(regexp_replace(words, '\\([^)]*\\)', ' ', 'g'), '[^a-zA-Z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda x: x <> ''), -2, -1), ' ')) AS v"),
    "accession_list": (lambda: {"v": _list(X.accession_list(c("acc")))}, "array_to_string(list_filter(list_transform(range(1, len(string_split_regex(upper(acc), '[,;\\s]+')) + 1), lambda i: CASE WHEN list_position(string_split_regex(upper(acc), '[,;\\s]+'), string_split_regex(upper(acc), '[,;\\s]+')[i]) = i THEN string_split_regex(upper(acc), '[,;\\s]+')[i] END), lambda x: x IS NOT NULL AND x <> ''), ';') AS v"),
    "accession_format": (lambda: {"v": X.accession_class(c("acc"))}, "CASE WHEN regexp_matches(acc, '^([A-Z][0-9]{5}|[A-Z]{2}[0-9]{6}|[A-Z]{2}[0-9]{8})(\\.[0-9]+)?$') THEN 'nucleotide' WHEN regexp_matches(acc, '^GC[AF]_[0-9]{9}(\\.[0-9]+)?$') THEN 'assembly' WHEN regexp_matches(acc, '^PRJ[EDN][A-Z][0-9]+$') THEN 'project' WHEN regexp_matches(acc, '^[SED]R[RXSP][0-9]{6,}$') THEN 'reads' END AS v"),
    "clean_sequence": (lambda: {"v": X.clean_sequence(c("seq"))}, "upper(regexp_replace(seq, '[^A-Za-z\\-.~]', '', 'g')) AS v"),
    "clean_genus": (lambda: {"v": X.clean_genus(c("genus"))}, f"{_GENUS.format('genus')} AS v"),
    "parasite_binomial": (lambda: {"v": X.parasite_binomial(c("genus"))}, f"CASE WHEN lower({_GW}[1]) IN ('plasmodium', 'haemoproteus', 'parahaemoproteus', 'leucocytozoon') AND regexp_matches({_GW}[2], '^[a-z][a-z-]{{2,}}$') THEN {_GENUS.format(_GW + '[1]')} || ' ' || {_GW}[2] END AS v"),
    "clean_count": (lambda: {"v": X.clean_count(c("cnt"))}, f"CASE WHEN regexp_matches({_CNT}, '^[0-9]+(\\.0+)?$') THEN CAST({_CNT} AS DOUBLE) END AS v"),
    "split_host": (lambda: {"genus": X.split_host(c("words"))["genus"], "binomial": X.split_host(c("words"))["binomial"]}, f"string_split({_WS.format('words')}, ' ')[1] AS genus, CASE WHEN len(string_split({_WS.format('words')}, ' ')) >= 2 THEN string_split({_WS.format('words')}, ' ')[1] || ' ' || string_split({_WS.format('words')}, ' ')[2] ELSE '' END AS binomial"),
    "host_binomial": (lambda: {"v": X.host_binomial(F.lit("Genus"), c("words"))}, f"CASE WHEN {_WS.format('words')} = '' THEN '' WHEN contains({_WS.format('words')}, ' ') THEN {_WS.format('words')} ELSE 'Genus ' || {_WS.format('words')} END AS v"),
    "signed_coordinate": (lambda: {"v": X.signed_coordinate(c("coord"))}, f"CASE WHEN NOT regexp_matches(trim(coord), {_HEM}) THEN trim(coord) WHEN (regexp_extract(trim(coord), {_HEM}, 1) = '-') <> (upper(regexp_extract(trim(coord), {_HEM}, 3)) IN ('S', 'W')) THEN '-' || trim(regexp_extract(trim(coord), {_HEM}, 2)) ELSE trim(regexp_extract(trim(coord), {_HEM}, 2)) END AS v"),
    "parse_coordinate": (lambda: {"v": X.parse_coordinate(c("coord"), True)}, f"{_LAT} AS v"),
    "parse_coordinate_pair": (lambda: {"lat": X.parse_coordinate_pair(F.concat("coord", F.lit(" , 10.5")))["lat"], "lon": X.parse_coordinate_pair(F.concat("coord", F.lit(" , 10.5")))["lon"]}, f"CASE WHEN len(string_split(coord, ',')) = 1 THEN {_LAT} END AS lat, CASE WHEN len(string_split(coord, ',')) = 1 THEN 10.5 END AS lon"),
    "ref_is_unpublished": (lambda: {"v": X.ref_is_unpublished(c("ref"))}, f"{_IS_UNPUB} AS v"),
    "ref_authors": (lambda: {"v": X.ref_authors(c("ref"))}, f"{_AUTH} AS v"),
    "ref_canonical": (lambda: {"v": X.ref_canonical(c("ref"))}, f"{_CANON} AS v"),
    "ref_is_citation_key": (lambda: {"v": X.ref_is_citation_key(c("ref"))}, f"{_ISKEY} AS v"),
    "ref_published_form": (lambda: {"v": X.ref_published_form(c("ref"))}, f"{_PUB} AS v"),
    "ref_problem": (lambda: {"v": X.ref_problem(c("ref"))}, f"CASE WHEN {_IS_UNPUB} OR {_REF} = '' THEN NULL WHEN contains(lower({_REF}), 'unpub') THEN 'marker out of place' WHEN {_PUB} <> {_REF} THEN 'respelled' END AS v"),
    "citation_key": (lambda: {"v": X.citation_key(F.slice(F.split("words", " +"), F.lit(1), c("k") % 4), F.lit(2020))}, "CASE least(k % 4, len(string_split_regex(words, ' +'))) WHEN 0 THEN '' WHEN 1 THEN string_split_regex(words, ' +')[1] || ' 2020' WHEN 2 THEN string_split_regex(words, ' +')[1] || ' & ' || string_split_regex(words, ' +')[2] || ' 2020' ELSE string_split_regex(words, ' +')[1] || ' et al 2020' END AS v"),
    "normalize_doi": (lambda: {"v": X.normalize_doi(c("doi"))}, f"{_DOI} AS v"),
    "dedup_key": (lambda: {"v": X.dedup_key(c("doi"), c("ref"))}, f"CASE WHEN {_DOI} <> '' THEN 'doi:' || {_DOI} ELSE ref END AS v"),
    "clean_title": (lambda: {"v": X.clean_title(F.concat(F.lit("<i>"), "words", F.lit("</i> &amp; x")))}, f"trim(regexp_replace(words || ' & x', '\\s+', ' ', 'g')) AS v"),
    "normalize_title": (lambda: {"v": X.normalize_title(F.concat("words", F.lit(" &amp; x")))}, "trim(regexp_replace(lower(words || ' & x'), '[^a-z0-9]+', ' ', 'g')) AS v"),
    "title_relevant": (lambda: {"v": X.title_relevant(c("ref"), ["smith", "Title"])}, "contains(lower(ref), 'smith') OR contains(lower(ref), 'title') AS v"),
    "fasta_label": (lambda: {"v": X.fasta_label(F.lit("P"), F.concat(F.lit("L"), "k"), F.when(c("n") > 25, "Gen").otherwise(""), F.lit("epi"))}, "'P_L' || k || CASE WHEN n > 25 THEN '_Gen_epi' ELSE '' END AS v"),
    "lineage_of_label": (lambda: {"v": X.lineage_of_label(F.concat(F.lit(">P_L"), "k", F.lit("_Gen_epi")))}, "'L' || k AS v"),
    "translate4": (lambda: {"v": S.translate4(c("seq"))}, f"{_AMINO} AS v"),
    "count_stops": (lambda: {"v": S.count_stops(c("seq")).cast("long")}, f"CAST(length({_AMINO}) - length(replace({_AMINO}, '*', '')) AS BIGINT) AS v"),
    "reverse_complement": (lambda: {"v": S.reverse_complement(c("seq"))}, "reverse(translate(upper(seq), 'ACGTRYKMBVDHSWN', 'TGCAYRMKVBHDSWN')) AS v"),
    "place_in_window": (lambda: {"v": S.place_in_window(c("seq"), c("n") % 9 - 4, 30)}, "rpad(CASE WHEN n % 9 - 4 >= 0 THEN repeat('N', n % 9 - 4) || seq ELSE substr(seq, 1 - (n % 9 - 4), 30) END, 30, 'N') AS v"),
    "window_span": (lambda: {"first": S.window_span(c("n") % 9 - 4, F.length("seq"), 30)["first"].cast("long"), "last": S.window_span(c("n") % 9 - 4, F.length("seq"), 30)["last"].cast("long")}, "CAST(greatest(n % 9 - 3, 1) AS BIGINT) AS first, CAST(least(n % 9 - 4 + length(seq), 30) AS BIGINT) AS last"),
    "determined_bases": (lambda: {"v": S.determined_bases(c("seq")).cast("long")}, "CAST(length(regexp_replace(upper(seq), '[^ACGT]', '', 'g')) AS BIGINT) AS v"),
    "host_acronyms": (lambda: {"v": _list(X.host_acronyms(c("words")))}, f"CASE WHEN contains({_WS.format('words')}, ' ') THEN upper(substr({_WS.format('words')}, 1, 3) || substr(string_split({_WS.format('words')}, ' ')[2], 1, 3)) || ';' || upper(substr({_WS.format('words')}, 1, 2) || substr(string_split({_WS.format('words')}, ' ')[2], 1, 3)) ELSE '' END AS v"),
    "transmission_class": (lambda: {"v": X.transmission_class(F.when(c("n") % 2 == 0, "Hatch year").otherwise("Adult"), F.when(c("n") % 3 == 0, "Resident").otherwise("Migrant"), F.when(c("n") % 5 == 0, "breeding").otherwise("mixed"))}, "CASE WHEN n % 2 = 0 AND (n % 3 = 0 OR n % 5 = 0) THEN 'local' WHEN n % 3 <> 0 THEN 'elsewhere' ELSE 'undetermined' END AS v"),
    "split_checkbox": (lambda: {"v": _list(X.split_checkbox(c("acc")))}, "array_to_string(list_filter(list_transform(string_split(acc, ','), lambda x: trim(x)), lambda x: x <> ''), ';') AS v"),
    "row_fingerprint": (lambda: {"v": X.row_fingerprint(("doi", c("doi")), ("cnt", c("cnt")))}, "substr(sha256(concat_ws(chr(10), CASE WHEN cnt <> '' THEN 'cnt=' || cnt END, CASE WHEN doi <> '' THEN 'doi=' || doi END)), 1, 16) AS v"),
    "change_capture": (lambda: {"v": F.size(X.change_capture(words=(c("words"), X.norm_ws(c("words"))), doi=(c("doi"), X.normalize_doi(c("doi"))))).cast("long")}, f"CAST((words <> {_WS.format('words')} AND {_WS.format('words')} <> '')::INT + (doi <> {_DOI})::INT AS BIGINT) AS v"),
    "normalize_region": (lambda: {"v": X.normalize_region(F.when(c("n") % 3 == 0, " Hawaii ").when(c("n") % 3 == 1, "North America").otherwise("middle east"))}, "CASE n % 3 WHEN 0 THEN 'HAWAI' WHEN 1 THEN 'NORTH_AMERICA' ELSE 'NORTH_AFRICA_AND_MIDDLE_EAST' END AS v"),
    "lineage_genus_fallback": (lambda: {"v": X.lineage_genus_fallback(F.when(c("k") % 3 == 0, "Plasmodium").otherwise("x"), c("words"))}, f"CASE WHEN k % 3 = 0 THEN 'Plasmodium' ELSE nullif(string_split({_WS.format('words')}, ' ')[1], '') END AS v"),
    "parse_form_timestamp": (lambda: {"v": X.parse_form_timestamp(F.when(c("k") % 3 == 0, "3/9/2026 4:05:06").when(c("k") % 3 == 1, "2026-03-09T04:05:06+02:00").otherwise("soon"), "Etc/GMT-1")}, "CASE k % 3 WHEN 0 THEN TIMESTAMP '2026-03-09 03:05:06' WHEN 1 THEN TIMESTAMP '2026-03-09 02:05:06' END AS v"),
    "name_malformed": (lambda: {"v": X.name_malformed(F.concat(F.when(c("k") % 2 == 0, "CORCOR").otherwise("ZZ"), F.lpad(c("n").cast("string"), 2, "0")), X.host_acronyms(F.lit("Corvus corax")))}, "k % 2 <> 0 AS v"),
    "record_notes": (lambda: {"v": X.record_notes(tube_label=c("doi"), lab_note=c("cnt"))}, "concat_ws('; ', CASE WHEN doi <> '' THEN 'tube label: ' || doi END, CASE WHEN cnt <> '' THEN 'lab note: ' || cnt END) AS v"),
    "sequence_change_text": (lambda: {"v": S.sequence_change_text(F.lit("ACGTACGTAC"), F.when(c("n") % 3 == 0, "ACGTACGTAC").when(c("n") % 3 == 1, "TCGTACGTAG").otherwise("CATGCATGCA"))}, "CASE n % 3 WHEN 0 THEN '' WHEN 1 THEN 'A1T, C10G' ELSE 'A1C, C2A, G3T, T4G, A5C, C6A, G7T, T8G and 2 more' END AS v"),
    "code_matches": (lambda: {"v": S.code_matches(F.lit("RACG"), F.when(c("n") % 2 == 0, "GYYK").otherwise("TACG")).cast("long")}, "CAST(CASE WHEN n % 2 = 0 THEN 3 ELSE 0 END AS BIGINT) AS v"),
    "split_accession_cell": (lambda: {"v": _list(X.split_accession_cell(c("acc")))}, "CASE WHEN k % 6 = 0 THEN 'PV' || (100000 + k) || ';PV' || (100000 + n) || ';PV' || (100000 + k) ELSE '' END AS v"),
    "is_public_id": (lambda: {"v": X.is_public_id(F.when(c("k") % 3 == 0, "sub-0a1b2c3d").when(c("k") % 3 == 1, "sub-7").otherwise(c("doi")))}, "k % 3 = 0 AS v"),
    "public_wording": (lambda: {n: X.public_wording(F.when(c("k") % 4 == 0, "Identical to X (Smith 2005)").when(c("k") % 4 == 1, "wrong base").when(c("k") % 4 == 2, " ").otherwise("seen again"))[n] for n in ("reason", "source")}, "CASE k % 4 WHEN 0 THEN 'The sequence equals another lineage''s.' WHEN 1 THEN 'The entry was corrected.' WHEN 2 THEN '' ELSE 'The entry was revised.' END AS reason, CASE WHEN k % 4 = 0 THEN 'Smith 2005' ELSE '' END AS source"),
    "record_summary": (lambda: {"v": X.record_summary(genus=c("genus"), words=c("words"), count=c("cnt"))}, f"concat_ws(' · ', nullif({_WS.format('genus')}, ''), nullif({_WS.format('words')}, ''), nullif({_WS.format('cnt')}, '')) AS v"),
    "records_are_held": (lambda: {"v": X.records_are_held(F.when(c("k") % 3 == 0, "No").when(c("k") % 3 == 1, "Yes, until").otherwise("perhaps"), F.when(c("n") % 2 == 0, "2026-05-01").otherwise("soon"), F.lit("2026-06-01").cast("date"))}, "CASE k % 3 WHEN 0 THEN false WHEN 1 THEN n % 2 <> 0 ELSE true END AS v"),
    "parse_verdict_row": (lambda: {n: X.parse_verdict_row(F.when(c("k") % 3 == 0, "Approve it").when(c("k") % 3 == 1, "Hold").otherwise("maybe"), F.when(c("n") % 5 == 0, "x").otherwise("17"), F.when(c("n") % 2 == 0, "why").otherwise(""))[n] for n in ("kind", "problem")}, "CASE WHEN n % 5 = 0 OR k % 3 = 2 OR (k % 3 = 1 AND n % 2 <> 0) THEN NULL WHEN k % 3 = 0 THEN 'approve' ELSE 'hold' END AS kind, CASE WHEN n % 5 = 0 THEN 'no such submission' WHEN k % 3 = 2 THEN 'unknown action' WHEN k % 3 = 1 AND n % 2 <> 0 THEN 'an objection needs a text' ELSE '' END AS problem"),
    "mine_empty_values": (lambda: {"v": X.without_empty_words(F.when(c("k") % 4 == 0, " N/A ").when(c("k") % 4 == 1, "-").otherwise(c("cnt")))}, "CASE WHEN k % 4 < 2 THEN NULL ELSE nullif(trim(cnt), '') END AS v"),
    "avian_taxa": (lambda: {"v": X.is_avian_taxon(c("genus"), ("Haemoproteus", "Leucocytozoon"), ("relictum",)) | X.is_avian_taxon(F.concat(F.lit("Plasmodium "), F.when(c("n") % 2 == 0, "relictum").otherwise("vivax")), (), ("relictum",))}, "split_part(genus, ' ', 1) IN ('Haemoproteus', 'Leucocytozoon') OR n % 2 = 0 AS v"),
}


def _query(name: str):
    return lambda spark, sf_dir: views.table(spark, sf_dir, "v_cells").select("k", *[v.alias(n) for n, v in SCALARS[name][0]().items()])


def queries() -> dict:
    return {name: _query(name) for name in SCALARS}


def oracle_sql() -> dict[str, str]:
    return {name: views.oracle("SELECT k, " + sql.replace("{", "{{").replace("}", "}}") + " FROM {v_cells}") for name, (_, sql) in SCALARS.items()}

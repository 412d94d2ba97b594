from pyspark.sql import functions as F

from curaspark.sources import store
from curaspark.spec import SPECS


def test_store_round_trip_and_release(spark, tmp_path):
    spec = SPECS["references"]
    rows = spark.createDataFrame([("REF-000002", "B 2001", "2001", "T, with \"quotes\"", "J", "", "", "seed", "1"), ("REF-000001", "A 2000", "2000", "line\nbreak", "", "", "", "seed", "1")], spec.schema(provenance=True))
    assert not store.store_populated(store.scan_store(spark, str(tmp_path / "none")))
    store.write_store({"references": rows}, str(tmp_path / "s"))
    back = store.scan_store(spark, str(tmp_path / "s"))
    assert store.store_populated(back) and back["lineages"].count() == 0
    assert [r.RECORD_ID for r in back["references"].collect()] == ["REF-000001", "REF-000002"]
    store.write_release({"references": back["references"]}, str(tmp_path / "r"))
    released = store.scan_release(spark, str(tmp_path / "r" / "references"), spec)
    assert store.round_trip(released, back["references"], spec).count() == 0


def test_missing_columns_are_an_error(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("﻿REFERENCE_NAME,OTHER\na,b\n", encoding="utf-8")
    try:
        store.scan_release(spark, str(path), SPECS["references"])
    except ValueError as error:
        assert "PUBLICATION_YEAR" in str(error)
    else:
        raise AssertionError


def test_sequences_and_flat_files(spark, tmp_path):
    fasta = tmp_path / "a.fasta"
    fasta.write_text(">P_L1 text\nacgt\nAC-\n>P_L2\nTT\n")
    assert {(r.name, r.sequence) for r in store.scan_fasta(spark, str(fasta)).collect()} == {("P_L1", "ACGTAC-"), ("P_L2", "TT")}
    flat = tmp_path / "a.gb"
    flat.write_text("LOCUS       AB1 12 bp DNA\nDEFINITION  A long\n            name.\nACCESSION   AB1\nVERSION     AB1.2\n  ORGANISM  Plasmodium x\n  /host=\"Corvus\"\nORIGIN\n        1 acgtac gtacgt\n//\n")
    r = store.scan_genbank(spark, str(flat)).first()
    assert (r.accession, r.version, r.length, r.definition, r.organism, r.host, r.sequence) == ("AB1", "AB1.2", 12, "A long name.", "Plasmodium x", "Corvus", "ACGTACGTACGT")
    out = store.to_fasta(spark.createDataFrame([("L1", "A" * 130), ("L2", "")], "LINEAGE_NAME string, SEQUENCE string")).collect()
    assert [r.value for r in out] == [">P_L1\n" + "A" * 60 + "\n" + "A" * 60 + "\n" + "A" * 10]


def test_polygons_cells_and_feeds(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text('{"features":[{"properties":{"ADMIN":"C"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}},{"properties":{"ADMIN":"D"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}]}')
    assert {r.admin: len(r.rings) for r in store.scan_polygons(spark, str(path)).collect()} == {"C": 1, "D": 2}
    cells = tmp_path / "c.csv"
    cells.write_text("a,b\n1,2\n")
    assert {(r.row, r.column, r.value) for r in store.scan_cells(spark, str(cells)).collect()} == {(0, 0, "a"), (0, 1, "b"), (1, 0, "1"), (1, 1, "2")}
    a = spark.createDataFrame([(1, "x")], "v int, at string")
    assert not store.feed_changed(a, a.withColumn("at", F.lit("y")), "at") and store.feed_changed(a, a.withColumn("v", F.lit(2)), "at")
    assert store.table_payload(a, ["v", "at"]).first().payload == '[["1","x"]]'


def test_cells_of_a_file_cut_anywhere(spark, tmp_path):
    import csv
    import io
    import random

    rng = random.Random(4)
    rows = [[rng.choice(["", "a", 'say "x"', "one,two", "line\nbreak", "é\n\n,\"\"", '"']) for _ in range(rng.randrange(1, 5))] for _ in range(60)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    path = tmp_path / "t.csv"
    path.write_text("\ufeff" + out.getvalue(), encoding="utf-8")
    read = list(csv.reader(io.StringIO(out.getvalue())))
    wanted = {(r, c, v) for r, row in enumerate(read) for c, v in enumerate(row)}
    name = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(name)
    try:
        for size in ("13", "50", "100000"):
            spark.conf.set(name, size)
            got = store.scan_cells(spark, str(path))
            found = {(r.row, r.column, r.value) for r in got.collect()}
            assert found == wanted, (size, sorted(found - wanted)[:3], sorted(wanted - found)[:3])
    finally:
        spark.conf.set(name, was)


def test_flat_files_with_repeated_values(spark, tmp_path):
    flat = tmp_path / "b.gb"
    flat.write_text(
        "LOCUS       AB2 9 bp DNA\nDEFINITION  One\n            two.\nACCESSION   AB2\nVERSION     AB2.1\nDBLINK      BioProject: PRJ1\n            BioSample: SAM2\nKEYWORDS    first; second\n            part.\n"
        "SOURCE      mitochondrion X\n  ORGANISM  Plasmodium y\nREFERENCE   1  (bases 1 to 9)\n  AUTHORS   A,B.\n  TITLE     A long\n            title\n  JOURNAL   J. X\n   PUBMED   123\n"
        "REFERENCE   2\n  TITLE     Direct Submission\nFEATURES             Location/Qualifiers\n     source          1..9\n                     /organism=\"Plasmodium y\"\n                     /organelle=\"mitochondrion\"\n"
        "                     /host=\"Corvus\n                     corax\"\n                     /db_xref=\"taxon:1\"\n                     /db_xref=\"B:2\"\n     CDS             complement(join(1..3,\n                     5..9))\n                     /codon_start=1\nORIGIN\n        1 acgtacgta\n//\n"
    )
    r = store.scan_genbank(spark, str(flat)).first()
    assert (r.definition, r.host, r.organelle, r.strain, r.keywords, r.dblink) == ("One two.", "Corvus corax", "mitochondrion", "", ["first", "second part"], {"BioProject": "PRJ1", "BioSample": "SAM2"})
    assert [tuple(x) for x in r.references] == [("A long title", "J. X", "123"), ("Direct Submission", "", "")]
    assert [tuple(x) for x in r.features] == [("source", "1..9"), ("CDS", "complement(join(1..3,5..9))")]
    assert [q.value for q in r.qualifiers if q.key == "db_xref"] == ["taxon:1", "B:2"] and ("codon_start", "1") in [tuple(q) for q in r.qualifiers]

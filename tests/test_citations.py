"""pooled_compilation counts author and year, not numbers or keys that begin like a year."""

from curaspark.operators import cells

TEXTS = {
    "We compiled data (Smith et al., 2005), Jones 1999; Lee, 2014a.": 3,
    "Les 2014555512345678 and Les 20145": 0,
    "Key 2046a7d8 and Key 2046_1": 0,
    "Release 2014.5.1": 0,
    "Doe 2014. Doe 2015.": 2,
    "Doe 2014": 1,
}


def test_years_stand_by_themselves(spark):
    lines = spark.createDataFrame(list(enumerate(TEXTS)), "doc long, text string")
    assert {r.doc: r.citations for r in cells.pooled_compilation(lines, ["compiled"]).collect()} == dict(enumerate(TEXTS.values()))

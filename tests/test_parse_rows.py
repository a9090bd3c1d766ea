import pytest

from fieldlark.operators.parse_rows import OCCURRENCE, Contract, Field, broken_rows, check_lines, valid_rows

GOOD = ["1", "o", "d", "B", "7", "n", "SPECIES", "XA", "1.5", "-2e1", "2020-02-29", "here"]


def line(**changes):
    names = [f.name for f in OCCURRENCE.fields]
    return "\t".join(changes.get(n, v) for n, v in zip(names, GOOD, strict=True))


CASES = [
    (line(), []),
    (None, ["line:null"]),
    ("", ["line:field_count"]),
    (line() + "\tx", ["line:field_count"]),
    (line(locality='"a\tb\nc"'), []),
    (line(locality='"say ""hi"""'), []),
    (line(locality='say "hi"'), ["line:quoting"]),
    (line(locality='"open'), ["line:quoting"]),
    (line(locality='"a"b'), ["line:quoting"]),
    (line(gbifID='"12"'), []),
    (line(gbifID=" 12 "), []),
    (line(gbifID="NA"), ["gbifID:missing"]),
    (line(gbifID="0"), ["gbifID:not_positive"]),
    (line(gbifID="1" * 19), ["gbifID:not_digits"]),
    (line(gbifID="١٢"), ["gbifID:not_digits"]),
    (line(acceptedTaxonKey="1.0"), ["acceptedTaxonKey:not_digits"]),
    (line(acceptedTaxonKey=""), []),
    (line(countryCode="xa"), ["countryCode:pattern"]),
    (line(decimalLatitude="90.1"), ["decimalLatitude:out_of_range"]),
    (line(decimalLatitude="NaN"), ["decimalLatitude:not_a_number"]),
    (line(decimalLatitude="1d"), ["decimalLatitude:not_a_number"]),
    (line(decimalLongitude="1e999"), ["decimalLongitude:out_of_range"]),
    (line(eventDate="2021-02-29"), ["eventDate:not_a_date"]),
    (line(eventDate="2020-01-02T23:59Z"), []),
    (line(eventDate="2020-01-02T24:00"), ["eventDate:not_a_date"]),
    (line(eventDate="2020-01-02/2020-01-01"), ["eventDate:reversed"]),
    (line(eventDate="2020-01-02/2020-01-02T10:00:00"), []),
    (line(eventDate="2020-01-02/"), ["eventDate:not_a_date"]),
    (line(eventDate="2020-01-01/2020-01-02/2020-01-03"), ["eventDate:not_a_date"]),
    (line(eventDate="n/a"), []),
    (line(gbifID="x", countryCode="?"), ["gbifID:not_digits", "countryCode:pattern"]),
    ('"' + "a" * 300_000 + '""' * 50_000 + '"' + "\t" * 11, ["gbifID:not_digits"]),
    ("\t" * 100_000, ["line:field_count"]),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, raw string")
    got = {r["id"]: r["errors"] for r in check_lines(df, "raw").collect()}
    assert got == {i: c[1] for i, c in enumerate(CASES)}


def test_sides_are_whole_and_apart(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)] * 2, "id int, raw string")
    good, bad = valid_rows(df, "raw"), broken_rows(df, "raw")
    assert good.count() + bad.count() == 2 * len(CASES)
    row = good.where("id = 0").first()
    assert (row["gbifID"], row["decimalLongitude"], str(row["eventDate_first"])) == (1, -20.0, "2020-02-29")
    assert bad.columns == ["id", "raw", "errors"]


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(line(), "mine", "old")], "raw string, gbifID string, errors string")
    assert valid_rows(df, "raw").first()["gbifID"] == 1
    assert valid_rows(df.limit(0), "raw").count() == 0 == broken_rows(df.limit(0), "raw").count()


@pytest.mark.parametrize("sep", [",", "|"])
def test_other_contract(spark, sep):
    c = Contract((Field("a", "digits", required=True), Field("b", "pattern", pattern=r"\A[a-z]+\z")), separator=sep)
    df = spark.createDataFrame([(f"1{sep}x",), (f'"1"{sep}"x"',), (f"{sep}X",)], "raw string")
    assert [r["errors"] for r in check_lines(df, "raw", c).collect()] == [[], [], ["a:missing", "b:pattern"]]

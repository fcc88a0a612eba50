import pytest

from latemark.sources import malformed_entries, quarantined_legs, read_legs

TYPES = {"year": "int", "origin": "bigint", "delay": "double", "carrier": "string"}


@pytest.fixture()
def files(tmp_path):
    (tmp_path / "a.csv").write_text(
        "Carrier,YEAR,delay,origin,extra\n"
        "AA,2020,1.5,7,x\n"
        "BB,2020.0,NA,8,x\n"
        "CC,last,,9,x\n"
        "DD,2020.5,abc,10,x\n"
        "\"E,E\",2021,3,11,x\n"
    )
    (tmp_path / "b.csv").write_text(
        "Carrier,YEAR,delay,origin,extra\n"
        "FF,2022\n"
        "GG,2022,1,12,x,more\n"
        "HH, 2023 ,-4e1,99999999999,x\n"
        "\"I,I\",bad,1,13,x\n"
    )
    return str(tmp_path)


def test_rows_are_set_apart_with_file_line_and_reason(spark, files):
    told = quarantined_legs(spark, files, types=TYPES)
    assert told.accepted.columns == list(TYPES)
    accepted = {r["carrier"]: (r["year"], r["delay"], r["origin"]) for r in told.accepted.collect()}
    assert accepted == {
        "AA": (2020, 1.5, 7), "BB": (2020, None, 8), "E,E": (2021, 3.0, 11), "HH": (2023, -40.0, 99999999999),
    }
    rejected = {r["carrier"]: r for r in told.rejected.collect()}
    reasons = {c: [tuple(m) for m in r["misfits"]] for c, r in rejected.items()}
    assert reasons == {
        "CC": [("year", "last")], "DD": [("year", "2020.5"), ("delay", "abc")], "FF": [("*", "FF,2022")],
        "GG": [("*", "GG,2022,1,12,x,more")], "I,I": [("year", "bad")],
    }
    assert rejected["CC"]["line"] == "CC,last,NA,9,x" and rejected["I,I"]["line"] == '"I,I",bad,1,13,x'
    assert rejected["GG"]["line"] == "GG,2022,1,12,x,more"
    assert rejected["DD"]["year"] is None and rejected["DD"]["origin"] == 10
    assert rejected["CC"]["file"].endswith("a.csv") and rejected["FF"]["file"].endswith("b.csv")


def test_counts_agree_with_the_counting_scan(spark, files):
    told = quarantined_legs(spark, files, types=TYPES)
    counted = {}
    for r in told.counts().collect():
        counted[r["column"]] = counted.get(r["column"], 0) + r["rows"]
    scanned = {r["column"]: r["malformed"] for r in malformed_entries(spark, files, types=TYPES).collect()}
    assert {c: n for c, n in counted.items() if c != "*"} == {c: n for c, n in scanned.items() if n}
    assert counted["*"] == 2


def test_only_asked_for_columns_are_judged(spark, files):
    told = quarantined_legs(spark, files, ["origin", "carrier"], TYPES)
    assert told.accepted.columns == ["origin", "carrier"]
    assert sorted(r["carrier"] for r in told.rejected.collect()) == ["FF", "GG"]


def test_accepted_rows_are_those_that_read_legs_types(spark, files):
    whole = read_legs(spark, files, types=TYPES)
    told = quarantined_legs(spark, files, types=TYPES)
    assert told.accepted.exceptAll(whole.select(*told.accepted.columns)).isEmpty()
    assert told.accepted.count() + told.rejected.count() == whole.count()


def test_files_are_scanned_once_and_never_again(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("Carrier,YEAR,delay,origin\nAA,2020,1,1\nBB,x,1,1\n")
    told = quarantined_legs(spark, str(path), types=TYPES)
    path.unlink()
    assert (told.accepted.count(), told.rejected.count()) == (1, 1)
    told.discard(spark)


def test_missing_columns_and_no_rows(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("Carrier,YEAR\n")
    told = quarantined_legs(spark, str(path), types=TYPES)
    assert told.accepted.isEmpty() and told.rejected.isEmpty() and told.counts().isEmpty()
    with pytest.raises(ValueError, match="columns missing"):
        quarantined_legs(spark, str(path), types=TYPES, strict=True)

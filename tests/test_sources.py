"""CSV input that does not fit: ragged lines and headers that differ."""

import gzip

import pytest

from sluice.plans import runs
from sluice.plans.schemas import ADMISSIONS_HEADERS, ADMISSIONS_SOURCE
from sluice.sources.csv import (
    MISFIT_COLUMN,
    file_headers,
    fitting_rows,
    misfit_lines,
    read_checked_csv,
    read_csv_by_name,
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_line_is_a_row_or_a_misfit(spark, tmp_path):
    lines = ["1,2,3", "4,5", "6,7,8,9", '"a,b",c,d', '"x ""y""",,', "", '"open,q,r', ",,", "1,\"2\",3,", "é,ü,ß", '"a"b,c,d']
    (tmp_path / "f.csv").write_text("\n".join(["a,b,c", *lines]) + "\n", encoding="utf-8")
    checked = read_checked_csv(spark, str(tmp_path), ["a", "b", "c"])
    good, bad = rows(fitting_rows(checked)), rows(misfit_lines(checked).drop("file"))
    assert bad == sorted([
        ("4,5", 2, "short"), ("6,7,8,9", 4, "long"), ('"open,q,r', None, "unclosed quote"), ('1,"2",3,', 4, "long"),
    ], key=repr)
    assert len(good) + len(bad) == len([x for x in lines if x])  # empty lines are no rows
    assert ("1", "2", "3") in good and ("a,b", "c", "d") in good and ('x "y"', None, None) in good and ("é", "ü", "ß") in good
    assert misfit_lines(checked).select("file").distinct().count() == 1
    # Counting or selecting few columns finds the same misfits.
    assert fitting_rows(checked).select("b").count() == len(good) and fitting_rows(checked).count() == len(good)
    assert checked.where(f"{MISFIT_COLUMN} IS NOT NULL").select("a", MISFIT_COLUMN).count() == len(bad)


def test_only_misfits_and_no_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1\n", encoding="utf-8")
    (tmp_path / "g.csv").write_text("a,b\n", encoding="utf-8")
    checked = read_checked_csv(spark, str(tmp_path), ["a", "b"])
    assert rows(fitting_rows(checked)) == [] and rows(misfit_lines(checked).select("line")) == [("1",)]


def test_another_separator(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a|b\n"x|y"|2\n1|2|3\n', encoding="utf-8")
    checked = read_checked_csv(spark, str(tmp_path), ["a", "b"], sep="|")
    assert rows(fitting_rows(checked)) == [("x|y", "2")]
    assert rows(misfit_lines(checked, "|").drop("file")) == [("1|2|3", 3, "long")]


@pytest.fixture
def drifted(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("﻿id,name,city\n1,Ann,Rome\n2,\"B,o\",\n", encoding="utf-8")
    (folder / "b b.csv").write_text("city,id,name\nOslo,3,Cy\n", encoding="utf-8")
    (folder / "c.csv").write_text('id,"the ""new"", one",name\n4,x,Di\n', encoding="utf-8")
    with gzip.open(folder / "d.csv.gz", "wt", encoding="utf-8") as out:
        out.write("id,name,city\n5,Ed,Bern\n")
    (folder / "empty.csv").write_text("", encoding="utf-8")
    return str(folder)


def test_files_are_read_by_name(spark, drifted):
    headers = file_headers(spark, drifted)
    assert {k: len(v) for k, v in headers.items()} == {
        ("id", "name", "city"): 2, ("city", "id", "name"): 1, ("id", 'the "new", one', "name"): 1}
    out = read_csv_by_name(spark, drifted)
    assert set(out.columns) == {"id", "name", "city", 'the "new", one'}
    got = rows(out.select("id", "name", "city", '`the "new", one`'))
    assert got == [("1", "Ann", "Rome", None), ("2", "B,o", None, None), ("3", "Cy", "Oslo", None),
                   ("4", "Di", None, "x"), ("5", "Ed", "Bern", None)]
    some = read_csv_by_name(spark, drifted, ["name", "nowhere", "id"])
    assert some.columns == ["name", "nowhere", "id"] and some.where("nowhere IS NULL").count() == 5


def test_required_and_repeated_names(spark, drifted, tmp_path):
    assert read_csv_by_name(spark, drifted, required=["id", "name"]).count() == 5
    with pytest.raises(ValueError, match="city"):
        read_csv_by_name(spark, drifted, required=["city"])
    (tmp_path / "twice.csv").write_text("a,a\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="repeats"):
        read_csv_by_name(spark, str(tmp_path / "twice.csv"))


def test_misfits_of_drifted_files(spark, drifted, tmp_path):
    with open(f"{drifted}/b b.csv", "a", encoding="utf-8") as out:
        out.write("Bonn,6\n")
    got = read_csv_by_name(spark, drifted, misfit_col="bad")
    assert rows(got.where("bad IS NOT NULL").select("bad")) == [("Bonn,6",)] and got.count() == 6


HEADER = [ADMISSIONS_HEADERS[c] for c in ADMISSIONS_SOURCE]
ROW = "Ann,40,Female,A+,Asthma,01-02-2023,Dr A,Clinic,Acme,100.00,101,Urgent,03-02-2023,Aspirin,Normal"


def test_a_run_keeps_misfits_apart(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([",".join(HEADER), ROW, ROW + ",more", "Bo,20"]) + "\n", encoding="utf-8")
    out = runs.run_admissions(spark, str(folder), str(tmp_path / "run"), "20230401120000000", quarantine=True)
    assert out.rows.count() == 1 and out.counts["misfits"] == 2 and out.counts["read"] == 1
    assert rows(spark.read.parquet(out.quarantine).select("line", "reason")) == [("Ann" + ROW[3:] + ",more", "long"), ("Bo,20", "short")]
    (folder / "a.csv").write_text(",".join(HEADER) + "\n" + ROW + "\n", encoding="utf-8")
    clean = runs.run_admissions(spark, str(folder), str(tmp_path / "run2"), "20230401120000000", quarantine=True)
    assert clean.quarantine is None and clean.counts["misfits"] == 0 and not (tmp_path / "run2" / "quarantine").exists()


def test_a_run_reads_files_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(",".join(HEADER) + "\n" + ROW + "\n", encoding="utf-8")
    back = ",".join(reversed(ROW.replace("Ann", "Bo").split(",")))
    (folder / "b.csv").write_text(",".join(reversed(HEADER)) + "\n" + back + "\n", encoding="utf-8")
    out = runs.run_admissions(spark, str(folder), str(tmp_path / "run"), "20230401120000000", by_name=True)
    assert rows(out.rows.select("Name", "Age")) == [("Ann", 40), ("Bo", 40)]

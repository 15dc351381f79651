"""Files of any layout."""

import datetime as dt
import gzip

import pytest

from epipanel.sources.uniform import load_observations, load_uniform, read_headers, resolve_header


def test_every_file_by_its_own_header(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.csv").write_text("SNo,ObservationDate,Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered\n1,01/22/2020,Washington,US,x,1.0,0.0,0.0\n")
    (tmp_path / "b.csv").write_text("﻿Country_Region,CONFIRMED,Province_State,Deaths,Date\nJapan,5,,1,1/23/20\n\"Korea, South\",x,,2,never\n")
    with gzip.open(tmp_path / "deep" / "c.csv.gz", "wt") as file:
        file.write("observation date,country,state,recovered\n1/24/2020,France,Corse,7\n")
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / ".hidden.csv").write_text("nothing")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only_header.csv").write_text("Country,Date\n")
    out = load_observations(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in out.schema] == ["date", "string", "string", "bigint", "bigint", "bigint"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [
            (dt.date(2020, 1, 22), "Washington", "US", 1, 0, 0),
            (dt.date(2020, 1, 23), None, "Japan", 5, 1, None),
            (None, None, "Korea, South", None, 2, None),
            (dt.date(2020, 1, 24), "Corse", "France", None, None, 7),
        ],
        key=str,
    )
    assert len(read_headers(spark, str(tmp_path))) == 4


def test_wide_files_of_other_dates(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Province/State,Country/Region,Lat,Long,1/22/20,1/23/20\n,Peru,-9.5,x,5,7.0\n")
    (tmp_path / "b.csv").write_text("1/24/20,Long_,Country_Region,1/23/20\n9,2.5,Peru,8\n")
    out = load_uniform(spark, str(tmp_path / "*.csv"))
    assert out.columns == ["state", "country", "lat", "lon", "1/22/20", "1/23/20", "1/24/20"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, "Peru", -9.5, None, 5, 7, None), (None, "Peru", None, 2.5, None, 8, 9)], key=str)


def test_two_columns_for_one(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Country,Country/Region\nx,y\n")
    with pytest.raises(ValueError, match="country"):
        load_uniform(spark, str(tmp_path))
    with pytest.raises(ValueError):
        resolve_header(["1/2/20", "01/02/2020"])
    assert resolve_header(["", "Incident Rate", "Admin2"]) == [None, None, "county"]


def test_no_files(spark, tmp_path):
    with pytest.raises(ValueError):
        load_uniform(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        load_uniform(spark, str(tmp_path / "none*.csv"))

"""Files whose columns differ are set aside by name and reason; the others are read."""

import os
import uuid

import pytest

from stridebase.schema import BRONZE_SCHEMA, RAW_SCHEMA
from stridebase.sources.drift import differences, inspect, read_fitting_races
from stridebase.sources.races_csv import write_races_csv
from tests.test_warehouse import raw, same_rows

HEADER = ",".join(RAW_SCHEMA.names)
LINE = "2001,01.01.2001,Test 50,50km,10,4:51:39 h,,SWE,1978.0,M,M23,10.2 km/h,7"


@pytest.mark.parametrize(
    "start, found",
    [
        (f"{HEADER}\n{LINE}\n", []),
        (f"{HEADER}\n", []),
        (HEADER, []),
        ("", [("empty", "")]),
        ("\n\n", [("empty", "")]),
        (HEADER.replace("Athlete club", "Club"), [("missing", "Athlete club"), ("unknown", "Club")]),
        (HEADER.replace(",Athlete gender", ""), [("missing", "Athlete gender")]),
        (HEADER + ",Extra", [("unknown", "Extra")]),
        (HEADER + ",Athlete ID", [("repeated", "Athlete ID")]),
        (HEADER.replace("Event dates,Event name", "Event name,Event dates"), [("order", "Event dates")]),
        ("\n".join([HEADER, *[LINE.replace("2001,", "May,", 1)] * 5, LINE]), [("type", "Year of event")]),
        ("\n".join([HEADER, LINE.replace("2001,", "May,", 1), LINE, LINE, LINE]), []),
        (f'{HEADER}\n"2001","a, ""b""\n c",{LINE[16:]}\n{LINE}\n{LINE[:9]}', []),
    ],
)
def test_differences(start, found):
    assert [(d.reason, d.column_name) for d in differences("f", start)] == found


def test_a_folder_with_a_renamed_and_a_missing_column(spark, warehouse, shared):
    folder = f"{shared}/{uuid.uuid4().hex}"
    rows = raw(spark, {"athlete_id": 1}, {"athlete_id": 2, "event_name": 'Quoted, "so"'})
    write_races_csv(rows.coalesce(1), folder)
    for name, header in (("renamed.csv", HEADER.replace("Athlete club", "Club")), ("missing.csv", HEADER.replace(",Athlete gender", ""))):
        with open(f"{folder}/{name}", "w") as out:
            out.write(f"{header}\n{LINE}\n")
    with open(f"{folder}/_note", "w") as out:
        out.write("no data")
    got, apart = read_fitting_races(spark, folder)
    assert got.schema == BRONZE_SCHEMA and same_rows(got, rows)
    listed = {(os.path.basename(r["file"]), r["reason"], r["column_name"]) for r in apart.collect()}
    assert listed == {("renamed.csv", "missing", "Athlete club"), ("renamed.csv", "unknown", "Club"), ("missing.csv", "missing", "Athlete gender")}


def test_folders_without_files_that_fit(spark, shared):
    for folder in (f"{shared}/{uuid.uuid4().hex}", f"{shared}/{uuid.uuid4().hex}"):
        assert inspect(spark, folder) == ([], [])
        os.makedirs(folder)
        with open(f"{folder}/a.csv", "w") as out:
            out.write("a,b\n1,2\n")
        rows, apart = read_fitting_races(spark, folder)
        assert rows.schema == BRONZE_SCHEMA and rows.collect() == [] and apart.count() == len(RAW_SCHEMA.names) + 2

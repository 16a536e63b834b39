"""Landed lines that cannot be read stay in the balance, with their text."""

import json

from landing import event

from meterlake import catalog
from meterlake.catalog import MASTERS
from meterlake.plans.masters import bronze_master, classify_master, landed_master
from meterlake.plans.pipeline import Lake

USERS = """user_id,org_id,email,role,active,created_at,last_login
u1,o1,a@x,admin,True,2025-01-01,
garbage
u2,o1
,,,,,,
u3,o1,b@x,user,false,2025-01-01,2025-01-02,extra,columns
"""


def test_csv_lines(spark, tmp_path, rows):
    path = tmp_path / "users.csv"
    path.write_text(USERS)
    users = MASTERS["users"]
    bronze = bronze_master(landed_master(spark, users, str(path)), users)
    assert bronze.schema.names == users.bronze.names
    judged = classify_master(bronze, users)
    assert rows(judged, "user_id", "org_id", "error_reason", "unreadable") == [
        ("garbage", None, catalog.UNREADABLE_LINE, "garbage"),
        ("u1", "o1", None, None),
        ("u2", "o1", None, None),
        ("u3", "o1", None, None),
        (None, None, catalog.NULL_KEY, None),
    ]


def test_a_good_row_of_the_key_wins_over_a_cut_line(spark, tmp_path, rows):
    path = tmp_path / "users.csv"
    path.write_text(USERS + "u1\n")
    users = MASTERS["users"]
    bronze = bronze_master(landed_master(spark, users, str(path)), users)
    assert rows(bronze.where("user_id = 'u1'"), "org_id", "unreadable") == [("o1", None)]


def test_json_lines_reach_quarantine_with_their_text(spark, tmp_path, rows):
    landing = tmp_path / "landing" / "usage_events_stream"
    landing.mkdir(parents=True)
    bad = ['{"event_id": "e9", "timest', "not json", "[1, 2]", '"text"']
    good = [json.dumps(event("e1")), json.dumps(event(None)), json.dumps({**event("e2"), "cost_usd_increment": "many"}), ""]
    (landing / "a.jsonl").write_text("\n".join([*bad, *good]) + "\n")
    lake = Lake(spark, str(tmp_path))
    done = lake.ingest_events()
    assert (done.input_rows, done.bronze_rows, done.unnamed_rows) == (7, 7, 5)
    found = rows(lake.bronze_events(), "event_id", "unreadable")
    assert found == sorted([("e1", None), ("e2", None), (None, None), *[(None, b) for b in bad]], key=repr)

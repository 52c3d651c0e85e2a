"""The shipped report on the FIXTURES section-1 edge rows, against rows stated by hand."""

import datetime as dt

from kpiloom.plans.report import inspection_feedback_report

T = dt.datetime

LOG = [  # appointment_id, inspection_by, version, inspection_status, inspection_end_time, store_id
    ("a1", "Alice@X.com", 0, "done", T(2026, 4, 1, 0, 0, 0), 1),
    ("a1", "Alice@X.com", 0, "done", T(2026, 4, 1, 0, 0, 0), 1),          # duplicate -> DISTINCT
    ("a2", " bob ", 0, "done", T(2026, 4, 30, 23, 59, 59), 2),             # padding, last instant of month
    ("a3", "\tCAROL", 0, "done", T(2026, 4, 15, 12, 0, 0), 99),            # store without centre
    ("a4", None, 0, "done", T(2026, 4, 10, 9, 0, 0), 1),                   # null inspector
    ("a5", "dave", 1, "done", T(2026, 4, 10, 9, 0, 0), 1),                 # version 1 -> out
    ("a6", "erin", 0, "cancelled", T(2026, 4, 10, 9, 0, 0), 1),            # not done -> out
    ("a7", "fred", 0, "done", T(2026, 5, 1, 0, 0, 0), 1),                  # outside the month
    ("a8", "gina", 0, "done", T(2026, 3, 31, 23, 59, 59), 1),              # outside the month
]
CENTRES = [(1, "North", "Delhi", "C1"), (2, "South", "Chennai", "C2")]
FEEDBACK = [  # appointment_id, feedback_rating, created_at, feedbacks, additional_comment
    ("a1", 5, T(2026, 4, 2, 10, 0), "great", None),
    ("a1", 4, T(2026, 4, 2, 10, 0), "good", "tie on latest"),              # tie -> both kept
    ("a1", 3, T(2026, 4, 1, 10, 0), "old", None),
    ("a1", None, T(2026, 4, 3, 10, 0), "later but no rating", None),       # ignored
    ("a2", 2, T(2026, 5, 2, 10, 0), "late feedback", None),
    ("zz", 1, T(2026, 4, 2, 10, 0), "other appointment", None),
]
STORES = [("a1", "Franchise", True, "S1"), ("a2", "Own", False, "S2"), ("a9", "Own", True, "S9")]

# What the report must hold: appointment, inspector, region, rating, comment, store.
EXPECTED = [
    ("a1", "Alice@X.com", "North", 5, None, "S1"),                          # both latest ratings of a1
    ("a1", "Alice@X.com", "North", 4, "tie on latest", "S1"),
    ("a2", " bob ", "South", 2, None, "S2"),
    ("a3", "\tCAROL", None, None, None, None),                             # no centre, no feedback, no store
    ("a4", None, "North", None, None, None),
]


def test_shipped_report_on_edge_rows(spark):
    schemas = {
        "inspection_log": "appointment_id string, inspection_by string, version int, inspection_status string, "
                          "inspection_end_time timestamp_ntz, store_id long",
        "centre_list": "centre_id long, region string, city string, centre string",
        "feedback": "appointment_id string, feedback_rating int, created_at timestamp_ntz, feedbacks string, "
                    "additional_comment string",
        "appt_latest_info": "pub_appt_id string, `Store Type` string, verified boolean, store_name string",
    }
    data = {"inspection_log": LOG, "centre_list": CENTRES, "feedback": FEEDBACK, "appt_latest_info": STORES}
    frames = {k: spark.createDataFrame(v, schemas[k]) for k, v in data.items()}
    out = inspection_feedback_report(frames["inspection_log"], frames["centre_list"], frames["feedback"],
                                     frames["appt_latest_info"], "2026-04-01", "2026-04-30")
    rows = out.collect()
    got = [(r.appointment_id, r.inspection_by, r.region, r.feedback_rating, r.additional_comment, r.store_name) for r in rows]
    assert sorted(got, key=str) == sorted(EXPECTED, key=str)
    ids = sorted(r.appointment_id for r in rows)
    assert ids == ["a1", "a1", "a2", "a3", "a4"]                   # tie fans out, filters applied
    a3 = [r for r in rows if r.appointment_id == "a3"][0]
    assert a3.region is None and a3.feedback_rating is None        # no centre, no feedback

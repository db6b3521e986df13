"""A12 worst status, P6, F1, F2, P10, P11, P15, A7 and the D6/D10 edge rows."""

from pyspark.sql import functions as F

from detour import schemas as S
from detour.operators import status as st


def _lines(spark, rows):
    return spark.createDataFrame(rows, S.RAW_LINE)


def _events(spark, rows):
    return st.events_from_documents(_lines(spark, rows), F.lit("2024-01-01T00:00:00+00:00"))


def _status(sev, desc=None, detail=None):
    return (sev, desc, None if detail is None else (detail,))


def test_worst_is_lowest_severity(spark):
    ev = _events(spark, [("central", "Central", [_status(9, "Minor"), _status(6, "Severe", "signal")])]).collect()
    assert len(ev) == 1
    e = ev[0]
    assert (e.severity_code, e.severity_desc, e.is_disrupted, e.disruption_detail) == (6, "Severe", True, "signal")
    assert e.event_type == "tube_line_status"


def test_tie_takes_first_in_list(spark):
    e = _events(spark, [("x", "X", [_status(5, "first"), _status(5, "second")])]).first()
    assert e.severity_desc == "first"


def test_missing_severity_sorts_99_reports_10(spark):
    # only status without severity -> reported 10, not disrupted
    e = _events(spark, [("x", "X", [_status(None, "weird")])]).first()
    assert (e.severity_code, e.is_disrupted) == (10, False)
    # with another status of 20 the missing one (rank 99) still loses
    e = _events(spark, [("x", "X", [_status(None, "a"), _status(20, "b")])]).first()
    assert (e.severity_code, e.severity_desc) == (20, "b")


def test_threshold_is_strict(spark):
    e = _events(spark, [("x", "X", [_status(10, "Good Service")])]).first()
    assert e.is_disrupted is False
    e = _events(spark, [("x", "X", [_status(9, "Minor")])]).first()
    assert e.is_disrupted is True


def test_empty_or_missing_list_dropped(spark):
    assert _events(spark, [("a", "A", []), ("b", "B", None)]).count() == 0


def test_defaults_for_missing_keys(spark):
    e = _events(spark, [(None, None, [_status(3, None)])]).first()
    assert (e.line_id, e.line_name, e.severity_desc) == ("unknown", "Unknown Line", "Unknown")


def test_null_disruption_gives_null_detail(spark):
    e = _events(spark, [("x", "X", [_status(2, "Closed", None)])]).first()
    assert e.disruption_detail is None


def test_row_form_equals_document_form(spark):
    rows = spark.createDataFrame(
        [("l1", 1, 9, "a", "d1"), ("l1", 2, 6, "b", None), ("l1", 3, 6, "c", None),
         ("l2", 4, None, "n", None), ("l3", 5, None, "n", None), ("l3", 6, 12, "m", None)],
        "line string, pos int, sev int, descr string, detail string")
    w = st.worst_status_rows(rows, ["line"], "pos", "sev", "descr", "detail")
    got = {r.line: (r.worst_pos, r.severity, r.n_statuses) for r in w.collect()}
    assert got == {"l1": (2, 6, 3), "l2": (4, None, 1), "l3": (6, 12, 2)}
    ev = st.events_from_worst(w, F.col("line"), F.col("line"), F.lit("t"))
    assert {r.line_id: r.severity_code for r in ev.collect()} == {"l1": 6, "l2": 10, "l3": 12}


def test_split_and_poll_counts(spark):
    ev = _events(spark, [("a", "A", [_status(10)]), ("b", "B", [_status(3)]), ("c", "C", [_status(9)])])
    ok, bad = st.split_by_disruption(ev)
    assert (ok.count(), bad.count()) == (1, 2)
    r = st.poll_counts(ev).first()
    assert (r.n_lines, r.n_ok, r.n_disrupted) == (3, 1, 2)


def test_events_have_the_event_contract(spark):
    """FIXTURES A2: the event columns and types of the broker contract."""
    ev = _events(spark, [("central", "Central", [_status(6, "Severe", "x")])])
    assert ev.schema.simpleString() == S.STATUS_EVENT.simpleString()

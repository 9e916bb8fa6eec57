"""Risk scoring: decoders D1-D8, filters P5/P6, join J1, queries Q1-Q3."""

import datetime as dt
import json

from helpers import env_rows, rows, sorted_set

from tributary import schemas as S
from tributary.plans import risk as R

# Golden rows from the recorded console runs (addresses not cut by the console).
GOLDEN = [  # (customer, score, riskDate, birthYear)
    ("John.Anandh@test.com", 17.0, "2022-01-07", "1965"),
    ("Jason.Smith@test.com", 1.0, "2022-01-07", "1963"),
    ("Frank.Doshi@test.com", -26.0, "2022-01-07", "1962"),
    ("Sean.Anandh@test.com", -4.5, "2022-01-07", "1959"),
    ("Craig.Jones@test.com", -1.5, "2022-01-07", "1957"),
    ("David.Jones@test.com", -15.0, "2022-01-07", "1941"),
]


def _events(spark, items):
    return env_rows(spark, [{"customer": c, "score": s, "riskDate": d} for c, s, d, *_ in items],
                    topic=S.TOPICS["risk_events"])


def _customers(spark, items):
    return env_rows(spark, [sorted_set({"customerName": c.split("@")[0].replace(".", " "), "email": c,
                                        "phone": "555", "birthDay": f"{y}-01-01"})
                            for c, *_, y in items], topic=S.TOPICS["customers"])


def test_q3_golden_scores_print_like_the_log(spark):
    out = R.risk_events(_events(spark, GOLDEN))
    got = rows(out, "customer", "score", "riskDate")
    assert ("Jason.Smith@test.com", "1.0", dt.date(2022, 1, 7)) in got
    assert ("Frank.Doshi@test.com", "-26.0", dt.date(2022, 1, 7)) in got
    assert out.columns == ["customer", "score", "riskDate"]


def test_q2_golden_birth_years(spark):
    got = rows(R.customer_birth_year(_customers(spark, GOLDEN)))
    assert ("Jason.Smith@test.com", "1963") in got
    assert ("David.Jones@test.com", "1941") in got


def test_q1_join_output_json_field_order(spark):
    out = R.risk_graph(_events(spark, GOLDEN), _customers(spark, GOLDEN))
    got = {r["key"]: r["value"] for r in out.collect()}
    assert got["Jason.Smith@test.com"] == (
        '{"customer":"Jason.Smith@test.com","score":"1.0","email":"Jason.Smith@test.com","birthYear":"1963"}')
    assert len(got) == len(GOLDEN)


def test_join_keeps_every_pair_and_never_matches_null(spark):
    ev = env_rows(spark, [{"customer": "a@x", "score": 1}, {"customer": "a@x", "score": 2},
                          {"customer": None, "score": 3}, {"score": 4}])
    cu = env_rows(spark, [sorted_set({"email": "a@x", "birthDay": "1950-02-03"}),
                          sorted_set({"email": "a@x", "birthDay": "1951-02-03"}),
                          sorted_set({"email": None, "birthDay": "1952-02-03"})])
    out = R.risk_graph_rows(ev, cu)
    assert out.count() == 4
    assert sorted(r["birthYear"] for r in out.collect()) == ["1950", "1950", "1951", "1951"]


def test_malformed_messages_become_nulls_and_are_dropped(spark):
    cu = env_rows(spark, [
        "not json at all",
        None,
        "",
        {"key": "k", "zSetEntries": None},
        {"key": "k", "zSetEntries": []},
        sorted_set("!!not*b64"),
        sorted_set({"Email": "wrong-case@x", "birthDay": "1950-01-01"}),
        sorted_set({"email": "no-birthday@x"}),
        sorted_set({"email": "bad-date@x", "birthDay": "not a date"}),
        sorted_set({"email": "ok@x", "birthDay": "1970-05-06"}),
    ])
    recs = R.customer_records(cu)
    assert recs.count() == 10  # one row per message, none fails
    assert rows(R.customer_birth_year(cu)) == [("ok@x", "1970")]


def test_number_into_string_field_keeps_its_text(spark):
    out = R.risk_events(env_rows(spark, ['{"customer":"c@x","score":17.0,"riskDate":"2022-01-07T10:00:00"}']))
    r = out.first()
    assert r["score"] == "17.0" and r["riskDate"] == dt.date(2022, 1, 7)


def test_risk_output_key_is_customer(spark):
    ev = env_rows(spark, [{"customer": "z@x", "score": "-27.5", "riskDate": "2022-01-07"}])
    cu = env_rows(spark, [sorted_set({"email": "z@x", "birthDay": "1947-01-01"})])
    r = R.risk_graph(ev, cu).first()
    assert r["key"] == "z@x"
    assert json.loads(r["value"]) == {"customer": "z@x", "score": "-27.5", "email": "z@x", "birthYear": "1947"}


def test_salted_join_gives_the_same_pairs(spark):
    items = [("hot@x", float(i), "2022-01-07", "1950") for i in range(40)] + GOLDEN
    ev = _events(spark, items)
    cu = _customers(spark, [("hot@x", 0.0, "2022-01-07", "1950")] * 2 + GOLDEN)
    plain = rows(R.risk_graph(ev, cu, salt=1))
    assert len(plain) == 80 + len(GOLDEN)
    assert rows(R.risk_graph(ev, cu, salt=7)) == plain

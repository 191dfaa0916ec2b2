from caretrail.plans import reports
from tests import domain_fixtures as fx


def rows_by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], []).append(r)
    return out


def test_ticket_base(spark):
    base = reports.ticket_base(fx.sources(spark), ticket_report=True)
    assert len(base.columns) == len(set(base.columns))
    by = rows_by_id(base)
    assert sorted(by) == [101, 102, 103, 104, 105, 108]          # claims form and NULL form dropped
    assert len(by[101]) == 2                                      # payment copy: tie kept
    r = by[101][0]
    assert (r.policy_number_1days, r.purchased_policy_1days, r.channel) == ("POL000001", 1, "api")
    r = by[102][0]
    assert r.channel == "aircall" and r.incidencia_grouped == "feedback request" and r.mail_seen == "seen"
    assert r.policy_number_1days is None and r.policy_number_3days == "POL000002"   # strict '<'
    assert r.interrupted_1days is None and r.interrupted_3days == "POL000002"
    assert (r.days_difference, r.purchased_policy_3days, r.purchased_policy_1days) == (1, 1, 0)
    r = by[103][0]
    assert r.policy_number is None and r.purchased_policy_14days == 0 and r.mail_seen is None
    assert r.incidencia_grouped == "complaints"
    r = by[104][0]
    assert r.CallerPhoneNumber is None and r.zdk_phone_to_join == "622000002"     # 11 digits: NULL
    assert r.policy_number == "POL000003" and r.policy_number_7days is None and r.policy_number_14days == "POL000003"
    assert r.incidencia_grouped == "llamada perdida"
    r = by[105][0]
    assert r.incidencia_grouped == "purchase support" and r.policy_number is None  # DNI wins over NIE
    r = by[108][0]
    assert r.CallerPhoneNumber == 622000005 and r.incidencia_grouped == "providers"


def test_ticket_report(spark):
    rep = reports.ticket_report(fx.sources(spark), checkpoint=False)
    assert len(rep.columns) == len(set(rep.columns))
    by = rows_by_id(rep)
    assert sorted(by) == [101, 102, 103, 108]                     # claim subject and NULL subject out
    assert len(by[101]) == 2
    assert by[101][0].Score == "good" and by[101][0].Reason == "slow"
    assert str(by[101][0].updated_at) == "2024-03-03 00:00:00"    # greatest(metrics, ticket)
    a, b = by[102][0], by[103][0]
    assert (a.client_15, a.n_contact_15, a.num_contacts) == ("1-1", 1, 2)
    assert (b.client_15, b.date_diff_lag, b.first_agent_client_15) == ("1-2", 16, 9)
    assert by[101][0].client_15 is None                           # API tickets are not in sessions


def test_call_report(spark):
    rep = reports.call_report(fx.sources(spark), checkpoint=False)
    assert len(rep.columns) == len(set(rep.columns))
    got = {r.call_id: r for r in rep.collect()}
    assert sorted(got) == [1, 2, 3]
    c1 = got[1]
    assert (c1.id, c1.dif_between_call_and_ticket, c1.Classification) == (101, 10, "NPS")
    assert c1.client_number_calculated == "34622833576"
    assert got[2].id is None and got[3].from_to_join is None
    assert str(got[3].created_time_utc) == "2024-03-31 01:30:00"
    assert c1.first_incidencia_30 == c1.incidencia_grouped == "purchase support"


def test_strict_dedupe_one_row_per_ticket(spark):
    src = fx.sources(spark)
    base = reports.ticket_base(src, ticket_report=True, dedupe="strict")
    assert base.count() == base.select("id").distinct().count() == 6
    rep = reports.ticket_report(src, checkpoint=False, dedupe="strict")
    assert rep.count() == rep.select("id").distinct().count() == 4


def test_anonymous_callers_may_be_left_out(spark):
    from caretrail.operators.calls import filter_calls, normalize_calls
    calls = normalize_calls(fx.calls(spark))
    kept, without = ({r.call_id for r in filter_calls(calls, drop_anonymous=d).collect()} for d in (False, True))
    assert 3 in kept and kept - without == {3}
    assert reports.call_report(fx.sources(spark), checkpoint=False, drop_anonymous=True).where("`from` = 'anonymous'").count() == 0

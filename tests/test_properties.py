"""J1/J2 on random click logs against a plain-Python brute force."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickflow.operators import category_action_counts, category_session_top_n, category_top_n

from .conftest import make_actions

ids = st.sampled_from(["1", "2", "3", "10", "11", "", "4"])
lists = st.one_of(st.none(), st.lists(ids, min_size=0, max_size=4).map(",".join))
rows = st.lists(
    st.fixed_dictionaries({
        "click_category_id": st.sampled_from([-1, -1, 1, 2, 3, 10, None]),
        "order_category_ids": lists,
        "pay_category_ids": lists,
        "session_id": st.sampled_from(["a-1", "a-2", "b", "c-9"]),
    }),
    min_size=1, max_size=40,
)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def brute_counts(rs):
    c = defaultdict(Counter)
    for r in rs:
        click = r["click_category_id"]
        if click is not None and click != -1:
            c[str(click)]["click"] += 1
        elif r["order_category_ids"] is not None:
            for i in r["order_category_ids"].split(","):
                if i:
                    c[i]["order"] += 1
        elif r["pay_category_ids"] is not None:
            for i in r["pay_category_ids"].split(","):
                if i:
                    c[i]["pay"] += 1
    return {k: (v["click"], v["order"], v["pay"]) for k, v in c.items()}


@SETTINGS
@given(rs=rows)
def test_counts_and_top_match_brute_force(spark, rs):
    df = make_actions(spark, rs)
    expect = brute_counts(rs)
    got = {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in category_action_counts(df).collect()}
    assert got == expect
    ranked = sorted(expect.items(), key=lambda kv: (-kv[1][0], -kv[1][1], -kv[1][2], kv[0]))[:3]
    assert [r.category_id for r in category_top_n(df, 3).collect()] == [k for k, _ in ranked]


@SETTINGS
@given(rs=rows)
def test_session_top_matches_brute_force(spark, rs):
    df = make_actions(spark, rs)
    top = [k for k, _ in sorted(brute_counts(rs).items(), key=lambda kv: (-kv[1][0], -kv[1][1], -kv[1][2], kv[0]))[:3]]
    per = defaultdict(Counter)
    for r in rs:
        click = r["click_category_id"]
        if click is not None and click != -1 and str(click) in top:
            per[str(click)][r["session_id"]] += 1
    expect = set()
    for cat, sessions in per.items():
        ranked = sorted(sessions.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
        expect |= {(cat, s, n, i + 1) for i, (s, n) in enumerate(ranked)}
    got = {(r.category_id, r.session_id, r.click_count, r.rank) for r in category_session_top_n(df, 3, 2).collect()}
    assert got == expect


clicks_st = st.lists(
    st.tuples(st.integers(0, 3 * 86_400_000), st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["1", "2"])),
    min_size=1, max_size=60,
)


@SETTINGS
@given(cs=clicks_st, threshold=st.integers(0, 3))
def test_blacklist_matches_per_click_simulation(spark, cs, threshold):
    from clickflow.operators import accepted_clicks, blacklisted_users
    from clickflow.operators.ads import with_day
    from clickflow.sources.adslog import parse_ad_lines

    lines = [(i, f"{t} P c {u} {a}") for i, (t, u, a) in enumerate(cs)]
    df = with_day(parse_ad_lines(spark.createDataFrame(lines, "event_id BIGINT, line STRING"), keep=["event_id"]))
    counts, banned, accepted = Counter(), set(), set()
    for i, (t, u, a) in sorted(enumerate(cs), key=lambda x: (x[1][0], x[0])):
        if u in banned:
            continue
        accepted.add(i)
        key = (t // 86_400_000, u, a)
        counts[key] += 1
        if counts[key] > threshold:
            banned.add(u)
    assert {r.event_id for r in accepted_clicks(df, threshold).collect()} == accepted
    assert {r.userid for r in blacklisted_users(df, threshold).collect()} == banned

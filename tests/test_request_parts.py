"""C9 / C10 requests in bounded parts: every part holds at most ``max_elements`` history
elements, and the parts read in order give exactly the single-array request."""

from pyspark.sql import functions as F

from chronotab.operators import nested as N
from chronotab.plans import driver as D
from chronotab.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def _joined(df, key, names):
    out = {}
    for r in df.orderBy(key, "part").collect():
        d = out.setdefault(r[key], {n: [] for n in names})
        for n in names:
            d[n].extend(r[n])
    return out


def test_credit_request_parts(spark):
    t = Tables(spark, SF)
    ent = t.customer.select("c_custkey")
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    tables = {"orders": (orders, ["o_orderdate", "o_orderkey", "o_totalprice"])}
    grand = {"lineitems": (t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey",
                           ["l_shipdate", "o_orderkey", "l_linenumber"], "orders")}
    whole = N.nested_history(ent, "c_custkey", tables, grand, max_elements=10 ** 9)
    parts = N.nested_history(ent, "c_custkey", tables, grand, max_elements=2)
    assert whole.where("part != 0").count() == 0
    assert parts.where((F.size("orders") > 2) | (F.size("lineitems") > 2)).count() == 0
    assert parts.where("part > 0").count() > 0
    assert _joined(parts, "c_custkey", ["orders", "lineitems"]) == _joined(whole, "c_custkey", ["orders", "lineitems"])
    # every entity has a part 0, even without history
    assert parts.where("part = 0").count() == ent.count()


def test_event_request_parts(spark):
    t = Tables(spark, SF)
    tx = D.card_transactions(t)
    sel = tx.where(F.col("trans_num") % 5 == 0)
    cols = ["trans_ts", "amt"]
    whole = N.range_history_join(sel, tx, "card", "trans_ts", "trans_num", cols, max_elements=10 ** 9)
    parts = N.range_history_join(sel, tx, "card", "trans_ts", "trans_num", cols, max_elements=3)
    assert parts.where(F.size("history") > 3).count() == 0
    assert parts.where("part > 0").count() > 0
    assert _joined(parts, "trans_num", ["history"]) == _joined(whole, "trans_num", ["history"])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_event_requests_are_cut_without_shuffling_pairs(spark):
    """Events and history are dealt once each; keys that come twice keep one joint history."""
    tx = spark.createDataFrame([(i, i % 3 if i % 7 else None, f"2024-01-{1 + i % 28:02d} 0{i % 9}:00:00", float(i)) for i in range(1, 90)],
                               "trans_num long, card long, at string, amt double").selectExpr("trans_num", "card", "CAST(at AS timestamp_ntz) AS trans_ts", "amt")
    sel = tx.where("trans_num % 4 = 0")
    req = N.range_history_join(sel, tx, "card", "trans_ts", "trans_num", ["trans_ts", "amt"])
    assert _plan(req).count("Exchange") <= 2
    want = {}
    rows = tx.collect()
    for e in sel.collect():
        want[e.trans_num] = sorted((h.trans_ts, h.amt) for h in rows if e.card is not None and h.card == e.card and h.trans_ts < e.trans_ts)
    got = {r.trans_num: [tuple(x) for x in r.history] for r in req.collect()}
    assert got == want and max(map(len, want.values())) > 5
    twice = N.range_history_join(sel.unionByName(sel.where("trans_num = 80")), tx, "card", "trans_ts", "trans_num", ["trans_ts", "amt"])
    both = [[tuple(x) for x in r.history] for r in twice.where("trans_num = 80").collect()]
    assert both == [sorted(want[80] * 2)] * 2 and twice.where("trans_num <> 80").count() == len(want) - 1


def test_windows_shuffle_plain_columns(spark):
    from chronotab.operators.windows import event_features
    plan = _plan(event_features(D.card_transactions(Tables(spark, SF)), hot_card_rows=None))
    assert plan.count("Exchange hashpartitioning") == 1 and "_c2" not in plan.split("Exchange hashpartitioning")[1]

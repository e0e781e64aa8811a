"""Property tests: the money/percent parsers against a plain-Python reading of the rules."""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from handover.functions.scalars import parse_money, parse_percent_int

_NUM = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)")
_INT = re.compile(r"[+-]?\d+")

money_like = st.builds(
    lambda sign, whole, frac, mark, pad, comma: f"{pad}{mark}{sign}{whole[:1]}{',' if comma and len(whole) > 1 else ''}{whole[1:]}{frac}{pad}",
    st.sampled_from(["", "-", "+"]),
    st.text(alphabet="0123456789", min_size=0, max_size=9),
    st.sampled_from(["", ".", ".5", ".25", ".125", ".99995", ".00005"]),
    st.sampled_from(["", "$", "USD "]),
    st.sampled_from(["", " ", "  "]),
    st.booleans(),
)
junk = st.text(alphabet="0123456789.,$%e -abc", max_size=8)


def _ref_money(text, mark):
    if text is None:
        return None
    s = text.replace(mark, "") if mark else text
    s = s.strip(" ").replace(",", "")
    if not _NUM.fullmatch(s):
        return None
    d = Decimal(s).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
    return d if abs(d) < Decimal(10) ** 15 else None


def _ref_pct(text):
    if text is None:
        return None
    s = text.replace("%", "").strip(" ")
    if not _INT.fullmatch(s):
        return None
    v = int(s)
    return v if -(2**31) <= v < 2**31 else None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(money_like, junk, st.none()), min_size=1, max_size=60))
def test_parse_money_matches_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    for mark in ["$", "USD"]:
        got = [r[0] for r in df.select(parse_money("x", mark)).collect()]
        assert got == [_ref_money(v, mark) for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.builds(lambda n, p: f"{n}{p}", st.integers(-10**11, 10**11), st.sampled_from(["%", "", " %"])), junk, st.none()), min_size=1, max_size=60))
def test_parse_percent_matches_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(parse_percent_int("x")).collect()]
    assert got == [_ref_pct(v) for v in values]


def _ref_code(name):
    import hashlib

    t = ("" if name is None else name).strip(" ")
    if not t:
        return None
    return (t[0] + hashlib.sha1(t.encode("utf-16-le")).hexdigest()[:4]).upper()


names = st.text(alphabet=st.sampled_from(list("abcxyzABCXYZ0189 &.-'éàüñøÅÇ漢字ДЖ")), max_size=40)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(names, st.none()), min_size=1, max_size=60))
def test_customer_code_matches_hashlib(spark, values):
    from handover.functions.scalars import customer_code

    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(customer_code("x")).collect()]
    assert got == [_ref_code(v) for v in values]


row = st.tuples(st.integers(0, 30), st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), st.one_of(st.none(), st.integers(-3, 3)))


@settings(max_examples=12, deadline=None)
@given(st.lists(row, max_size=25, unique_by=lambda r: r[0]), st.lists(row, max_size=25, unique_by=lambda r: r[0]))
def test_audit_diff_matches_brute_force(spark, before_rows, after_rows):
    import json

    from handover.operators.audit import audit_diff

    schema = "k int, s string, n int"
    before = spark.createDataFrame(before_rows, schema)
    after = spark.createDataFrame(after_rows, schema)
    got = {(r.k, r.operation): (r.key_values, r.old_values, r.new_values) for r in audit_diff(before, after, ["k"], "T", None, "me").collect()}

    def image(r):
        return json.dumps({k: v for k, v in zip(("k", "s", "n"), r) if v is not None}, separators=(",", ":"))

    b, a = {r[0]: r for r in before_rows}, {r[0]: r for r in after_rows}
    exp = {}
    for k in set(b) | set(a):
        if k not in a:
            exp[(k, "D")] = (json.dumps({"k": k}, separators=(",", ":")), image(b[k]), None)
        elif k not in b:
            exp[(k, "I")] = (json.dumps({"k": k}, separators=(",", ":")), None, image(a[k]))
        elif b[k] != a[k]:
            exp[(k, "U")] = (json.dumps({"k": k}, separators=(",", ":")), image(b[k]), image(a[k]))
    assert got == exp


ENT_S = "entity_id int, entity_label string, type_flag string, location_ref int, contact_info string"
ITM_S = "item_id int, label string, source_ref int, group_ref int, cost string, qty_available int"
BAT_S = "batch_id int, batch_date long, reference_id int, total_value string"
TXN_S = "transaction_id int, batch_ref int, item_ref int, partner_ref int, qty int, date_key long, amount string"

ent_rows = st.lists(
    st.tuples(st.sampled_from([None, "", "  ", "Acme", "Zed"]), st.sampled_from([None, "A", "a", "B", "b"])), min_size=1, max_size=8
)
itm_rows = st.lists(
    st.tuples(st.sampled_from(["", " ", "P", "Q"]), st.integers(0, 9), st.sampled_from(["$1.50", "n/a", "", "$2", None])), min_size=1, max_size=8
)
txn_rows = st.lists(
    st.tuples(st.integers(1, 3), st.one_of(st.none(), st.integers(1, 9)), st.integers(1, 2), st.sampled_from(["50%", "bad%", "33.5%", None])),
    max_size=20,
)


def _blank(x):
    return x is None or x.strip(" ") == ""


def _money_ok(x, mark):
    if x is None:
        return False
    s = x.replace(mark, "").strip(" ").replace(",", "")
    return bool(_NUM.fullmatch(s))


@settings(max_examples=12, deadline=None)
@given(ent_rows, itm_rows, txn_rows)
def test_cascade_matches_brute_force(spark, ents, itms, txns):
    from handover.operators import validate as V

    E = [(i + 1, lab if lab is not None else "", flag, 1, "x") for i, (lab, flag) in enumerate(ents)]  # label NOT NULL
    I = [(i + 1, lab, src, 0, cost, 1) for i, (lab, src, cost) in enumerate(itms)]
    B = [(b, 0, b, "USD 1") for b in (1, 2, 3)]
    T = [(i + 1, b, it, 0, 1, d, amt) for i, (b, it, d, amt) in enumerate(txns)]
    v = V.validate_all({
        "locations": None,
        "entities": spark.createDataFrame(E, ENT_S),
        "items": spark.createDataFrame(I, ITM_S),
        "batches": spark.createDataFrame(B, BAT_S),
        "transactions": spark.createDataFrame(T, TXN_S),
    })
    # brute force, rule by rule
    up = lambda f: (f or "").upper()
    ent_bad = {e[0]: (up(e[2]) == "A" and e[1] is None) or e[1].strip(" ") == "" or (up(e[2]) == "B" and e[1] is None) for e in E}
    ent_flag = {e[0]: e[2] for e in E}
    exp_items = {}
    for i in I:
        if _blank(i[1]):
            exp_items[i[0]] = V.ITEM_NO_NAME
        elif not _money_ok(i[4], "$"):
            exp_items[i[0]] = V.ITEM_NO_COST
        elif not (i[2] in ent_flag and up(ent_flag[i[2]]) == "B" and not ent_bad[i[2]]):
            exp_items[i[0]] = V.ITEM_BAD_SUPPLIER
        else:
            exp_items[i[0]] = None
    first = {}
    for t in T:
        key = (t[1], t[2], t[5])
        first[key] = min(first.get(key, t[0]), t[0])
    exp_txn = {}
    for t in T:
        if first[(t[1], t[2], t[5])] != t[0]:
            exp_txn[t[0]] = V.TXN_DUPLICATE
        elif not _money_ok(t[6], "%"):
            exp_txn[t[0]] = V.TXN_NO_PERCENT
        elif t[2] in exp_items and exp_items[t[2]] is not None:
            exp_txn[t[0]] = V.TXN_BAD_ITEM
        else:
            exp_txn[t[0]] = None
    exp_bat = {b[0]: None if (b[2] in ent_bad and not ent_bad[b[2]]) else V.BATCH_BAD_CUSTOMER for b in B}
    assert {r.item_id: r.validation_error for r in v["items"].collect()} == exp_items
    assert {r.transaction_id: r.validation_error for r in v["transactions"].collect()} == exp_txn
    assert {r.batch_id: r.validation_error for r in v["batches"].collect()} == exp_bat
    assert {r.entity_id: (not r.is_valid) for r in v["entities"].collect()} == ent_bad

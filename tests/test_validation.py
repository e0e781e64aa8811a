from pyspark.sql import functions as F

from handover.operators import validate as V

ENT = "entity_id int, entity_label string, type_flag string, location_ref int, contact_info string"
ITM = "item_id int, label string, source_ref int, group_ref int, cost string, qty_available int"
BAT = "batch_id int, batch_date long, reference_id int, total_value string"
TXN = "transaction_id int, batch_ref int, item_ref int, partner_ref int, qty int, date_key long, amount string"


def _codes(df, key):
    return {r[key]: r["error_code"] for r in df.collect()}


def test_entity_rule_precedence(spark):
    rows = []
    i = 0
    for flag in ["A", "B", None]:
        for label in [None, "  ", "Acme"]:
            i += 1
            rows.append((i, label, flag, 1, "x"))
    e = spark.createDataFrame(rows, ENT)
    as_written = set(_codes(V.bad_customers(e), "entity_id"))
    strict = set(_codes(V.bad_customers(e, strict_type=True), "entity_id"))
    # As written: (A and null) or blank, whatever the flag.
    assert as_written == {1, 2, 5, 8}
    assert strict == {1, 2}


def test_duplicates_and_percent(spark):
    t = spark.createDataFrame(
        [
            (1, 10, 5, 0, 1, 100, "bad%"),   # survivor, but unparseable
            (2, 10, 5, 0, 1, 100, "50%"),    # duplicate
            (3, 10, 5, 0, 1, 100, "50%"),    # duplicate
            (4, 10, None, 0, 1, 100, "50%"), # null item: nulls group together
            (5, 10, None, 0, 1, 100, "50%"),
            (6, 11, 5, 0, 1, 100, "33.5%"),  # money-parseable
        ],
        TXN,
    )
    assert _codes(V.bad_transactions(t), "transaction_id") == {
        1: V.TXN_NO_PERCENT, 2: V.TXN_DUPLICATE, 3: V.TXN_DUPLICATE, 5: V.TXN_DUPLICATE,
    }
    d = {r.transaction_id: r.survivor_id for r in V.duplicate_transactions(t).collect()}
    assert d == {2: 1, 3: 1, 5: 4}


def test_batch_rule(spark):
    b = spark.createDataFrame(
        [(1, 0, 1, "USD 10"), (2, 0, 1, "USD 10"), (3, 0, 1, "USD 10"), (4, 0, 1, "USD 10"), (5, 0, 1, "USD 10"), (6, 0, 1, "bad")],
        BAT,
    )
    t = spark.createDataFrame(
        [
            (1, 1, 1, 0, 1, 1, "99%"),
            (2, 2, 1, 0, 1, 1, "60%"), (3, 2, 1, 0, 1, 2, "40%"),
            (4, 3, 1, 0, 1, 1, "101%"),
            (5, 4, 1, 0, 1, 1, "33.5%"),            # INT parse: null sum
            (6, 6, 1, 0, 1, 1, "100%"),
        ],
        TXN,
    )
    got = _codes(V.bad_batches(b, t), "batch_id")
    assert got == {1: V.BATCH_UNDER_100, 3: V.BATCH_OVER_100, 4: None, 6: V.BATCH_NO_TOTAL}
    # batch 5 has no line: not reported (inner join); batch 2 sums to 100.


def test_cascade(spark):
    e = spark.createDataFrame(
        [(1, "Cust", "A", 1, "x"), (1000000001, "", "B", 1, "y"), (1000000002, "Good", "B", 1, "z")], ENT
    )
    i = spark.createDataFrame(
        [
            (1, "I1", 1000000001, 0, "$1", 1),   # supplier invalid (blank name)
            (2, "I2", 1000000002, 0, "$1", 1),   # fine
            (3, "I3", 1, 0, "$1", 1),            # supplier is a customer
            (4, "I4", 777, 0, "$1", 1),          # unknown supplier
            (5, "", 1000000002, 0, "$1", 1),     # own rule first
        ],
        ITM,
    )
    b = spark.createDataFrame([(1, 0, 1, "USD 1"), (2, 0, 999, "USD 1")], BAT)
    t = spark.createDataFrame(
        [(1, 1, 1, 0, 1, 1, "100%"), (2, 1, 2, 0, 1, 2, "100%"), (3, 1, 99, 0, 1, 3, "100%"), (4, 2, 2, 0, 1, 4, "100%")], TXN
    )
    v = V.validate_all({"locations": None, "entities": e, "items": i, "batches": b, "transactions": t})
    items = {r.item_id: r.validation_error for r in v["items"].collect()}
    assert items == {1: V.ITEM_BAD_SUPPLIER, 2: None, 3: V.ITEM_BAD_SUPPLIER, 4: V.ITEM_BAD_SUPPLIER, 5: V.ITEM_NO_NAME}
    txns = {r.transaction_id: r.validation_error for r in v["transactions"].collect()}
    # unknown item (3) and invalid batch (4) do not invalidate the line
    assert txns == {1: V.TXN_BAD_ITEM, 2: None, 3: None, 4: None}
    batches = {r.batch_id: r.validation_error for r in v["batches"].collect()}
    assert batches == {1: None, 2: V.BATCH_BAD_CUSTOMER}
    assert v["entities"].filter(~F.col("is_valid")).count() == 1


def test_valid_plus_invalid_is_staged(spark):
    from handover.sources import fixtures as fx
    from conftest import SF_SMALL

    src = fx.sources(spark, SF_SMALL)
    v = V.validate_all(src)
    for name in ["entities", "items", "batches", "transactions"]:
        n = src[name].count()
        assert v[name].count() == n
        assert v[name].filter("is_valid").count() + v[name].filter("NOT is_valid").count() == n


def test_duplicates_follow_a_rewritten_extract(spark, tmp_path):
    path = str(tmp_path / "t")
    names = ["transaction_id", *V.DUP_KEYS]
    for rows, want in (([(1, 1), (2, 2)], set()), ([(3, 5), (4, 5)], {4})):
        df = spark.createDataFrame([(i, *[k] * (len(names) - 1)) for i, k in rows], names)
        df.write.mode("overwrite").parquet(path)
        found = V._with_survivor(spark.read.parquet(path))
        assert {r.transaction_id for r in found.collect() if r.survivor_id != r.transaction_id} == want


def test_null_references_are_spread(spark):
    bat = spark.createDataFrame([(i, None if i % 3 else 1, "1", "1") for i in range(300)], "batch_id int, reference_id int, total_value string, batch_date string")
    ent = spark.createDataFrame([(i, True) for i in range(300)], "entity_id int, is_valid boolean")
    got = V.validate_batches(bat, ent)
    assert got.count() == 300 and got.where("is_valid").count() == 100  # null ids meet no entity of their own number

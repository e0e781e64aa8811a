"""Lines are staged by one shuffle; repeated keys are searched by as many tasks as the session shuffles to."""

import datetime as dt

from handover.operators.quality import constraint_violations
from handover.sources import fixtures as fx


def test_lines_are_numbered_without_a_join(spark, tmp_path, monkeypatch):
    day = dt.datetime(1996, 1, 1)
    keys = [7, 3, None, 3, 7, 3, 5, None, 7]
    lines = [(k, i, i % 2, 1.0 + i, 10.0 * i, None if i == 4 else 5 - i, day) for i, k in enumerate(keys)]
    lines += [lines[6], (5, 0, 0, None, 1.0, 1, day)]  # a repeated line, a first one with a null
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_linenumber int, l_shipdate timestamp"
    spark.createDataFrame(lines, schema).repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    plans, number = [], fx.with_row_index

    def seen(df, *args, **more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return number(df, *args, **more)

    monkeypatch.setattr(fx, "with_row_index", seen)
    got = {r["transaction_id"]: r for r in fx.transactions(spark, str(tmp_path), materialize=False).collect()}
    assert "Join" not in plans[0] and "Aggregate" not in plans[0]
    order = [(x[0], x[5], x[1], x[2], x[6], x[3], x[4]) for x in lines if x[0] is not None]
    order.sort(key=lambda x: [(v is not None, v) for v in x])
    assert sorted(got) == list(range(1, len(order) + 1))  # fewer than 97: no injected copies
    for i, line in enumerate(order, 1):
        own = [x for x in order if x[0] == line[0]]
        share = 100 // len(own) + (100 % len(own) if line == own[0] else 0)
        assert (got[i]["batch_ref"], got[i]["amount"]) == (line[0] + 1, f"{share}%")


def test_repeated_and_null_keys_are_found_by_all_tasks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c"), (None, "d"), (None, "e"), (3, "f")], "k long, v string")
    found = constraint_violations(df, "t", "k", not_null=[], max_lengths={}, primary_key="k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1
    assert sorted((r.key_value or "", r.rule) for r in found.collect()) == [("", "PRIMARY_KEY"), ("1", "PRIMARY_KEY")]

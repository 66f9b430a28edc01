"""Per-user totals over hostile rows, and sketches against exact counts."""

from cohortix.operators import marts as M
from cohortix.operators import sketches as S

ITEMS = "user_id long, order_id long, sale_price decimal(12,2), created_at timestamp_ntz, category string, brand string"


def test_user_totals_keep_null_users_and_ignore_null_kinds(spark):
    rows = spark.sql("""
        SELECT * FROM VALUES (1, 10, 5.00, '2024-01-01', 'a', 'x'), (1, 10, 5.00, '2024-01-01', 'a', 'x'), (1, 11, 2.50, '2024-01-03', null, 'y'),
               (null, 12, 1.00, '2024-01-02', 'b', null), (null, 12, null, '2024-01-05', 'c', null), (2, null, 3.00, null, null, null)""")
    names = [c.split()[0] for c in ITEMS.split(", ")]
    kinds = [c.split()[1] for c in ITEMS.split(", ")]
    items = rows.toDF(*names).selectExpr(*[f"cast({n} AS {k}) AS {n}" for n, k in zip(names, kinds, strict=True)])
    got = {r["user_id"]: r for r in M.user_totals(items, {"category": "c", "brand": "b"}).collect()}
    assert {u: (r["n_orders"], float(r["value"]), r["n_items"], r["c"], r["b"]) for u, r in got.items()} == {
        1: (2, 12.5, 3, 1, 2), None: (1, 1.0, 2, 2, 0), 2: (0, 3.0, 1, 0, 0)}
    assert str(got[1]["last_at"])[:10] == "2024-01-03" and got[2]["first_at"] is None
    assert M.user_totals(items.limit(0), {"category": "c"}).count() == 0


def test_merged_sketches_are_near_the_exact_count(spark):
    # a third of the rows are of one key; days overlap in their keys
    rows = spark.range(60000).selectExpr("id % 7 AS day", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 20011 END AS user")
    days = S.distinct_sketches(rows, ["day"], "user")
    exact = rows.select("user").distinct().count()
    got = S.merge_sketches(days, []).select("n_rows", S.estimate().alias("e")).first()
    assert got["n_rows"] == 60000 and abs(got["e"] - exact) <= S.relative_error() * exact
    nulls = S.distinct_sketches(rows.selectExpr("day", "cast(null AS bigint) AS user"), ["day"], "user").select(S.estimate().alias("e"))
    assert {r["e"] for r in nulls.collect()} == {0}
    assert S.distinct_sketches(rows.limit(0), ["day"], "user").count() == 0

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.synth import draw
from millrace.operators import generate

N = 5000


@pytest.fixture
def ids(spark):
    return spark.range(N)


MAKERS = {
    "sales": (lambda ids: generate.sales(ids, null_rate=0.05), schemas.SALES_COLUMNS),
    "users": (generate.users, schemas.USER_COLUMNS),
    "transactions": (generate.transactions, schemas.TRANSACTION_COLUMNS),
    "full": (lambda ids: generate.changes(ids, "full"), schemas.CHANGE_COLUMNS),
    "incremental": (
        lambda ids: generate.changes(ids, "incremental", base_rows=200),
        schemas.CHANGE_COLUMNS,
    ),
}


@pytest.mark.parametrize("name", MAKERS)
def test_same_table_however_partitioned(spark, rows, name):
    make, columns = MAKERS[name]
    few = make(spark.range(0, 500, numPartitions=2))
    many = make(spark.range(0, 500, numPartitions=5).orderBy(F.desc("id")))
    assert few.columns == list(columns)
    assert rows(few) == rows(many)


def share(df, condition):
    return df.filter(condition).count() / N


def test_sales(ids):
    df = generate.sales(ids, null_rate=0.05)
    low, high, cheap, dear, wrong = df.agg(
        F.min("quantity"),
        F.max("quantity"),
        F.min("unit_price"),
        F.max("unit_price"),
        F.max(F.abs(F.col("quantity") * F.col("unit_price") - F.col("total_price"))),
    ).first()
    assert (low, high) == (1, 20)
    assert 1.0 <= cheap < 5 and 495 < dear <= 500.0
    assert wrong < 1e-9
    assert share(df, "order_id is null") == pytest.approx(0.05, abs=0.02)
    uuid = "order_id rlike '^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$'"
    assert df.filter(f"order_id is not null and not {uuid}").count() == 0
    iso = "^2024-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"
    assert df.filter(~F.col("order_timestamp").rlike(iso)).count() == 0
    assert {r[0] for r in df.select("region").distinct().collect()} == set(
        generate.REGIONS
    )


def test_no_nulls_by_default(ids):
    assert generate.sales(ids).filter("order_id is null").count() == 0


def test_seed_changes_the_table(ids):
    a, b = generate.sales(ids, seed=1), generate.sales(ids, seed=2)
    assert a.select("order_id").intersect(b.select("order_id")).count() == 0


def test_users(ids):
    df = generate.users(ids)
    assert df.schema == schemas.USERS or dict(df.dtypes)["is_active"] == "boolean"
    assert share(df, "is_active") == pytest.approx(0.8, abs=0.03)
    assert df.select("user_id").distinct().count() == N


def test_buyers_are_users(spark, ids):
    users = generate.users(spark.range(1000))
    orphans = generate.sales(ids, users=1000).join(
        users, F.expr("customer_id = user_id"), "left_anti"
    )
    assert orphans.count() == 0


def test_transactions(ids):
    df = generate.transactions(ids)
    for status, expected in (("completed", 0.7), ("pending", 0.2), ("failed", 0.1)):
        assert share(df, f"status = '{status}'") == pytest.approx(expected, abs=0.03)
    low, high = df.agg(F.min("amount"), F.max("amount")).first()
    assert 5.0 <= low < 10 and 1990 < high <= 2000.0


def test_changes_full(ids):
    df = generate.changes(ids, "full")
    assert df.filter("operation <> 'INSERT'").count() == 0
    assert df.select("order_id").distinct().count() == N


def test_changes_incremental(spark, ids):
    df = generate.changes(ids, "incremental", base_rows=200)
    for operation, expected in (("INSERT", 0.2), ("UPDATE", 0.6), ("DELETE", 0.2)):
        found = share(df, f"operation = '{operation}'")
        assert found == pytest.approx(expected, abs=0.03)
    base = generate.changes(spark.range(200), "full").select("order_id")
    known = df.join(base, "order_id", "left_semi")
    assert known.filter("operation = 'INSERT'").count() == 0
    assert known.count() == df.filter("operation <> 'INSERT'").count()


@pytest.mark.parametrize("mode, base", [("partial", 5), ("incremental", None)])
def test_bad_arguments(ids, mode, base):
    with pytest.raises(ValueError):
        generate.changes(ids, mode, base_rows=base)


def test_draws_above_32_bits(spark):
    below = 10**11
    low, high, n = spark.range(20_000).select(draw(1, "x", "id", below).alias("v")).agg(F.min("v"), F.max("v"), F.count_distinct("v")).first()
    assert 0 <= low < below * 0.001 and below * 0.999 < high < below and n > 19_990
    for wrong in (0, -1, 16**15 + 1):
        with pytest.raises(ValueError):
            draw(1, "x", "id", wrong)


@pytest.mark.parametrize("rate", [0.00005, 0.57, 1.0])
def test_null_rates_are_not_cut_off(spark, rate):
    n = 200_000
    found = generate.sales(spark.range(n), null_rate=rate).filter("order_id is null").count()
    assert found == pytest.approx(n * rate, abs=4 * (n * rate * (1 - rate)) ** 0.5)
    assert found > 0


def test_more_users_than_the_default(spark):
    buyers = generate.sales(spark.range(20_000), users=10**6).select("customer_id").distinct().count()
    assert buyers > 19_000

"""The seeded sample draws rows, not keys."""

import datetime as dt
from decimal import Decimal
from hashlib import md5

from compare import differences, duck

from trueledger import registry
from trueledger.plans import analytics

registry.load_all()

LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)
LEDGER = (
    "transaction_id bigint, transaction_date date, fiscal_year int, fiscal_period int, account_number string, "
    "debit_amount decimal(18,2), credit_amount decimal(18,2), description string"
)


def place(row, seed):
    key, day, _, _, account, debit, credit, _ = row
    return md5("|".join(str(v) for v in (seed, key, day, account, debit, credit) if v is not None).encode()).hexdigest()


def ledger(keys):
    day = dt.date(2000, 1, 1)
    return [(k, day, 2000, 1, str(i), Decimal(f"{i}.50"), Decimal("0.00"), f"row {i}") for i, k in enumerate(keys)]


def test_rows_of_one_key_are_drawn_one_by_one(spark):
    made = ledger([None, 1, 2, 3] * 50)
    drawn = [tuple(r) for r in analytics.ledger_sample(spark.createDataFrame(made, LEDGER).repartition(5), 10, 42).collect()]
    assert drawn == sorted(made, key=lambda r: place(r, 42))[:10]
    assert len({r[0] for r in drawn}) > 1


def test_rows_of_one_digest_follow_by_what_they_show(spark):
    same = ledger([7])[0][:-1]
    made = spark.createDataFrame([(*same, f"row {i:02d}") for i in range(40)], LEDGER)
    for parts in (1, 7):
        drawn = analytics.ledger_sample(made.repartition(parts), 3, 42).collect()
        assert [r.description for r in drawn] == ["row 00", "row 01", "row 02"]


def test_query_draws_among_the_rows_of_repeated_orders(spark, folder):
    """Three keys and no key, sixty lines each: the ten rows are those of the SQL, from more than one key."""
    day = dt.datetime(1998, 5, 1)
    lines = [(k, i, None, 1, 1.0, i + 0.25, 0.0, 0.0, "N", "FO"[i % 2], day) for i, k in enumerate([None, 1, 2, 3] * 60)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{folder}/lines")
    con = duck(folder)
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lines/*.parquet'")
    con.execute("CREATE TABLE supplier (s_suppkey BIGINT, s_nationkey INTEGER)")
    con.execute(f"COPY lineitem TO '{folder}/lineitem.parquet' (FORMAT parquet)")
    df = registry.QUERIES["o03_seeded_sample"](spark, folder)
    n, problems = differences(df, con, registry.ORACLES["o03_seeded_sample"])
    assert (n, problems) == (10, [])
    assert len({r.transaction_id for r in df.collect()}) > 1

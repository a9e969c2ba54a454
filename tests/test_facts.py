from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from tallybook.operators import facts
from tallybook.plans import ORACLES, QUERIES
from tests.fixtures import rows_of
from tests.oracle import differences


@pytest.fixture
def sales(spark):
    rows = [(1, 1, "b", 5), (1, 1, "a", 9), (1, 1, "a", 2), (2, 1, "c", 1), (2, 1, "c", 1)]
    return spark.createDataFrame(rows, "id int, line int, item string, n int")


def test_dedup(sales):
    grain = ["id", "line"]
    assert rows_of(facts.fact_dedup(sales, grain, ["item"])) == [(1, 1, "a", 2), (2, 1, "c", 1)]
    assert rows_of(facts.fact_dedup(sales, grain, ["n"])) == [(1, 1, "a", 2), (2, 1, "c", 1)]
    assert facts.fact_dedup(sales, sales.columns).count() == 4
    assert rows_of(facts.duplicate_report(sales, grain)) == [(1, 1, 3), (2, 1, 2)]
    shuffled = facts.fact_dedup(sales.orderBy(F.desc("n")).repartition(3), grain)
    assert rows_of(shuffled) == rows_of(facts.fact_dedup(sales, grain))


def test_denormalize(spark, sales):
    items = spark.createDataFrame([("a", "apple", 1), ("b", None, 2)], "item string, name string, w int")
    wide = facts.fact_denormalize(sales, [(items, ["item"], ["name"])])
    assert wide.count() == sales.count() and "w" not in wide.columns
    assert (2, None) in rows_of(wide, "id", "name")
    twice = items.unionByName(items.limit(1))
    with pytest.raises(Exception, match="dimension key is not unique: a"):
        facts.fact_denormalize(sales, [(twice, ["item"], ["name"])]).collect()


def test_normalize(spark):
    wide = spark.createDataFrame(
        [(1, 7, "red"), (2, 7, "red"), (3, 8, "blue"), (4, 8, "sky")], "id int, k int, colour string"
    )
    fact, dim, conflicts = facts.fact_normalize(wide, "k", ["colour"])
    assert rows_of(fact) == [(1, 7), (2, 7), (3, 8), (4, 8)]
    assert rows_of(dim) == [(7, "red"), (8, "blue"), (8, "sky")]
    assert rows_of(conflicts) == [(8, 2)]


def test_raw_logs(spark):
    raw = spark.createDataFrame(
        [
            ("1", "click", '{"amt": "2.50"}'),
            ("1", "click", '{"amt": "2.50"}'),
            ("2", "view", "not json"),
            ("3", "click", '{"amt": "many"}'),
            ("x", "view", "{}"),
            (None, "view", "{}"),
            ("4", "boom", "{}"),
            ("5", "view", None),
        ],
        "ID string, EvType string, payload string",
    )
    good, bad = facts.raw_logs_to_facts(
        raw,
        {
            "event_id": (F.col("ID"), "int"),
            "action": (F.col("EvType"), "string"),
            "amount": (F.col("parsed.amt"), "decimal(9,2)"),
        },
        grain=["event_id"],
        json_col="payload",
        json_schema="amt string",
        domains={"action": ["click", "view"]},
    )
    assert rows_of(good.withColumn("amount", F.col("amount").cast("double"))) == [
        (1, "click", 2.5), (5, "view", None)
    ]
    assert rows_of(bad, "ID", "reason") == sorted(
        [
            ("1", "event_id: copy"), ("2", "payload: not JSON"), ("3", "amount: not a decimal(9,2)"), ("x", "event_id: not a int"),
            (None, "event_id: missing"), ("4", "action: not in domain"),
        ],
        key=repr,
    )


def test_every_event_is_judged(spark, tmp_path):
    """The queries and their SQL on events of which each has another fault, or none."""
    day, sound = datetime(2024, 1, 9, 23), '{"k": 5}'
    events = [
        (1, 7, "click", 2.5, sound, day), (1, 6, "view", 9.0, sound, day), (1, 6, "error", 0.0, sound, day),
        (2, 7, "view", 1.0, "cut", day), (3, 7, "view", 1.0, "[5]", day), (4, 7, "view", 1.0, '{"k": "many"}', day),
        (5, 7, "view", 1.0, '{"k": 1.5}', day), (6, 7, "view", 1e30, sound, day), (7, 7, "view", float("nan"), sound, day),
        (None, 7, "view", 1.0, sound, day), (None, 7, "view", 1.0, sound, day), (8, 7, "error", 1.0, sound, day),
        (9, 7, None, 1.0, sound, day), (10, None, "signup", None, None, None), (11, 7, "purchase", 3.0, "{}", day),
        (11, 7, "purchase", 3.0, "{}", day), (12, 7, "view", 1.0, "", day), (13, 7, "view", 1.0, "cut", day),
        (13, 7, "view", 1.0, sound, day),
    ]
    schema = "event_id long, user_id long, event_type string, value double, props string, ts timestamp_ntz"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{tmp_path}/events.parquet/*.parquet')")
    found = {name: QUERIES[name](spark, str(tmp_path)) for name in ("raw_logs_to_facts", "raw_logs_rejects")}
    for name, df in found.items():
        assert differences(con, ORACLES[name], df) == []
    assert found["raw_logs_to_facts"].count() == 6
    assert rows_of(found["raw_logs_rejects"], "event_id", "reason") == sorted(
        [
            (1, "event_id: copy"), (1, "action: not in domain"), (2, "props: not JSON"), (3, "props: not JSON"),
            (4, "place: not a int"), (5, "place: not a int"), (6, "amount: not a decimal(18,2)"),
            (7, "amount: not a decimal(18,2)"), (None, "event_id: missing"), (None, "event_id: missing"),
            (8, "action: not in domain"), (11, "event_id: copy"), (13, "props: not JSON"),
        ],
        key=repr,
    )


def test_five_w(spark):
    df = spark.createDataFrame([(1, "buy", None), (2, None, None)], "u int, a string, p string")
    shaped, rates = facts.fact_five_w(df, F.col("u"), F.col("a"), F.col("p"), F.lit("2024"), F.lit("log"))
    assert shaped.columns == ["who", "what", "where", "when", "how"]
    assert {r.column_name: r.fill_rate for r in rates.collect()} == {
        "who": 1.0, "what": 0.5, "where": 0.0, "when": 1.0, "how": 1.0
    }
    _, none = facts.fact_five_w(df.limit(0), F.col("u"), F.col("a"), F.col("p"), F.lit(1), F.lit(1))
    assert {r.fill_rate for r in none.collect()} == {None}


def test_retention(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 9, 23),), (datetime(2024, 1, 10),), (datetime(2024, 1, 12),)], "ts timestamp_ntz"
    )
    kept = facts.retention_filter(df, "ts", date(2024, 1, 15), 5)
    assert kept.count() == 2

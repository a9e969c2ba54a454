"""Bit histories against histories kept as sets of periods."""

import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators import bithistory as bh
from tests.fixtures import rows_of
from tests.test_plans import no_broadcast, plan  # noqa: F401

AS_OF = 100


def periods(seed=1, n=60):
    draw = random.Random(seed)
    rows = {f"e{i}": sorted({AS_OF - draw.randrange(80) for _ in range(draw.choice([1, 3, 20, 70]))}) for i in range(n)}
    rows["always"] = list(range(AS_OF - 90, AS_OF + 1))
    rows["long ago"] = [AS_OF - 63, AS_OF - 90]
    rows["edge"] = [AS_OF - 62]
    rows["later"] = [AS_OF + 1]
    return rows


def frame(spark, rows):
    flat = [(k, p) for k, ps in rows.items() for p in ps for _ in range(1 + len(k) % 3)]
    return spark.createDataFrame([*flat, (None, AS_OF), ("none", None)], "k string, p int")


def longest(ages):
    best = run = 0
    for age in range(63):
        run = run + 1 if age in ages else 0
        best = max(best, run)
    return best


def expected(rows, as_of=AS_OF):
    out = []
    for k, ps in rows.items():
        ages = {as_of - p for p in ps if p <= as_of}
        if not ages:
            continue
        near = {a for a in ages if a < 63}
        back = 0 in near and not near & {1, 2, 3} and any(a > 3 for a in near)
        out.append(
            (k, as_of, sum(1 << a for a in near), len(near), len({a for a in near if a < 7}), 5 in near, min(near, default=None), longest(near), back)
        )
    return sorted(out, key=repr)


def read(bits):
    a = F.col("activity")
    return rows_of(
        bits.select(
            "k", "as_of", "activity", bh.active_periods(a), bh.active_periods(a, 7), bh.active_in(a, 5), bh.periods_since(a),
            bh.longest_run(a), bh.is_returning(a, 3),
        )
    )


def test_equals_the_set_of_periods(spark):
    rows = periods()
    assert read(bh.activity_bits(frame(spark, rows), "k", "p", AS_OF)) == expected(rows)


def test_steps_equal_the_whole(spark):
    rows = periods(2)
    facts = frame(spark, rows)
    bits = bh.activity_bits(facts, "k", "p", AS_OF - 3)
    for period in range(AS_OF - 2, AS_OF + 1):
        bits = bh.activity_step(bits, facts, "k", "p", period)
    assert read(bits) == expected(rows)
    with pytest.raises(Exception, match="no activity of period"):
        bh.activity_step(bits.limit(0), facts, "k", "p", AS_OF).collect()
    assert bh.activity_step(bits.limit(0), facts, "k", "p", AS_OF, first=True).count() > 0


def test_retention(spark):
    rows = {k: [p for p in ps if p > AS_OF - 63] for k, ps in periods(3).items()}
    got = bh.retention(bh.activity_bits(frame(spark, rows), "k", "p", AS_OF))
    table = {}
    for ps in rows.values():
        ps = [p for p in ps if p <= AS_OF]
        for n in range(AS_OF - min(ps) + 1) if ps else ():
            total, back = table.get((min(ps), n), (0, 0))
            table[min(ps), n] = (total + 1, back + (min(ps) + n in ps))
    assert rows_of(got, "cohort", "n", "entities", "returned") == sorted(((*k, *v) for k, v in table.items()), key=repr)


def test_a_busy_entity_is_reduced_before_the_exchange(spark, no_broadcast):  # noqa: F811
    facts = spark.range(100_000).select(F.lit("hot").alias("k"), (F.col("id") % 60).cast("int").alias("p"))
    bits = bh.activity_bits(facts, "k", "p", 59)
    assert plan(bits).count("partial_bit_or") == 1 and plan(bits).count("Exchange") == 1
    assert read(bits)[0][:4] == ("hot", 59, (1 << 60) - 1, 60)


def test_windows_that_are_refused():
    for n in (0, 64):
        with pytest.raises(ValueError):
            bh.active_periods(F.lit(1), n)

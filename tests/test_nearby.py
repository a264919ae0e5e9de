import random
from datetime import timedelta

from footfall.operators import nearby
from footfall.sources.holidays import holiday_table

from .conftest import at, day


def test_holiday_list(spark):
    days = [r[0] for r in holiday_table(spark).collect()]
    assert (len(days), len(set(days)), min(days), max(days)) == (140, 140, day("2018-01-01"), day("2030-12-25"))


def test_distance_and_default(spark, rows):
    days = spark.createDataFrame([(day(d),) for d in ("2026-05-25", "2026-04-25", "2026-04-24")], "d date")
    holidays = holiday_table(spark, [day("2026-05-25"), day("2026-12-25")])
    assert rows(nearby.with_holiday_distance(days, "d", holidays)) == [
        (day("2026-04-24"), 0, 60), (day("2026-04-25"), 0, 30), (day("2026-05-25"), 1, 0),
    ]


SPANS = {"email30": ("email", 30), "sms7": ("sms", 7), "all30": (None, 30)}


def counts(spark, spine, sent):
    spine = spark.createDataFrame(spine, "k string, d date")
    email = spark.createDataFrame([(k, t) for k, t, c in sent if c == "email"], "k string, t timestamp_ntz")
    sms = spark.createDataFrame([(k, t) for k, t, c in sent if c == "sms"], "k string, t timestamp_ntz")
    messages = nearby.daily_counts(email, ["k"], "t", "email").unionByName(nearby.daily_counts(sms, ["k"], "t", "sms"))
    return nearby.trailing_counts_by_window(spine, messages, "k", "d", SPANS)


def test_span_edges(spark, rows):
    target = day("2026-04-20")
    for back, expected in ((0, (0, 0, 0)), (1, (1, 1, 2)), (7, (1, 1, 2)), (8, (1, 0, 2)), (30, (1, 0, 2)), (31, (0, 0, 0))):
        time = at("2026-04-20 12:00") - timedelta(days=back)
        result = counts(spark, [("L", target)], [("L", time, "email"), ("L", time, "sms"), (None, time, "sms")])
        assert rows(result, *SPANS) == [expected], back


def test_window_equals_brute_force(spark, rows):
    rng = random.Random(1)
    key = lambda: "hot" if rng.random() < 0.4 else rng.choice("abc")
    spine = [(key(), day("2026-01-01") + timedelta(rng.randrange(90))) for _ in range(120)]
    sent = [(key(), at("2026-01-01 03:00") + timedelta(rng.randrange(90)), rng.choice(["email", "sms"])) for _ in range(400)]
    expected = []
    for k, d in set(spine):
        ages = [((d - t.date()).days, c) for kk, t, c in sent if kk == k]
        expected.append((
            k, d, sum(1 <= a <= 30 and c == "email" for a, c in ages),
            sum(1 <= a <= 7 and c == "sms" for a, c in ages), sum(1 <= a <= 30 for a, _ in ages),
        ))
    assert rows(counts(spark, spine, sent)) == sorted(expected, key=repr)

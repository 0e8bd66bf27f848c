"""Hot keys, ties and quantiles against brute force."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.operators import events, panel, profile, viscosity
from caseflow.operators.quantiles import grouped_quantiles, quantiles_of_counts, value_counts, wanted_stretches
from caseflow.operators.ranges import PART, carried_maximum, ranged
from caseflow.operators.skew import DEFAULT_RULE, HotKeyRule, hot_keys, previous_time, sized, stretches_of

START = datetime(2024, 1, 1)
SPLIT = HotKeyRule(share=0.01, floor=10)  # splits almost every key


def history(seed=1, rows=900, keys=6, clock=400):
    """A third of the rows on one key, many equal times."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
        out.append((key, START + timedelta(minutes=rng.randrange(clock)), i, rng.choice("CJX")))
    return out


def frame_of(spark, rows):
    return spark.createDataFrame(
        rows, "processo string, movimento_data_hora timestamp, seq int, codigo string").repartition(4)


def brute_previous(rows, wanted):
    last, out = {}, {}
    for key, when, seq, code in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        out[seq] = last.get(key)
        if wanted(code):
            last[key] = when
    return out


@pytest.mark.parametrize("rule", [DEFAULT_RULE, SPLIT], ids=["whole", "sliced"])
@pytest.mark.parametrize("seed, clock", [(1, 400), (2, 5), (3, 1), (4, 100000)])
def test_previous_time(spark, rule, seed, clock):
    rows = history(seed, clock=clock)
    frame = frame_of(spark, rows)
    got = previous_time(frame, "processo", "movimento_data_hora", [F.col("seq")], "prev",
                        when=F.col("codigo") == "C", rule=rule)
    assert {r.seq: r.prev for r in got.collect()} == brute_previous(rows, lambda c: c == "C")


def test_null_keys_are_split_like_others(spark):
    rows = [(None if key == "hot" else key, *rest) for key, *rest in history()]
    frame = frame_of(spark, rows)
    got = previous_time(frame, "processo", "movimento_data_hora", [F.col("seq")], "prev", rule=SPLIT)
    named = [("hot" if key is None else key, *rest) for key, *rest in rows]
    assert {r.seq: r.prev for r in got.collect()} == brute_previous(named, lambda c: True)
    keys, parts = hot_keys(frame, "processo", SPLIT)
    assert keys.filter("_hot is null").count() == 1
    stretches = stretches_of(frame, "processo", "movimento_data_hora", [F.col("seq")], parts)
    largest = stretches.filter("processo is null").groupBy(PART).count().agg(F.max("count")).first()[0]
    assert largest < 60


def test_the_rule_really_splits(spark):
    frame = frame_of(spark, history())
    assert hot_keys(frame, "processo", DEFAULT_RULE) is None
    keys, parts = hot_keys(frame, "processo", SPLIT)
    assert keys.count() == 7 and parts >= 90


def test_one_key_and_one_time_spread_over_tasks(spark):
    rows = 100_000
    moves = spark.range(rows, numPartitions=8).select(
        F.lit("hot").alias("processo"), F.lit(START).alias("movimento_data_hora"), F.col("id").alias("seq"),
        F.when(F.col("id") == 0, "C").otherwise("J").alias("codigo"))
    rule = HotKeyRule(share=0.05, floor=10)
    keys, parts = hot_keys(moves, "processo", rule)
    assert parts == 20
    for ties in ([F.col("seq")], []):  # without a tie-breaker the rows are the same in every respect but still spread
        stretches = stretches_of(moves, "processo", "movimento_data_hora", ties, parts)
        assert stretches.groupBy(PART).count().agg(F.max("count")).first()[0] < 3 * rows / parts
    found = previous_time(moves, "processo", "movimento_data_hora", [F.col("seq")], "prev", when=F.col("codigo") == "C", rule=rule)
    assert found.filter(F.col("prev") == START).count() == rows - 1


def test_carry_skips_whole_stretches_and_other_keys(spark):
    rows = [(k, START + timedelta(minutes=i), i, "C" if (k, i) in ((None, 0), ("b", 3)) else "J")
            for k in (None, "a", "b", "c") for i in range(200)]
    stretches = ranged(frame_of(spark, rows), [F.col("processo"), F.col("movimento_data_hora")], 40)
    marked = F.when(F.col("codigo") == "C", F.col("movimento_data_hora"))
    carries = {(r[PART], r["_key"]): r["_carry"] for r in carried_maximum(stretches, "processo", marked).collect()}
    first = {r["_part"]: r for r in stretches.groupBy(PART).agg(F.min(F.struct("processo", "seq")).alias("f")).collect()}
    expected = {(p, r.f.processo): START + timedelta(minutes=0 if r.f.processo is None else 3) for p, r in first.items()
                if (r.f.processo is None and r.f.seq > 0) or (r.f.processo == "b" and r.f.seq > 3)}
    assert carries == expected and len(carries) > 10


def test_empty_ranges(spark):
    stretches = ranged(frame_of(spark, history()).limit(0), [F.col("processo")], 4)
    assert carried_maximum(stretches, "processo", F.col("seq")).count() == 0


def test_empty_input(spark):
    frame = frame_of(spark, history()).limit(0)
    assert previous_time(frame, "processo", "movimento_data_hora", [F.col("seq")], "p", rule=SPLIT).count() == 0


@pytest.mark.parametrize("rule", [DEFAULT_RULE, SPLIT], ids=["whole", "sliced"])
def test_every_decision_as_of(spark, rule):
    rows = history(7, clock=30)
    got = events.receipt_to_every_decision(
        frame_of(spark, rows), F.col("codigo") == "J", F.col("codigo") == "C", [F.col("seq")], rule)
    expected = {}
    for key, when, seq, code in rows:
        earlier = [w for k, w, _, c in rows if k == key and c == "C" and w <= when]
        if code == "J" and earlier:
            expected[seq] = max(earlier)
    assert {r.seq: r.data_recebimento for r in got.collect()} == expected


@pytest.mark.parametrize("rule", [DEFAULT_RULE, SPLIT], ids=["whole", "sliced"])
def test_judge_deltas_and_gaps(spark, rule):
    rows = history(9, clock=60)
    frame = frame_of(spark, rows)
    judge, conclusion = F.col("codigo") == "J", F.col("codigo") == "C"
    before = brute_previous([r for r in rows if r[3] in "CJ"], lambda c: c == "C")
    deltas = viscosity.judge_deltas(frame, [F.col("seq")], judge, conclusion, rule)
    assert {r.seq: r.data_conclusao for r in deltas.collect()} == {
        s: before[s] for _, _, s, c in rows if c == "J" and before[s]}
    anything = brute_previous(rows, lambda c: True)
    gaps = events.gap_to_previous(frame, [F.col("seq")], judge, rule)
    assert {r.seq: r.movimento_anterior for r in gaps.collect()} == {
        s: anything[s] for _, _, s, c in rows if c == "J" and anything[s]}


def test_latest_decision_as_of_follows_the_study(spark):
    def at(day):
        return START + timedelta(days=day)

    moves = spark.createDataFrame(
        [("a", "132", at(1)), ("a", "132", at(5)), ("a", "132", at(9)), ("a", "430", at(6)), ("a", "433", at(2)),
         ("b", "132", at(3)), ("b", "433", at(3)), ("c", "132", at(4)), ("c", "430", at(2))],
        "processo string, movimento_codigo string, movimento_data_hora timestamp")
    decisions = events.latest_decisions(moves, [])
    got = {r.processo: (r.status, r.data_recebimento, r.tempo_dias)
           for r in events.receipt_to_latest_decision(moves, decisions).collect()}
    assert got == {"a": ("Admitido", at(5), 1.0), "b": ("Não admitido", at(3), 0.0)}


def test_strictly_earlier_row_for_judge_time(spark):
    moves = spark.createDataFrame(
        [("a", START, 1, "J"), ("a", START, 2, "C"), ("a", START + timedelta(days=2), 3, "J")],
        "processo string, movimento_data_hora timestamp, seq int, codigo string")
    deltas = viscosity.judge_deltas(moves, [F.col("seq")], F.col("codigo") == "J", F.col("codigo") == "C")
    assert [(r.seq, r.delta_magistrado) for r in deltas.collect()] == [(3, 2.0)]


def test_last_status_puts_missing_times_last(spark):
    moves = spark.createDataFrame(
        [("a", "848", None), ("a", "1", START), ("b", "848", START)],
        "processo string, movimento_codigo string, movimento_data_hora timestamp")
    got = {r.processo: r.transito_status for r in events.last_status(moves, []).collect()}
    assert got == {"a": "com_transito", "b": "sem_transito"}


@pytest.mark.parametrize("limit", [1, 37, 10_000])
def test_bounded_extract(spark, limit):
    rows = history(5, rows=600, clock=5000)
    got = events.bounded_extract(frame_of(spark, rows), "processo", "movimento_data_hora", "seq", limit)
    expected = set()
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        expected |= {r[2] for r in mine[:limit]}
    assert {r.seq for r in got.collect()} == expected


@pytest.mark.parametrize("step", [1, 7, 100])
def test_resumed_extract_equals_one_run(spark, step):
    """Equal times cross the borders between runs; a new key and late rows appear on the way."""
    rows = history(5, rows=600, clock=20)
    frame = frame_of(spark, rows)
    state, seen = None, []
    for i in range(3):
        now = frame if i else frame.filter("processo <> 'k1'")
        taken, state = events.resumed_extract(now, "processo", "movimento_data_hora", "seq", state, step)
        seen += [(r.processo, r.seq) for r in taken.collect()]
    whole = {(r.processo, r.seq) for r in events.bounded_extract(
        frame, "processo", "movimento_data_hora", "seq", 3 * step).filter("processo <> 'k1'").collect()}
    late = {(r.processo, r.seq) for r in events.bounded_extract(
        frame, "processo", "movimento_data_hora", "seq", 2 * step).filter("processo = 'k1'").collect()}
    assert len(seen) == len(set(seen)) and set(seen) == whole | late
    assert state.count() == 7


def test_quantiles(spark):
    rng = np.random.default_rng(3)
    values = {"many": rng.exponential(30, 500), "ties": np.repeat([1.0, 2.0, 2.5], 7),
              "one": np.array([4.25]), "negative": -rng.random(40) * 5}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("many", None)]
    probs = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q90": 0.9, "q100": 1.0}
    frame = spark.createDataFrame(rows, "k string, v double").repartition(3)
    for got in grouped_quantiles(frame, ["k"], "v", probs).collect():
        for name, p in probs.items():
            assert got[name] == pytest.approx(np.quantile(values[got.k], p), abs=1e-9), (got.k, name)


def test_ranked_groups_stay_small_on_long_tails(spark):
    """One dense spot, a long tail and an outlier: bins of equal width would hold nearly all values."""
    rng = np.random.default_rng(11)
    values = np.concatenate([rng.normal(0, 1e-9, 20_000), rng.pareto(0.4, 5_000), [1e300, -1e300]])
    rows = [("a", float(v)) for v in values] + [("b", float(v)) for v in values[:40]]
    merge = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = value_counts(spark.createDataFrame(rows, "k string, v double").repartition(4), ["k"], "v")
        probs = {"q1": 0.25, "m": 0.5, "q3": 0.75}
        ranked = wanted_stretches(ranged(counts, [F.col("k"), F.col("_v")]), ["k"], probs)
        largest = ranked.groupBy("k", PART).count().agg(F.max("count")).first()[0]
        assert largest < 2 * len(rows) / 8  # of the eight stretches
        got = {r.k: r for r in quantiles_of_counts(counts, ["k"], probs).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    for key, mine in (("a", values), ("b", values[:40])):
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(mine, p), rel=1e-9, abs=1e-18), (key, name)


def test_quantiles_of_infinite_and_no_values(spark):
    frame = spark.createDataFrame([("a", float("inf"))] * 3 + [("a", 1.0), ("n", None)], "k string, v double")
    got = grouped_quantiles(frame, ["k"], "v", {"lo": 0.0, "hi": 1.0}).collect()
    assert [(r.k, r.lo, r.hi) for r in got] == [("a", 1.0, float("inf"))]
    assert grouped_quantiles(frame.limit(0), ["k"], "v", {"lo": 0.5}).count() == 0


def test_weighted_quantiles(spark):
    frame = spark.createDataFrame([("a", 1.0, 3.0), ("a", 2.0, 1.0), ("a", 9.0, 4.0)], "k string, v double, w double")
    got = grouped_quantiles(frame, ["k"], "v", {"m": 0.5, "q": 0.4}, weight="w").first()
    full = [1.0] * 3 + [2.0] + [9.0] * 4
    assert got.m == pytest.approx(np.quantile(full, 0.5)) and got.q == pytest.approx(np.quantile(full, 0.4))


def test_duration_stats_and_summary(spark):
    rng = np.random.default_rng(5)
    days = rng.gamma(2, 40, 300)
    frame = spark.createDataFrame([(f"m{i % 3}", float(d)) for i, d in enumerate(days)], "mes string, tempo_dias double")
    for got in panel.duration_stats(frame, ["mes"]).collect():
        mine = days[int(got.mes[1])::3]
        assert (got.n, got.media_dias, got.mediana_dias, got.p90) == (
            100, pytest.approx(mine.mean()), pytest.approx(np.median(mine)), pytest.approx(np.quantile(mine, 0.9)))
    row = profile.column_summary(frame, ["tempo_dias"]).first()
    assert (row.minimo, row.q1, row.mediana, row.media, row.q3, row.maximo) == tuple(
        pytest.approx(x) for x in (days.min(), *np.quantile(days, [0.25, 0.5]), days.mean(), np.quantile(days, 0.75), days.max()))


def test_sized_lookup_is_broadcast_only_when_small(spark):
    facts = spark.range(50).withColumn("k", F.col("id") % 5)
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    expected = {(i, (i % 5) * 2) for i in range(50)}
    for limit, hinted in ((65, True), (64, False)):  # five rows of 13 bytes
        joined = facts.join(sized(lookup, limit), "k", "left")
        assert {(r.id, r.v) for r in joined.collect()} == expected
        assert ("strategy=broadcast" in joined._jdf.queryExecution().analyzed().toString()) == hinted

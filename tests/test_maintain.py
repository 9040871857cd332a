"""Results across runs, and exact forms with bounded memory."""

import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter import config as C
from blotter.operators import dims as D
from blotter.operators import exact as X
from blotter.operators import marts as M
from blotter.operators.fact import fact_incidents, star_view
from blotter.operators.silver import silver as silver_op
from blotter.plans.pipeline import bronze_from_fixture
from blotter.sources.fixture import incidents
from blotter.sources.tables import Layout, materialize, read_table
from blotter.streaming import grain, late, refresh

from conftest import SF001

STAMPS = ["bronze_load_datetime", "silver_processed_datetime", "gold_processed_datetime", "created_date"]


def rows_of(df, drop=()):
    cols = sorted(c for c in df.columns if c not in drop)
    return Counter(map(tuple, df.select(*cols).collect()))


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    materialize(silver_op(bronze_from_fixture(spark, SF001)), path + "/t")
    return read_table(spark, path + "/t")


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_late_members_end_at_the_batch_fact(spark, silver, scratch):
    layout = Layout(scratch)
    dims = D.build_dims(spark, silver)
    early = {**dims, "dim_location": dims["dim_location"].filter("area <> 5"), "dim_status": dims["dim_status"].filter("status <> 'IC'"),
             "dim_victim_demographics": dims["dim_victim_demographics"].filter("vict_sex is not null")}
    late.append_facts(silver, early, layout, 1)
    assert late.maintained_fact(spark, layout).filter("location_key is null").count() > 0
    before = files(layout.path(late.FACT))
    # One day's location members: only the months of their facts are written again.
    day = silver.filter("area = 5").select("rpt_dist_no").first()[0]
    one = dims["dim_location"].filter((F.col("area") == 5) & (F.col("rpt_dist_no") == day))
    got = late.rekey_late(spark, layout, {"dim_location": one})
    rows = silver.filter((F.col("area") == 5) & (F.col("rpt_dist_no") == day))
    months = rows.select(F.date_format("date_occ", "yyyyMM")).distinct().count()
    assert got["rows"] == rows.count() and got["partitions"] == months
    after = files(layout.path(late.FACT))
    kept = {d.split("/run=")[0] for d in before if d in after}
    assert len({d.split("/run=")[0] for d in before}) - len(kept) == months
    # The rest, in two steps; what has come before changes nothing.
    late.rekey_late(spark, layout, {"dim_location": dims["dim_location"], "dim_status": dims["dim_status"].filter("false")})
    got = late.rekey_late(spark, layout, {"dim_status": dims["dim_status"], "dim_victim_demographics": dims["dim_victim_demographics"]})
    # Times that no member will ever have (25:75) go on waiting.
    never = fact_incidents(silver, dims).filter("time_occurred_key is null").count()
    assert got["waiting"] == never > 0
    assert late.rekey_late(spark, layout, dims) == {"rows": 0, "partitions": 0, "waiting": never}
    assert rows_of(late.maintained_fact(spark, layout), STAMPS) == rows_of(fact_incidents(silver, dims), STAMPS)
    # A run that is written again, after a failure, leaves the same rows.
    late.append_facts(silver, dims, layout, 1)
    assert rows_of(late.maintained_fact(spark, layout), STAMPS) == rows_of(fact_incidents(silver, dims), STAMPS)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_runs_settles_alike(spark, scratch, seed):
    rng = random.Random(seed)
    names = [None, "a", "b", "c", "A"]
    rows = [(rng.randrange(4) or None, rng.choice([None, 1, 2]), rng.choice(names)) for _ in range(120)]
    df = spark.createDataFrame(rows, "area int, rpt_dist_no int, area_name string")
    want = rows_of(D.dim_location(df), STAMPS)
    order = list(range(4))
    rng.shuffle(order)
    part = {i: [r for k, r in enumerate(rows) if k * 7 % 4 == i] for i in order}
    layout = Layout(scratch)
    for i in order + order[:2]:                       # two runs come again
        late.settle_members(spark.createDataFrame(part[i], df.schema), "dim_location", layout, i)
    assert rows_of(late.settled_dimension(spark, layout, "dim_location"), STAMPS) == want


def test_grain_is_kept_across_runs(spark, scratch):
    layout = Layout(scratch)
    base = incidents(spark, SF001)
    first = base.filter("dr_no is not null").limit(100).cache()
    hot = first.limit(1).select("*", F.explode(F.sequence(F.lit(0), F.lit(499))).alias("n")).drop("n")
    missing = base.filter("dr_no is null")
    got = grain.enforce_grain(first.unionByName(hot).unionByName(missing), layout, 0)
    none = missing.count()
    assert got == {"unique": 100 + none, "repeated": 500, "keys": 100}
    second = first.limit(30).withColumn("status", F.lit("X")).unionByName(first.limit(5).withColumn("dr_no", F.col("dr_no") + 10 ** 9))
    for _ in range(2):                                # the second time as after a failure
        got = grain.enforce_grain(second, layout, 1)
        assert got == {"unique": 105 + none, "repeated": 530, "keys": 105}
    held = read_table(spark, layout.path(grain.UNIQUE))
    assert held.filter("dr_no is not null").groupBy("dr_no").count().filter("count > 1").isEmpty() and held.filter("status = 'X'").isEmpty()
    assert {r.failed_rules for r in read_table(spark, layout.path(grain.REPEATED)).collect()} == {grain.RULE}


def test_grain_as_a_stream(spark, scratch):
    layout = Layout(f"{scratch}/t", f"{scratch}/c")
    rows = incidents(spark, SF001).filter("dr_no is not null")
    n = rows.count()
    rows.repartition(3).write.parquet(layout.path(C.BRONZE))
    rows.limit(50).write.mode("append").parquet(layout.path(C.BRONZE))
    for _ in range(2):
        grain.grain_flow(spark, layout, max_files_per_trigger=1).awaitTermination()
    assert read_table(spark, layout.path(grain.UNIQUE)).count() == n and read_table(spark, layout.path(grain.REPEATED)).count() == 50


@pytest.mark.parametrize("bins,most", [(2, 1), (8, 3), (4096, 100_000)])
def test_exact_quantiles(spark, bins, most):
    rng = random.Random(bins)
    cases = [[rng.gauss(0, 1e6) for _ in range(301)], [float(rng.choice([1, 1, 1, 2, 7])) for _ in range(100)], [5.0], [1e-300, 1e300, -1e300, 0.0],
             [float(i) for i in range(50)] + [1e9] * 40]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    for values in cases if bins > 2 else cases[1:]:
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double").repartition(3)
        got = {r.prob: r.value for r in X.exact_quantiles(df, "x", probs, bins, most).collect()}
        assert got == {p: pytest.approx(float(np.quantile(values, p)), rel=1e-12) for p in probs}
    assert X.exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]).first().value is None


@pytest.mark.parametrize("power,buckets", [(0.0, 64), (2.5, 64), (2.5, 1)])
def test_proven_top_k(spark, power, buckets):
    rng = random.Random(int(power))
    values = [int(1000 * rng.random() ** (1 + power)) for _ in range(6000)] + [None] * 50
    df = spark.createDataFrame([(v,) for v in values], "k long").repartition(4)
    count = Counter(v for v in values if v is not None)
    want = sorted(count.items(), key=lambda x: (-x[1], x[0]))[:12]
    assert [tuple(r) for r in X.proven_top_k(df, "k", 12, buckets, 64).collect()] == want
    assert len(X.proven_top_k(df.filter("k < 3"), "k", 12).collect()) == sum(v < 3 for v in count)
    assert X.proven_top_k(df.limit(0), "k", 3).count() == 0


def test_registered_keys_never_collide(spark, scratch):
    rng = random.Random(5)
    seen, kept = set(), {}
    for run in (1, 2, 2, 3):                          # the second run comes again
        rows = [(rng.randrange(60) or None, rng.choice("abc")) for _ in range(300)] if run != 2 or run not in kept else kept[run]
        kept[run] = rows
        df = spark.createDataFrame(rows, "a int, b string").repartition(5)
        got = {(r.a, r.b): r.key for r in X.register_keys(df, ["a", "b"], f"{scratch}/keys", run).collect()}
        seen |= set(rows)
        assert set(got) == seen and sorted(got.values()) == list(range(len(seen)))
        assert all(got[k] == v for k, v in kept.get("keys", {}).items())
        kept["keys"] = got


def test_grid_levels_roll_up(spark):
    rng = random.Random(3)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(90.0, 180.0), (-90.0, -180.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")
    got = {(r.level, r.cell): r.incidents for r in X.grid_levels(df, [0, 3, 12]).collect()}
    assert got[0, 0] == 302 and sum(n for (x, _), n in got.items() if x == 12) == 302
    up = Counter()
    for (x, c), n in got.items():
        if x == 12:
            up[c >> 18] += n
    assert up == {c: n for (x, c), n in got.items() if x == 3}


def test_marts_follow_late_keys_and_withdrawals(spark, silver, scratch):
    layout = Layout(scratch)
    dims = D.build_dims(spark, silver)
    early = {**dims, "dim_location": dims["dim_location"].filter("area % 3 <> 0"),
             "dim_weapon": dims["dim_weapon"].filter("weapon_used_cd <> 120"), "dim_status": dims["dim_status"].filter("status <> 'IC'")}

    def run(n):
        return read_table(spark, layout.path(late.FACT)).filter(F.col("run") == n)

    def same(fact):
        for name, (fn, roles) in M.MARTS.items():
            want = fn(star_view(fact, dims, roles))
            assert rows_of(refresh.refreshed_mart(spark, layout, name, dims)) == rows_of(want), name

    late.append_facts(silver.filter("dr_no % 3 <> 0"), early, layout, 1)
    refresh.write_delta(layout, 1, run(1))
    assert run(1).filter("location_key is null").count() > 0
    new = {k: late.new_members(dims[k], early[k], k) for k in ("dim_location", "dim_weapon", "dim_status")}
    # A failure after the delta, before anything else: the repeated call writes it anew.
    seen = []

    def breaks(removed, added):
        refresh.rekeyed_delta(layout, 1)(removed, added)
        seen.append((removed.count(), added.count(), removed.filter("location_key is null").count()))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        late.rekey_late(spark, layout, new, on_change=breaks)
    got = late.rekey_late(spark, layout, new, on_change=refresh.rekeyed_delta(layout, 1))
    assert seen[0][0] == seen[0][1] == got["rows"] > 0 and seen[0][2] > 0
    same(late.maintained_fact(spark, layout))
    late.append_facts(silver.filter("dr_no % 3 = 0"), dims, layout, 2)
    for _ in range(2):                                # the second time as after a failure
        refresh.write_delta(layout, 2, run(2))
    gone = run(1).filter("dr_no % 7 = 1")
    refresh.write_delta(layout, 1, removed=gone, change=refresh.WITHDRAWN)
    same(read_table(spark, layout.path(late.FACT)).filter("not (run = 1 and dr_no % 7 = 1)"))
    # All withdrawn: no group is left, totals are 0.
    for n in (1, 2):
        refresh.write_delta(layout, n, removed=run(n), change=refresh.WITHDRAWN)
    assert refresh.cube_state(spark, layout, "day").isEmpty()
    rate = refresh.refreshed_mart(spark, layout, "arrest_rate", dims).first()
    assert (rate.incidents, rate.arrests) == (0, 0)
    with pytest.raises(ValueError):
        refresh.write_delta(layout, 9)

"""The refresh from stored window state equals the refresh over all bars."""

import datetime as dt
import random
import re

import pytest
from helpers import D, actions, bar, bars, identifiers, utc
from pyspark.sql import functions as F

from vintagelake.operators import features
from vintagelake.operators.features import GOLD_COLUMNS
from vintagelake.plans import gold as gold_plan
from vintagelake.plans import gold_state

DAYS = [d for d in (D(2018, 6, 1) + dt.timedelta(days=i) for i in range(730)) if d.weekday() < 5]
BEFORE, BUILT = D(2020, 4, 1), D(2020, 4, 10)
TODAY = D(2020, 5, 4)  # emits April and May


def _close(d):
    return utc(d.year, d.month, d.day, 21)


def _lake(seed=7):
    """1 to 3: full histories; 4 begins in February; 6 begins in April. Security 5 has late bars alone, 7 ended."""
    rng = random.Random(seed)
    first = {1: DAYS[0], 2: DAYS[0], 3: DAYS[40], 4: D(2020, 2, 3), 6: D(2020, 4, 6), 7: DAYS[0]}
    rows = []
    for s, begin in first.items():
        level = 50.0 * s
        for i, d in enumerate(x for x in DAYS if x >= begin and (s != 7 or x < D(2019, 9, 1))):
            level *= 1 + rng.uniform(-0.03, 0.03)
            rows.append(bar(s, d, round(level, 4), _close(d), batch=1 + DAYS.index(d), volume=1000 + i))
    return rows


SPLITS = [
    (1, "SPLIT", D(2019, 3, 1), 1.0, 2.0, None), (2, "SPLIT", D(2020, 4, 21), 1.0, 4.0, None),
    (4, "SPLIT", D(2020, 4, 8), 1.0, 3.0, None), (4, "CASH_DIVIDEND", D(2020, 3, 9), None, None, 0.5),
]


def _night(spark, state, rows, splits, knowledge="own"):
    ids = identifiers(spark, [(s, f"T{s}", D(1900, 1, 1), None) for s in range(1, 7)])
    b, a = bars(spark, rows), actions(spark, splits)
    got = gold_state.nightly(state, b, a, ids, TODAY, knowledge=knowledge)
    want = gold_plan.refresh(b, a, ids, TODAY, months=[(2020, 4), (2020, 5)], knowledge=knowledge)
    assert got.columns == want.columns == GOLD_COLUMNS
    listed = [sorted(df.collect(), key=lambda r: (r.security_id, r.session_date)) for df in (got, want)]
    assert len(listed[0]) == len(listed[1]) > 80
    for x, y in zip(*listed):
        for c in GOLD_COLUMNS:
            expected = pytest.approx(y[c], rel=1e-9, abs=1e-12) if isinstance(y[c], float) else y[c]
            assert x[c] == expected, (c, x, y)
    return {r.security_id for r in gold_state.void_securities(state, b, a, TODAY).collect()}


@pytest.fixture(scope="module")
def state(spark, tmp_path_factory):
    known = [r for r in _lake() if r[2] <= BUILT]
    path = str(tmp_path_factory.mktemp("state") / "rows")
    gold_state.advance(None, bars(spark, known), actions(spark, SPLITS), BUILT, BEFORE).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("knowledge", ["own", "max_inputs"])
def test_stored_windows_are_enough(spark, state, knowledge):
    """No late rows: nothing is void, and a split after the boundary rescales what is stored."""
    assert _night(spark, state, _lake(), SPLITS, knowledge) == set()
    lengths = {r.security_id: len(r.tail) for r in state.collect()}
    assert lengths[1] == gold_state.TAIL and lengths[4] < 50 and 6 not in lengths


def test_late_rows_make_a_security_void(spark, state):
    """A bar known later, one stored later under an old knowledge time, a late split, and a history that arrives late."""
    rows = _lake() + [
        bar(1, D(2019, 8, 5), 77.0, utc(2020, 4, 20), batch=5),
        bar(2, D(2018, 7, 3), 88.0, _close(D(2018, 7, 3)), batch=900),
        *[bar(5, d, 10.0 + i, _close(d), batch=901) for i, d in enumerate(DAYS[380:])],
    ]
    late_split = (3, "SPLIT", D(2020, 1, 6), 2.0, 1.0, None, utc(2020, 4, 28))
    assert _night(spark, state, rows, SPLITS + [late_split]) == {1, 2, 3, 5}


def test_many_void_securities_are_joined(spark, state, monkeypatch):
    monkeypatch.setattr(gold_state, "FEW", 1)
    rows = _lake() + [bar(s, D(2019, 8, 5), 70.0 + s, utc(2020, 4, 20), batch=5) for s in (1, 2, 4)]
    assert _night(spark, state, rows, SPLITS) == {1, 2, 4}


def test_states_follow_each_other(spark, tmp_path):
    """Monthly steps, each with late rows of its own, end at the windows of one step over everything."""
    rows = _lake() + [bar(1, D(2019, 5, 6), 31.0, utc(2020, 1, 20), batch=3), bar(2, D(2020, 1, 2), 7.0, utc(2020, 3, 9), batch=4)]
    acts = actions(spark, SPLITS)
    step = None
    for i, (as_of, before) in enumerate([(D(2019, 1, 5), D(2019, 1, 1)), (D(2020, 2, 1), D(2020, 1, 15)), (BUILT, BEFORE)]):
        new = gold_state.advance(step, bars(spark, [r for r in rows if r[10].date() <= as_of]), acts, as_of, before)
        new.write.parquet(str(tmp_path / str(i)))
        step = spark.read.parquet(str(tmp_path / str(i)))
    whole = gold_state.advance(None, bars(spark, rows), acts, BUILT, BEFORE)
    a, b = ({r.security_id: r for r in df.collect()} for df in (step, whole))
    assert a.keys() == b.keys()
    for s, x in a.items():
        y = b[s]
        assert x.ema20 == pytest.approx(y.ema20, rel=1e-12) and x.splits == y.splits and x.upto_batch == y.upto_batch
        assert [(t.session_date, t.knowledge_time) for t in x.tail] == [(t.session_date, t.knowledge_time) for t in y.tail]
        assert [t.close for t in x.tail] == pytest.approx([t.close for t in y.tail], rel=1e-12)
    assert _night(spark, step, rows, SPLITS) == set()


def test_refused_uses(spark, state):
    b, a = bars(spark, _lake()), actions(spark, SPLITS)
    ids = identifiers(spark, [(1, "A", D(1900, 1, 1), None)])
    with pytest.raises(ValueError, match="ends inside"):
        gold_state.nightly(state, b, a, ids, D(2020, 3, 20), as_of=BUILT)
    with pytest.raises(ValueError, match="knows more"):
        gold_state.nightly(state, b, a, ids, TODAY, as_of=D(2020, 4, 9))
    with pytest.raises(ValueError, match="go back"):
        gold_state.advance(state, b, a, BUILT, D(2020, 3, 1))
    other = gold_state.advance(None, b, a, BUILT, D(2020, 3, 1))
    with pytest.raises(ValueError, match="several states"):
        gold_state.header(state.unionByName(other))


def test_empty_state_reads_everything(spark, state):
    assert _night(spark, state.where("false"), _lake(), SPLITS) == {1, 2, 3, 4, 6, 7}


def test_features_sort_rows_before_they_are_wide(spark):
    """Two sorts serve all windows, and neither carries a feature; a seeded run exchanges rows once."""
    kind = "security_id bigint, symbol string, session_date date, knowledge_time timestamp, close double, volume bigint"
    rows = [(s, "A", D(2000, 1, 1) + dt.timedelta(days=i), utc(2020, 1, 1), 10.0 + (i * 7 + s) % 13, 5) for s in (1, 2) for i in range(300)]
    df = spark.createDataFrame(rows, kind)
    seeded = df.withColumn("warm", F.col("volume") > 7).withColumn("ema_input", F.col("close"))
    plain, warm = features.gold(df), features.gold(seeded, seeded=True)
    for out in (plain, warm):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"- Sort ", plan)) == 2 and plan.count("Exchange ") == 1
        top = plan[: plan.index("- Sort ")]
        assert all(f" AS {c}" in top for c in ("return_1d", "sma20", "sma50", "roc20", "momentum_12_1", "ema20"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, warm.collect()))

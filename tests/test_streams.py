"""Streams against batch queries and plain loops, over restarts and late rows."""

import datetime
import json
import random

import pytest

from chainloom.operators import turns as TU
from chainloom.streaming import counting as ST
from chainloom.streaming import turns as TS


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(name)


def conversations(n, seed):
    r = random.Random(seed)
    out = []
    for c in range(n):
        plan = [f"t{r.randrange(4)}" for _ in range(r.randrange(4))]
        seq = [("plan", t) for t in plan] + [(r.choice(["use", "message", "message", "message", "turn", "look", "look", "ask", "answer"]), f"t{r.randrange(6)}") for _ in range(60)]
        out += [(c, i, e, t) for i, (e, t) in enumerate(seq)]
    return out


def loop(rows):
    out = []
    for c in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == c)
        planned = [t for _, _, e, t in mine if e == "plan"]
        n, used, asked, turn, messages = len(planned), set(), False, 0, 0
        max_turns, max_messages = n + 2, 4 * n + 4
        for _, seq, e, t in mine:
            if e == "use":
                used.add(t)
            elif e in ("ask", "answer"):
                asked = e == "ask"
            elif e == "turn":
                turn += 1
            elif e == "message":
                messages += 1
            elif e == "look":
                left = set(planned) - used
                status = "completing"
                if asked:
                    status = "in_progress"
                elif messages >= 5 * n + 6:
                    status = "done"
                elif left:
                    status = "in_progress"
                    max_messages += 4 if messages >= max_messages - 2 else 0
                    max_turns += 1 if turn >= max_turns - 1 else 0
                out.append((c, seq, status, max_messages, max_turns, len(used & set(planned)), len(left), len(used - set(planned))))
    return sorted(out)


def test_looks_equal_the_plain_loop(spark):
    rows = conversations(40, 1)
    got = sorted(map(tuple, TU.looks(spark.createDataFrame(rows, TU.EVENT).repartition(5)).collect()))
    assert got == loop(rows) and {r[2] for r in got} == {"in_progress", "completing", "done"}


def test_followed_turns_equal_the_plain_loop_over_restarts(rocks, tmp_path):
    rows = conversations(12, 2)
    places = [str(tmp_path / x) for x in ("in", "out", "state")]
    (tmp_path / "in").mkdir()
    start = datetime.datetime(2024, 1, 1)
    for k in range(4):  # each run takes up the state that the last one left; the last event comes days later
        batch = [(*r, (start + datetime.timedelta(minutes=r[1])).isoformat()) for r in rows if r[1] // 22 == k] if k < 3 else [(99, 0, "look", "", "2024-01-09T00:00:00")]
        with open(tmp_path / "in" / f"{k}.json", "w") as f:
            f.writelines(json.dumps(dict(zip(("conv_id", "seq", "event", "tool", "ts"), r))) + "\n" for r in batch)
        stream = TS.follow(rocks.readStream.schema(f"{TU.EVENT}, ts timestamp").json(places[0]))
        query = stream.writeStream.format("parquet").option("path", places[1]).option("checkpointLocation", places[2]).trigger(availableNow=True).start()
        query.awaitTermination(100)
        query.stop()
        assert not query.exception()
    got = [tuple(x) for x in rocks.read.parquet(places[1]).collect()]
    assert sorted(x for x in got if x[1] is not None and x[0] < 99) == loop(rows)
    assert {x[0] for x in got if x[1] is None} == {r[0] for r in rows}  # all others have ended by then


def test_counts_once_the_watermark_has_passed(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    r = random.Random(3)
    events = sorted((start + datetime.timedelta(seconds=r.randrange(36_000)), r.choice("ab")) for _ in range(400))
    late = (start + datetime.timedelta(seconds=5), "a")
    last = (start + datetime.timedelta(days=2), "z")
    batches = [events[:200], events[200:], [last], [late, (start + datetime.timedelta(days=2, hours=1), "z")]]
    for name, count in (("w", ST.windowed), ("s", ST.sessions)):
        places = [str(tmp_path / name / x) for x in ("in", "out", "state")]
        (tmp_path / name / "in").mkdir(parents=True)
        dropped = 0
        for k, rows in enumerate(batches):
            spark.createDataFrame(rows, "ts timestamp, key string").coalesce(1).write.mode("append").parquet(places[0])
            query = ST.append(count(spark.readStream.schema("ts timestamp, key string").parquet(places[0])), *places[1:])
            query.awaitTermination(180)
            dropped += ST.dropped(query)
        want = {tuple(x) for x in count(spark.createDataFrame(events, "ts timestamp, key string")).collect()}
        got = [tuple(x) for x in spark.read.parquet(places[1]).collect()]
        assert len(got) == len(set(got)) and set(got) == want and dropped == 1

"""Messages that fail come again, end once, and are neither lost nor doubled by restarts."""

from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchant_ledger.sources.messages import ACK, REJECT, REQUEUE
from merchant_ledger.streaming.redelivery import ATTEMPT, DEAD, Attempts, Redelivery

SCHEMA = "id bigint, value string"
GOOD = '{"mchNo":"M","totalAmount":1,"successAmount":1,"refundAmount":0,"cancelAmount":0,"netAmount":1,"updateTime":1}'


def value():
    return F.when(F.col("id") % 5 == 1, "[]").when(F.col("id") % 5 == 2, "no json").otherwise(GOOD)


@pytest.fixture
def place(spark, tmp_path):
    spark.range(40).select("id", value().alias("value")).coalesce(1).write.parquet(str(tmp_path / "in"))
    return tmp_path


def queue_of(spark, place, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    refused = (F.col("id") % 5 == 3) & (F.col(ATTEMPT) == 0)
    return Redelivery(spark, str(place / "out"), ["id"], schema, refused, **options)


def messages(spark, place):
    return spark.readStream.schema(SCHEMA).parquet(str(place / "in"))


def ends(queue):
    return Counter((o, r["id"], r[ATTEMPT]) for o in (ACK, REJECT, DEAD) for r in queue.table(o).collect())


def expected(n=40, attempts=3):
    kinds = {0: (ACK, 1), 1: (DEAD, attempts), 2: (REJECT, 1), 3: (ACK, 2), 4: (ACK, 1)}
    return Counter((kinds[i % 5][0], i, kinds[i % 5][1]) for i in range(n))


def test_each_message_ends_once(spark, place):
    queue = queue_of(spark, place)
    queue.run(messages(spark, place), str(place / "checkpoint"))
    assert ends(queue) == expected()
    left = spark.read.format("statestore").option("stateVarName", "failures").load(str(place / "checkpoint"))
    assert left.count() == 0
    # Nothing is offered again when all have ended.
    queue.run(messages(spark, place), str(place / "checkpoint"))
    assert ends(queue) == expected()


def test_restarts_lose_and_double_nothing(spark, place):
    class Fails(Redelivery):
        """Fails after it has written half of a batch's tables, once for each batch."""

        failed = set()

        def apply(self, batch, batch_id):
            if batch_id not in self.failed:
                self.failed.add(batch_id)
                batch.drop("outcome").write.mode("overwrite").parquet(self._path(ACK, batch_id))
                batch.drop("outcome").write.mode("overwrite").parquet(self._path(REQUEUE, batch_id))
                raise RuntimeError("lost")
            super().apply(batch, batch_id)

    schema = spark.createDataFrame([], SCHEMA).schema
    refused = (F.col("id") % 5 == 3) & (F.col(ATTEMPT) == 0)
    for _ in range(6):
        queue = Fails(spark, str(place / "out"), ["id"], schema, refused)
        try:
            queue.start(messages(spark, place), str(place / "checkpoint"), {"availableNow": True}).awaitTermination()
        except Exception as error:
            assert "lost" in str(error)
    assert len(Fails.failed) >= 3
    assert ends(queue) == expected()


def test_more_messages_and_one_attempt(spark, place):
    queue = queue_of(spark, place, attempts=1)
    queue.run(messages(spark, place), str(place / "checkpoint"))
    dead = {r["id"] for r in queue.table(DEAD).collect()}
    assert dead == {i for i in range(40) if i % 5 in (1, 3)}
    spark.range(40, 45).select("id", value().alias("value")).write.mode("append").parquet(str(place / "in"))
    queue.run(messages(spark, place), str(place / "checkpoint"))
    assert {i for _, i, _ in ends(queue)} == set(range(45)) and sum(ends(queue).values()) == 45


class Kept(dict):
    """A map state that counts its calls."""

    calls = 0

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]


def test_calls_to_the_state_do_not_grow_with_the_messages():
    kept, kinds = Kept(), T.StructType().add("id", "long")
    handle = type("Handle", (), {"getMapState": lambda self, name, keys, values: kept})()
    attempts = Attempts(["id"], kinds, ["id", "outcome", ATTEMPT], 3)
    attempts.init(handle)
    numbers = range(6000)
    for offer in range(3):
        frames = [
            pd.DataFrame({"id": part, "outcome": REQUEUE, ATTEMPT: offer, "bucket": [i % 8 for i in part]})
            for part in (numbers[:2000], numbers[2000:])
        ]
        out = pd.concat(attempts.handleInputRows((0,), iter(frames), None))
        assert out["id"].tolist() == [*numbers] and set(out[ATTEMPT]) == {offer + 1}
        assert set(out["outcome"]) == {DEAD if offer == 2 else REQUEUE}
    assert kept.calls <= 3 * 2 * 8 and not kept
    # Of one key that comes twice, each offer counts.
    twice = pd.DataFrame({"id": [1, 1, 2], "outcome": REQUEUE, ATTEMPT: 0, "bucket": [1, 1, 1]})
    assert pd.concat(attempts.handleInputRows((0,), iter([twice]), None))[ATTEMPT].tolist() == [1, 2, 1]
    ended = pd.DataFrame({"id": [1, 2], "outcome": [REQUEUE, ACK], ATTEMPT: [1, 1], "bucket": [1, 1]})
    out = pd.concat(attempts.handleInputRows((0,), iter([ended]), None))
    assert out["outcome"].tolist() == [DEAD, ACK] and out[ATTEMPT].tolist() == [3, 2] and not kept

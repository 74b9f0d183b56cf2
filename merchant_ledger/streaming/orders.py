"""Order state in a stream: from change events to the amounts they add."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from merchant_ledger.operators.sequence import slice_of, with_positions
from merchant_ledger.schemas import (
    CANCELLED,
    DELTAS,
    MERCHANT,
    ORDER,
    REFUNDED,
    SUCCESS,
    struct,
)

# Executors get this module's code with the task; it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What is kept per merchant and order. Unless a time to live is asked for, it is never removed:
# without the last state, the next change would be taken for the first one.
ORDER_KEY = struct(**{MERCHANT: "string", ORDER: "string"})
ORDER_STATE = struct(state="integer", amount="long")

CODES = dict(zip(DELTAS, (SUCCESS, REFUNDED, CANCELLED)))


# Of a row in its slice of a micro-batch: whether it is the order's first or last there.
FIRST, LAST = 1, 2
PREVIOUS = {"prev_state": "integer", "prev_amount": "long", "edge": "integer"}


def order_deltas(
    changes: DataFrame,
    seq: Sequence[str],
    shards: int,
    slice_width: int | None = None,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Streaming form of ``transitions.with_deltas``; other columns pass through.

    Orders are spread over ``shards`` groups by merchant *and order*, so a merchant with a
    third of all rows is spread too. Each group is one call with all its orders, as calls
    are dear and rows are not. Rows that need no state (those of the snapshot) are spread by sequence.
    ``shards`` belongs to the checkpoint: it must stay the same when the query restarts.

    With ``slice_width`` a single order may have most rows of a micro-batch: its rows are
    dealt into ranges of the sequence first, and find the row before them there. The state
    then sees an order's first and last row of each range only. The width, in seconds or
    positions, may be another one after a restart; results never depend on it. ``ttl_ms``
    is part of the checkpoint, like the shards.
    """
    output = changes.drop("state", "amount").schema
    for delta in DELTAS:
        output = output.add(delta, "long")
    changes = with_positions(changes, seq)
    # A null amount only occurs in states that move no money.
    changes = changes.withColumn("amount", F.coalesce("amount", F.lit(0)))
    needs_no_state = F.col("is_snapshot")
    if slice_width is not None:
        changes = in_slices(changes, seq, slice_width, shards)
        needs_no_state = needs_no_state | (F.col("edge") == 0)
    spread = F.when(needs_no_state, F.xxhash64(*seq)).otherwise(F.xxhash64(MERCHANT, ORDER))
    return (
        changes.withColumn("shard", F.pmod(spread, F.lit(shards)))
        .groupBy("shard")
        .transformWithStateInPandas(
            OrderTransitions(list(seq), output.names, ttl_ms),
            output,
            outputMode="append",
            timeMode="ProcessingTime" if ttl_ms else "none",
        )
    )


def in_slices(changes: DataFrame, seq: Sequence[str], width: int, partitions: int) -> DataFrame:
    """Adds to every row of a micro-batch the state and amount of the order's row before it in
    its range of the sequence, and to the first and last of a range the mark that they are.

    An order's rows of one range meet in one task, those of many ranges in many: no task
    gets more than its share of a hot order. Works on batch and streaming frames alike.
    """
    schema = changes.schema
    for name, kind in PREVIOUS.items():
        schema = schema.add(name, kind)
    dealt = changes.withColumn("slice", slice_of(changes, seq, width)).repartition(partitions, MERCHANT, ORDER, "slice")
    seq, names = list(seq), schema.names

    def marked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [frame for frame in frames if len(frame)]
        if not frames:
            return
        rows = pd.concat(frames, ignore_index=True)
        state, amount = np.full(len(rows), -1), np.zeros(len(rows), np.int64)
        edge = np.zeros(len(rows), np.int64)
        of_log = rows[~rows["is_snapshot"].astype(bool)].sort_values(seq, kind="stable")
        if len(of_log):
            group = of_log.groupby([MERCHANT, ORDER, "slice"], sort=False, dropna=False).ngroup().to_numpy()
            by_group = np.argsort(group, kind="stable")
            at = of_log.index.to_numpy()[by_group]
            first = np.diff(group[by_group], prepend=-1) != 0
            edge[at] = FIRST * first + LAST * np.roll(first, -1)
            later, before = at[~first], at[np.roll(~first, -1)]
            state[later] = rows["state"].to_numpy()[before]
            amount[later] = rows["amount"].to_numpy()[before]
        yield rows.assign(prev_state=state, prev_amount=amount, edge=edge)[names]

    return dealt.mapInPandas(marked, schema)


class OrderTransitions(StatefulProcessor):
    """Rows are ordered by ``seq`` within a micro-batch; a row that arrives in a later one
    is applied on arrival. The rate limit of the source bounds the rows of a call."""

    def __init__(self, seq: list[str], output: list[str], ttl_ms: int | None = None):
        self.seq, self.output, self.ttl_ms = seq, output, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.orders = handle.getMapState("orders", ORDER_KEY, ORDER_STATE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        events = pd.concat(list(rows), ignore_index=True)
        state, amount = events["state"].to_numpy(), events["amount"].to_numpy()
        deltas = {name: _bucket(code, state, amount) for name, code in CODES.items()}

        changes = events[~events["is_snapshot"].astype(bool)]
        if "edge" in events:
            edge = events["edge"].to_numpy()
            known = edge == LAST  # and, without an edge, what the state needn't see
            known |= (edge == 0) & ~events["is_snapshot"].to_numpy().astype(bool)
            before = events["prev_state"].to_numpy(), events["prev_amount"].to_numpy()
            from_slice = {name: deltas[name] - _bucket(code, *before) for name, code in CODES.items()}
            changes = changes[changes["edge"] > 0]
        if len(changes):
            changes = changes.sort_values(self.seq, kind="stable")
            orders = changes.groupby([MERCHANT, ORDER], sort=False, dropna=False).ngroup()
            # Row positions, order by order and in sequence within each.
            at = changes.index.to_numpy()[np.argsort(orders.to_numpy(), kind="stable")]
            number = np.sort(orders.to_numpy())
            first = np.diff(number, prepend=-1) > 0
            last = np.roll(first, -1)
            keys = self._keys(events, at[first])
            kept = [self.orders.getValue(key) for key in keys]
            for name, code in CODES.items():
                deltas[name][at] = _differences(code, deltas[name][at], first, kept)
            states = zip(state[at[last]].tolist(), amount[at[last]].tolist())
            for key, new in zip(keys, states):
                self.orders.updateValue(key, new)

        if "edge" in events:
            deltas = {name: np.where(known, from_slice[name], deltas[name]) for name in CODES}
        yield events.assign(**deltas)[self.output]

    @staticmethod
    def _keys(events: pd.DataFrame, at: np.ndarray) -> list[tuple]:
        names = events[[MERCHANT, ORDER]].iloc[at]
        return list(zip(*[names[name].astype(object).where(names[name].notna(), None) for name in names]))

    def close(self) -> None: ...


def _bucket(code: int, state: np.ndarray, amount: np.ndarray) -> np.ndarray:
    return np.where(state == code, amount, 0)


def _differences(code: int, new: np.ndarray, first: np.ndarray, kept: list) -> np.ndarray:
    """Each bucket less the one before it. Before the first row of an order comes its kept
    state; an order without one counts as a success only."""
    old = np.roll(new, 1)
    at_first = new[first]
    old[first] = [
        (0 if code == SUCCESS else unseen) if state is None else (state[1] if state[0] == code else 0)
        for state, unseen in zip(kept, at_first)
    ]
    return new - old

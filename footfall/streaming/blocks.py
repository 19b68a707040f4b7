"""Many small keys of a stateful operator kept as one.

A Python operator talks to the state store by messages, several for each key and each entry of a map.
Where keys are many and small (a detection, a visit, a track) these messages are most of the work.
``in_blocks`` groups rows by a coarser *block* of keys. A block's state is one value that is read once
and written once in a micro-batch; within it the operator runs key by key, on states in memory, as it
would on its own keys.

A block is read and written as a whole, so it has to be bounded whatever the data: a stretch of frames
or of time, a few tracks. Keys that are forgotten leave the block; an empty block leaves the store.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from footfall.session import SETTINGS, carry_to_workers

carry_to_workers(__name__)

BLOCK = "_block"
TIMERS = ""  # the place of a key's timers among its state variables


class _Variable:
    """A state variable of the key at hand; ``of`` are all variables of that key by name."""

    def __init__(self, name: str):
        self.name, self.of = name, {}

    def exists(self) -> bool:
        return self.name in self.of

    def clear(self) -> None:
        self.of.pop(self.name, None)


class _Value(_Variable):
    def get(self) -> tuple | None:
        return self.of.get(self.name)

    def update(self, value: tuple) -> None:
        self.of[self.name] = tuple(value)


class _List(_Variable):
    def get(self) -> Iterator[tuple]:
        return iter(self.of.get(self.name, ()))

    def put(self, values: list[tuple]) -> None:
        self.of[self.name] = list(values)

    def appendList(self, values: list[tuple]) -> None:
        self.of.setdefault(self.name, []).extend(values)


class _Map(_Variable):
    def containsKey(self, key: tuple) -> bool:
        return key in self.of.get(self.name, ())

    def getValue(self, key: tuple) -> tuple | None:
        return self.of.get(self.name, {}).get(key)

    def updateValue(self, key: tuple, value: tuple) -> None:
        self.of.setdefault(self.name, {})[key] = tuple(value)

    def removeKey(self, key: tuple) -> None:
        held = self.of.get(self.name, {})
        held.pop(key, None)
        if not held:
            self.clear()

    def keys(self) -> Iterator[tuple]:
        return iter(list(self.of.get(self.name, ())))

    def values(self) -> Iterator[tuple]:
        return iter(list(self.of.get(self.name, {}).values()))


class _KeyHandle:
    """What an operator gets for the engine's handle: variables and timers of the key at hand."""

    def __init__(self):
        self.variables: list[_Variable] = []
        self.of: dict = {}

    def _variable(self, variable: _Variable) -> _Variable:
        self.variables.append(variable)
        return variable

    def getValueState(self, name: str, schema) -> _Value:
        return self._variable(_Value(name))

    def getListState(self, name: str, schema) -> _List:
        return self._variable(_List(name))

    def getMapState(self, name: str, key_schema, value_schema) -> _Map:
        return self._variable(_Map(name))

    def registerTimer(self, at: int) -> None:
        self.of.setdefault(TIMERS, set()).add(at)

    def deleteTimer(self, at: int) -> None:
        timers = self.of.get(TIMERS, set())
        timers.discard(at)
        if not timers:
            self.of.pop(TIMERS, None)

    def listTimers(self) -> Iterator[int]:
        return iter(sorted(self.of.get(TIMERS, ())))

    def turn_to(self, of: dict) -> None:
        self.of = of
        for variable in self.variables:
            variable.of = of


class Blocks(StatefulProcessor):
    """Runs ``inner`` for each key (the columns ``key``) of a block. The block has one timer in the store, at the
    earliest one of its keys."""

    def __init__(self, inner: StatefulProcessor, key: list[str]):
        self.inner, self.key = inner, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.block = handle.getValueState("block", "due bigint, keys binary")
        self.own = _KeyHandle()
        self.inner.init(self.own)

    def _load(self) -> tuple[int | None, dict[tuple, dict]]:
        held = self.block.get()
        return (None, {}) if held is None else (held[0], pickle.loads(bytes(held[1])))

    def _save(self, due: int | None, keys: dict[tuple, dict]) -> None:
        """Stores the block; ``due`` is the timer that stands in the store."""
        earliest = min((t for of in keys.values() for t in of.get(TIMERS, ())), default=None)
        if earliest != due:
            if due is not None:
                self.handle.deleteTimer(due)
            if earliest is not None:
                self.handle.registerTimer(earliest)
        if keys:
            self.block.update((earliest, pickle.dumps(keys, pickle.HIGHEST_PROTOCOL)))
        else:
            self.block.clear()

    def _turn(self, keys: dict[tuple, dict], key: tuple, rows: Iterable[Row]) -> Iterator[Row]:
        yield from rows
        if not keys[key]:
            del keys[key]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        groups: dict[tuple, list[Row]] = {}
        places = None
        for row in rows:
            if places is None:
                at = [row.__fields__.index(c) for c in self.key]
                places = itemgetter(*at) if len(at) > 1 else lambda r: (r[at[0]],)
            groups.setdefault(places(row), []).append(row)
        due, keys = self._load()
        while groups:
            own, members = groups.popitem()
            self.own.turn_to(keys.setdefault(own, {}))
            yield from self._turn(keys, own, self.inner.handleInputRows(own, iter(members), timerValues))
        self._save(due, keys)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, keys = self._load()
        end = max(expiredTimerInfo.getExpiryTimeInMs() + 1, timerValues.getCurrentWatermarkInMs())
        for own in [k for k, of in keys.items() if min(of.get(TIMERS, (end,))) < end]:
            self.own.turn_to(keys[own])
            for at in [t for t in self.own.listTimers() if t < end]:
                self.own.deleteTimer(at)
            yield from self._turn(keys, own, self.inner.handleExpiredTimer(own, timerValues, expiredTimerInfo))
        self._save(None, keys)  # the engine removes the timer that has fired

    def close(self) -> None:
        self.inner.close()


def in_blocks(rows: DataFrame, block: list[str], part: Column, key: list[str], processor: StatefulProcessor,
              schema: StructType, **how) -> DataFrame:
    """``transformWithState`` of ``processor`` over ``key``. The keys with like columns ``block`` and the same
    ``part`` are kept together; all rows of a key must lie in one block. Rows come with a column ``BLOCK``."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    rows.sparkSession.conf.set(provider, SETTINGS[provider])
    return rows.withColumn(BLOCK, part).groupBy(*block, BLOCK).transformWithState(
        Blocks(processor, key), schema, outputMode="append", **how)

"""The order of a record stream, checked in all its ranges at once.

A stream holds accounts by rising key, behind each its slots by rising key, and then, once at most, its code. A range of
the stream is a function from the state before it (whose account it is, that account's code, the last slot, whether the
code has been) to the state after it. What it does is known without the state but for the records before its first
account, of which the ends say all; so the function is one short row. Functions of neighbours compose to the function of
both, FAN at a time, until one is left, which is applied to the state of a beginning stream. The first fault of the
whole stream is found, where one pass would stop.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keccak import EMPTY_CODE

#: Ranges whose functions are composed in a task.
FAN = 512
ACCOUNT, SLOT, CODE = 1, 2, 3
#: Fixed texts of the faults.
OUT_OF_ORDER, NO_ACCOUNT = "accounts out of order", "a record before the first account"
OTHER_SLOT, SLOTS, SLOT_AFTER_CODE = "slot of another account", "slots out of order", "slot after its account's code"
OTHER_CODE, SECOND_CODE, UNKNOWN = "code of another account", "a second code of an account", "unknown record type"


@dataclass
class State:
    """Whose records come; owner is None before the first account."""

    owner: bytes | None = None
    code: bytes | None = None
    slot: bytes | None = None
    done: bool = False


@dataclass
class Function:
    """What a range does. slots_of to code_at: of its records before its first account; first: that account's key; owner to done: the state at its end, if it has an account; fault: the first within."""

    slots_of: bytes | None = None
    low: bytes | None = None
    high: bytes | None = None
    slots_at: int | None = None
    code_is: bytes | None = None
    code_at: int | None = None
    first: bytes | None = None
    first_at: int | None = None
    owner: bytes | None = None
    code: bytes | None = None
    slot: bytes | None = None
    done: bool = False
    fault: str | None = None
    fault_at: int | None = None

    def blame(self, fault: str, at: int) -> None:
        if self.fault_at is None or at < self.fault_at:
            self.fault, self.fault_at = fault, at

    @property
    def state(self) -> State:
        return State(self.owner, self.code, self.slot, self.done)

    def record(self, at: int, kind: int, key: bytes, sub: bytes | None, code: bytes | None) -> None:
        """One record more. code: of an account, the digest of its code."""
        if kind == ACCOUNT:
            if self.first is None:
                self.first, self.first_at = key, at
            elif key <= self.owner:
                self.blame(OUT_OF_ORDER, at)
            self.owner, self.code, self.slot, self.done = key, code, None, False
        elif kind == SLOT:
            if self.first is not None:
                if self.done or key != self.owner or (self.slot is not None and sub <= self.slot):
                    self.blame(SLOT_AFTER_CODE if self.done else OTHER_SLOT if key != self.owner else SLOTS, at)
                self.slot = sub
            elif self.code_at is not None:
                self.blame(SLOT_AFTER_CODE, at)
            elif self.slots_at is None:
                self.slots_of, self.low, self.high, self.slots_at = key, sub, sub, at
            else:
                if key != self.slots_of or sub <= self.high:
                    self.blame(OTHER_SLOT if key != self.slots_of else SLOTS, at)
                self.high = sub
        elif kind == CODE:
            if self.first is not None:
                if self.done or key != self.code or key == EMPTY_CODE:
                    self.blame(SECOND_CODE if self.done else OTHER_CODE, at)
                self.done = True
            elif self.code_at is not None:
                self.blame(SECOND_CODE, at)
            else:
                self.code_is, self.code_at = key, at
        else:
            self.blame(UNKNOWN, at)

    def after(self, state: State) -> State:
        """The state after the range, if it is `state` before; faults that show only now are noted."""
        now = State(state.owner, state.code, state.slot, state.done)
        if self.slots_at is not None:
            if now.owner is None:
                self.blame(NO_ACCOUNT, self.slots_at)
            elif now.done or self.slots_of != now.owner or (now.slot is not None and self.low <= now.slot):
                self.blame(SLOT_AFTER_CODE if now.done else OTHER_SLOT if self.slots_of != now.owner else SLOTS, self.slots_at)
            now.slot = self.high
        if self.code_at is not None:
            if now.owner is None:
                self.blame(NO_ACCOUNT, self.code_at)
            elif now.done or self.code_is != now.code or self.code_is == EMPTY_CODE:
                self.blame(SECOND_CODE if now.done else OTHER_CODE, self.code_at)
            now.done = True
        if self.first is None:
            return now
        if now.owner is not None and self.first <= now.owner:
            self.blame(OUT_OF_ORDER, self.first_at)
        return self.state

    def then(self, later: Function) -> Function:
        """The function of this range and the one that follows it."""
        out = Function(*astuple(self))
        if self.first is not None:
            end = later.after(self.state)
            out.owner, out.code, out.slot, out.done = end.owner, end.code, end.slot, end.done
        else:
            if later.slots_at is not None:
                if self.code_at is not None:
                    out.blame(SLOT_AFTER_CODE, later.slots_at)
                elif self.slots_at is None:
                    out.slots_of, out.low, out.slots_at = later.slots_of, later.low, later.slots_at
                elif self.slots_of != later.slots_of or later.low <= self.high:
                    out.blame(OTHER_SLOT if self.slots_of != later.slots_of else SLOTS, later.slots_at)
                out.high = later.high
            if later.code_at is not None:
                if self.code_at is not None:
                    out.blame(SECOND_CODE, later.code_at)
                else:
                    out.code_is, out.code_at = later.code_is, later.code_at
            out.first, out.first_at, out.owner, out.code, out.slot, out.done = later.first, later.first_at, later.owner, later.code, later.slot, later.done
        if later.fault_at is not None:
            out.blame(later.fault, later.fault_at)
        return out


_KIND = {"bytes | None": ("binary", pa.binary()), "int | None": ("long", pa.int64()), "str | None": ("string", pa.string()), "bool": ("boolean", pa.bool_())}
_FIELDS = {name: _KIND[f.type] for name, f in Function.__dataclass_fields__.items()}
FUNCTION = "part long, " + ", ".join(f"{name} {kind}" for name, (kind, _) in _FIELDS.items())


def _row(part: int, f: Function) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"part": part} | dict(zip(_FIELDS, astuple(f), strict=True))], schema=pa.schema([("part", pa.int64()), *((n, t) for n, (_, t) in _FIELDS.items())]))


def _functions(batches):
    """Records (seq, type, account_hash, sub_hash, code) of a range, in order, to its function."""
    from pyspark import TaskContext

    f = None
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            f = f or Function()
            f.record(*row)
    if f:
        yield _row(TaskContext.get().partitionId(), f)


def _composed(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    part, f = rows[0].pop("part") // FAN, None
    for r in rows:
        r.pop("part", None)
        f = Function(**r) if f is None else f.then(Function(**r))
    return pa.Table.from_batches([_row(part, f)])


def _begun(batches):
    """The function of a whole stream to its first fault, if it has one."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            r.pop("part")
            f = Function(**r)
            f.after(State())
            if f.fault:
                out.append({"fault": f.fault, "at": f.fault_at})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("fault", pa.string()), ("at", pa.int64())]))


def first_fault(records: DataFrame, ranges: int | None = None) -> DataFrame:
    """fault, at: the first record that may not stand where it stands, by seq; no row if all may.

    records: seq (rising, and unique), type (1 account, 2 slot, 3 code), account_hash (of code: its digest), sub_hash
    (of slots) and code (of accounts: the digest of their code). They are sorted into `ranges` by seq, as many as shuffles
    have partitions if not told; each is read once, without its payload, and no task sees more than a range.
    """
    n = ranges or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [records["seq"].cast("long").alias("seq"), records["type"].cast("int").alias("type"), "account_hash", "sub_hash", "code"]
    level = records.select(*columns).repartitionByRange(n, "seq").sortWithinPartitions("seq").mapInArrow(_functions, FUNCTION)
    while True:
        level = level.groupBy((F.col("part") / FAN).cast("long").alias("group")).applyInArrow(_composed, FUNCTION)
        n = -(-n // FAN)
        if n == 1:
            return level.mapInArrow(_begun, "fault string, at long")

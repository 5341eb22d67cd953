"""The order of record streams: composed functions against one pass."""

import random

import pytest

from ledgerloom.functions.keccak import EMPTY_CODE
from ledgerloom.operators import stream
from ledgerloom.operators.stream import Function, State

CODES = [b"c1", b"c2", EMPTY_CODE]


def one_pass(records):
    """The first fault's place by the rules as they are said, or None."""
    account = code = slot = None
    provided = False
    for at, (kind, key, sub, own) in enumerate(records):
        if kind == 1:
            if account is not None and not key > account:
                return at
            account, code, slot, provided = key, own, None, False
        elif account is None:
            return at
        elif kind == 2:
            if key != account or provided or (slot is not None and not sub > slot):
                return at
            slot = sub
        elif kind == 3:
            if provided or key != code or key == EMPTY_CODE:
                return at
            provided = True
        else:
            return at
    return None


def right(draw):
    out = []
    for k in range(draw.randint(0, 6)):
        key, code = bytes([10 * k]), draw.choice(CODES)
        out.append((1, key, None, code))
        out += [(2, key, bytes([10 * s]), None) for s in range(draw.choice([0, 0, 1, 4, 9]))]
        if code != EMPTY_CODE and draw.random() < 0.6:
            out.append((3, code, None, None))
    return out


def mutated(draw, records):
    out = list(records)
    for _ in range(draw.randint(0, 2)):
        if not out:
            break
        i, j = draw.randrange(len(out)), draw.randrange(len(out))
        what = draw.randrange(6)
        if what == 0:
            out[i], out[j] = out[j], out[i]
        elif what == 1:
            out.insert(j, out[i])
        elif what == 2:
            del out[i]
        elif what == 3:
            out.insert(j, (2, bytes([10 * draw.randrange(6)]), bytes([draw.randrange(90)]), None))
        elif what == 4:
            out.insert(j, (3, draw.choice(CODES), None, None))
        else:
            out[i] = (draw.choice([1, 2, 3, 4]), *out[i][1:2], b"x", draw.choice(CODES))
    return out


def function_of(records, low, high):
    f = Function()
    for at in range(low, high):
        f.record(at, *records[at])
    return f


def test_composed_functions_find_what_one_pass_finds():
    draw = random.Random(11)
    faults = 0
    for _ in range(4000):
        records = mutated(draw, right(draw))
        cuts = sorted({0, len(records), *(draw.randint(0, len(records)) for _ in range(draw.randint(0, 6)))})
        parts = [function_of(records, a, b) for a, b in zip(cuts, cuts[1:])]
        while len(parts) > 1:  # in any order of composition
            k = draw.randrange(len(parts) - 1)
            parts[k : k + 2] = [parts[k].then(parts[k + 1])]
        found = None
        if parts:
            parts[0].after(State())
            found = parts[0].fault_at
        assert found == one_pass(records), records
        faults += found is not None
    assert faults > 1000


@pytest.mark.parametrize("fan", [2, 512])
def test_ranges_of_a_table(spark, monkeypatch, fan):
    monkeypatch.setattr(stream, "FAN", fan)
    draw = random.Random(fan)
    base = [r for k in range(60) for r in [(1, bytes([k]), None, b"c%d" % k), *[(2, bytes([k]), bytes([s]), None) for s in range(k % 7)], *[(3, b"c%d" % k, None, None)] * (k % 3 == 0)]]
    swap = draw.randrange(len(base) - 9)
    late = base[: len(base) - 1] + [base[-2], base[-1]]
    for records in (base, base[:swap] + base[swap + 5 : swap + 9] + base[swap : swap + 5] + base[swap + 9 :], late, base[1:], []):
        df = spark.createDataFrame([(at, *map(lambda x: bytearray(x) if isinstance(x, bytes) else x, r)) for at, r in enumerate(records)], "seq long, type int, account_hash binary, sub_hash binary, code binary")
        got = stream.first_fault(df.repartition(3), 7).collect()
        assert [r["at"] for r in got] == [at for at in [one_pass(records)] if at is not None]

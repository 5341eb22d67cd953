"""Operators' input files: strict JSON, ownership witnesses, balance overlays, retention lists, bytecode, audits."""

from __future__ import annotations

import hashlib
import json
import os
import re
import stat
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import codec

LINE, SMALL = 4096, 1 << 20


def input_bytes(path: str, most: int | None = None) -> bytes:
    """A regular file that is no link and is the same after opening."""
    before = os.lstat(path)
    if not stat.S_ISREG(before.st_mode):
        raise ValueError(f"{path} is no regular file")
    with open(path, "rb") as f:
        after = os.fstat(f.fileno())
        if (before.st_dev, before.st_ino) != (after.st_dev, after.st_ino):
            raise ValueError(f"{path} was replaced")
        data = f.read() if most is None else f.read(most + 1)
    if most is not None and len(data) > most:
        raise ValueError(f"{path} has over {most} bytes")
    return data


def file_digest(path: str) -> str:
    return hashlib.sha256(input_bytes(path)).hexdigest()


def strict_json(text: str, fields: set | None = None):
    """JSON without doubled names (whatever their case), constants that are no numbers, or nulls; `fields` are all there must be."""

    def unique(pairs):
        names = [k.lower() for k, _ in pairs]
        if len(set(names)) != len(names):
            raise ValueError("a field occurs twice")
        if any(v is None for _, v in pairs):
            raise ValueError("a field is null")
        return dict(pairs)

    def refuse(name):
        raise ValueError(f"{name} is no number")

    data = json.loads(text, object_pairs_hook=unique, parse_constant=refuse)
    if fields is not None and (not isinstance(data, dict) or set(data) != fields):
        raise ValueError(f"fields are {sorted(data) if isinstance(data, dict) else data}, not {sorted(fields)}")
    return data


def shaped(data, shape, at: str = "") -> dict:
    """data, which must have the fields of `shape` and no others, all the way down.

    A shape is a dict by name, a type, or a pattern that a text must match as a whole; names that end in '?' may be left out.
    """
    if isinstance(shape, dict):
        if not isinstance(data, dict):
            raise ValueError(f"{at or 'document'} is no object")
        names = {n.removesuffix("?"): n for n in shape}
        wrong = set(data) - set(names) or {n for n, full in names.items() if n == full and n not in data}
        if wrong:
            raise ValueError(f"{at or 'document'}: unknown or missing {sorted(wrong)}")
        for name, value in data.items():
            shaped(value, shape[names[name]], f"{at}.{name}" if at else name)
    elif isinstance(shape, str):
        if not isinstance(data, str) or not re.fullmatch(shape, data):
            raise ValueError(f"{at} is malformed: {data!r}")
    elif type(data) is not shape or (shape is int and not 0 <= data < 1 << 64):
        raise ValueError(f"{at} is no {shape.__name__}")
    return data


def read_witness(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines to type, address, owner, spender, fault: an address alone, or owner and spender for an allowance.

    fault says what is wrong with a line, null for a good one; a caller acts on it before it uses the others.
    """
    line = F.col("value")
    names = F.json_object_keys(line)
    field = lambda f: F.get_json_object(line, f"$.{f}")
    kind = field("type")
    want = F.when(kind == "address", F.array(F.lit("address"), F.lit("type"))).when(kind == "allowance", F.array(F.lit("owner"), F.lit("spender"), F.lit("type")))
    of = {f: codec.address(field(f)) for f in ("address", "owner", "spender")}
    good = F.when(kind == "address", of["address"].isNotNull()).otherwise(of["owner"].isNotNull() & of["spender"].isNotNull())
    fault = (
        F.when(F.octet_length(line) > LINE, "line is too long").when(names.isNull(), "no JSON object").when(F.size(F.array_distinct(names)) != F.size(names), "a field occurs twice")
        .when(want.isNull(), "unknown type").when(F.array_sort(names) != want, "fields of another type").when(~good, "malformed address")
    )
    lines = spark.read.text(path).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))  # short lines: their work is more than their bytes say
    return lines.select(kind.alias("type"), *[c.alias(n) for n, c in of.items()], fault.alias("fault"))


def read_retention(spark: SparkSession, path: str, forbidden: str) -> DataFrame:
    """One 0x address a line to address, lines, fault."""
    line = F.col("value")
    rows = spark.read.text(path).groupBy(F.lower(line).alias("text")).agg(F.count("*").alias("lines"))
    address = codec.address(F.col("text"))
    fault = F.when(address.isNull(), "malformed address").when(F.col("lines") > 1, "address occurs twice").when(F.col("text") == forbidden.lower(), "the token contract cannot be listed")
    return rows.select(address.alias("address"), "lines", fault.alias("fault"))


def uint(text, bits: int = 256) -> int:
    """A number in decimal, or in hex behind 0x."""
    value = int(text, 16) if re.fullmatch("0x[0-9a-fA-F]+", str(text)) else int(text) if re.fullmatch("0|[1-9][0-9]*", str(text)) else -1
    if not 0 <= value < 1 << bits:
        raise ValueError(f"{text!r} is no number of {bits} bits")
    return value


def word(text: str) -> bytes:
    if not re.fullmatch("0x([0-9a-fA-F]{2}){1,32}", text):
        raise ValueError(f"{text!r} is no word")
    return bytes.fromhex(text[2:]).rjust(32, b"\x00")


def read_alloc(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object by address to address, balance, nonce, code, storage; what a patch does not set is null."""
    rows = []
    for name, patch in strict_json(input_bytes(path).decode()).items():
        if not re.fullmatch("(0x)?[0-9a-fA-F]{40}", name) or set(patch) - {"balance", "nonce", "code", "storage"}:
            raise ValueError(f"malformed account {name!r}")
        storage = {word(k): word(v) for k, v in patch.get("storage", {}).items()}
        if len(storage) != len(patch.get("storage", {})):
            raise ValueError("a slot occurs twice")
        rows.append((
            bytearray.fromhex(name[-40:]), uint(patch["balance"]).to_bytes(32, "big") if "balance" in patch else None, Decimal(uint(patch["nonce"], 64)) if "nonce" in patch else None,
            bytes.fromhex(patch["code"].removeprefix("0x")) if "code" in patch else None, list(storage.items()),
        ))
    if len({bytes(r[0]) for r in rows}) != len(rows):
        raise ValueError("an account occurs twice")
    return spark.createDataFrame(rows, "address binary, balance binary, nonce decimal(20,0), code binary, storage array<struct<slot: binary, word: binary>>")


def read_code(path: str) -> bytes:
    text = input_bytes(path, SMALL).decode().strip()
    if not re.fullmatch("0x([0-9a-fA-F]{2})+", text):
        raise ValueError("bytecode is hex behind 0x")
    return bytes.fromhex(text[2:])


#: An audit's values: hashes, addresses, integers as they would be written. Its fields.
HASH, ADDRESS, INTEGER = "0x[0-9a-fA-F]{64}", "0x[0-9a-fA-F]{40}", "0|-?[1-9][0-9]*"
AUDIT_STATE = {"root": HASH, "ovmCodeHash": HASH, "balanceSlots": int, "balancesWei": INTEGER, "supplyWei": INTEGER, "differenceWei": INTEGER}
AUDIT = {
    "version": int,
    "identity": {"version": int, "genesis": HASH, "configHash": HASH, "witnessHash": HASH, "to": int, "toHash": HASH, "deSeqBlock": int, "seqValidHeight": int, "firstSequencer": ADDRESS},
    "clientVersion": str, "from": int, "verifiedBlocks": int, "genesisState": AUDIT_STATE, "targetState": AUDIT_STATE,
    "totals": dict.fromkeys(("balanceDeltaWei", "supplyDeltaWei", "discrepancyDeltaWei", "gasShortfallWei", "legacySelfdestructWei", "unexplainedDeltaWei"), INTEGER),
    "executionVerified": bool, "accountingReconciled": bool, "intervalCausesFullyExplained": bool, "unexplainedEvents": int, "genesisDifferenceExplained": bool,
    "previousDiagnosisDifferenceWei?": INTEGER, "matchesPreviousDiagnosis?": bool,
}


def read_audit(path: str) -> dict:
    """A summary of at most 1 MiB with all its fields and no others, whose balances, supply and difference add up, for both states and over the interval."""
    data = shaped(strict_json(input_bytes(path, SMALL).decode()), AUDIT)
    if data["version"] != 1:
        raise ValueError("audit is of another version")
    amounts = {}
    for side in ("genesisState", "targetState"):
        balances, supply, difference = amounts[side] = [int(data[side][k]) for k in ("balancesWei", "supplyWei", "differenceWei")]
        if not 0 <= balances < 1 << 256 or not 0 <= supply < 1 << 256 or balances - supply != difference:
            raise ValueError(f"{side} does not add up")
    for name, k in (("balanceDeltaWei", 0), ("supplyDeltaWei", 1), ("discrepancyDeltaWei", 2)):
        if amounts["targetState"][k] - amounts["genesisState"][k] != int(data["totals"][name]):
            raise ValueError(f"{name} is not what the states differ by")
    who, totals = data["identity"], {k: int(v) for k, v in data["totals"].items()}
    hashes = [who[k] for k in ("genesis", "configHash", "witnessHash", "toHash")] + [data[s][k] for s in amounts for k in ("root", "ovmCodeHash")]
    if who["version"] != 1 or not data["clientVersion"] or data["from"] != 1 or not who["to"] or data["verifiedBlocks"] != who["to"] or not all(int(h, 16) for h in hashes):
        raise ValueError("audit does not cover the chain, or does not say what it is of")
    settled = [data[k] for k in ("executionVerified", "accountingReconciled", "intervalCausesFullyExplained", "genesisDifferenceExplained")]
    if not all(settled) or data["unexplainedEvents"] or totals["unexplainedDeltaWei"] or amounts["genesisState"][2]:
        raise ValueError("audit leaves something unexplained")
    causes = totals["gasShortfallWei"], totals["legacySelfdestructWei"]
    if min(causes) < 0 or sum(causes) != totals["discrepancyDeltaWei"]:
        raise ValueError("causes of the audit do not add up")
    return data


def publish(folder: str, write) -> None:
    """write(temporary folder), then one rename to `folder`, which must not exist and is never replaced; nothing is left behind on failure."""
    import shutil
    import tempfile

    from ledgerloom.plans.staging import rename_new

    target = Path(folder)
    if target.exists():
        raise FileExistsError(folder)
    part = tempfile.mkdtemp(prefix=f"{target.name}.partial-", dir=target.parent)
    try:
        write(part)
        rename_new(part, folder)
        fd = os.open(target.parent, os.O_RDONLY)
        os.fsync(fd)
        os.close(fd)
    except BaseException:
        shutil.rmtree(part, ignore_errors=True)
        raise


def outside(output: str, *inputs: str) -> None:
    """Refuses an output within an input, or the other way round, links followed."""
    out = Path(output).resolve()
    for i in map(lambda p: Path(p).resolve(), inputs):
        if out == i or i in out.parents or out in i.parents:
            raise ValueError(f"output {out} and input {i} lie within each other")


def exact_layout(folder: str, expected: dict[str, str]) -> None:
    """The folder has these entries ('file' or 'folder') and no others, none of them a link."""
    found = {e.name: "link" if e.is_symlink() else "folder" if e.is_dir() else "file" for e in os.scandir(folder)}
    if found != expected:
        raise ValueError(f"{folder} has {found}, not {expected}")

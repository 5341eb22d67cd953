"""Reports of artifacts: what they are of, by which versions, and what was found. One kind for each way that an artifact is made."""

from __future__ import annotations

import datetime
import json
from dataclasses import asdict

from pyspark import __version__ as engine
from pyspark.sql import SparkSession

from ledgerloom import __version__
from ledgerloom.plans import history, staging
from ledgerloom.sources.inputs import shaped, strict_json

PORTABLE, DIRECT, CONVERSION, PRUNE = (f"ledgerloom-{kind}-verification" for kind in ("portable", "direct", "conversion", "prune"))
VERSION = 1
#: Values: digests in hex, hex of any length, times in UTC, sums that may be larger than a number of 64 bits.
DIGEST, BYTES, TIME, SUM = "[0-9a-f]{64}", "([0-9a-f]{2})*", "[0-9T:.+-]+", "[0-9]+"
HEAD = {"number": int, "hash": DIGEST, "state_root": DIGEST}
SOURCE = {"head_before": HEAD, "head_after": HEAD, "header": BYTES}
COUNTS = dict.fromkeys(("accounts", "storage_slots", "code_references", "code_records", "records", "payload_bytes"), int)
MEASURE = {"keys": int, "bytes": int}
INVENTORY = {f"{kind}?": MEASURE for kind in ("node", "code", "metadata", "account", "slot", "account node", "storage node")}
COMMON = {"format": str, "version": int, "verified_at": TIME, "tool_version": str, "engine_version": str}
STATE = {"scheme": "hash|path", "source": SOURCE, "counts": COUNTS, "recomputed_root": DIGEST, "inventory": INVENTORY}
INPUTS = {f"{name}_sha256?": DIGEST for name in ("witness", "code", "retain", "alloc", "audit")}
BALANCES = {"original_supply": SUM, "migrated_native": SUM, "remaining_supply": SUM, "eoa_holders": int, "converted_contract_holders": int, "retained_contract_holders": int, "self_balance": SUM}
HISTORY = {"first_block": int, "last_block": int, "blocks": int, "transfers": int, "approvals": int, "history_sha256": DIGEST, "events_sha256": DIGEST}
SHAPES = {
    PORTABLE: COMMON | STATE | {"manifest_sha256": DIGEST, "file_sha256": DIGEST, "record_chain": DIGEST},
    DIRECT: COMMON | STATE,
    CONVERSION: COMMON | STATE | {"original_counts": COUNTS, "checkpoint": SOURCE, "token": "[0-9a-f]{40}", "inputs": INPUTS, "balances": BALANCES, "history": HISTORY, "audit?": {"balance_sum": SUM, "supply_difference": "0|-?[1-9][0-9]*", "earlier_head?": HEAD}},
    PRUNE: COMMON | {"source": SOURCE, "genesis_root?": DIGEST, "dry_run": bool, "compacted": bool, "state_counts": COUNTS, "protected_digest": DIGEST, "measures": {f"{role}_{x}": int for role in ("keep", "protected", "candidates", "unknown") for x in ("keys", "bytes")}},
}


def evidence(head: history.Head, after: history.Head | None = None) -> dict:
    of = lambda h: {"number": h.number, "hash": h.hash.hex(), "state_root": h.state_root.hex()}
    return {"head_before": of(head), "head_after": of(after or head), "header": head.header.hex()}


def _common(kind: str) -> dict:
    return {"format": kind, "version": VERSION, "verified_at": datetime.datetime.now(datetime.UTC).isoformat(), "tool_version": __version__, "engine_version": engine}


def direct(head: history.Head, scheme: str, counts: dict) -> dict:
    return _common(DIRECT) | {"scheme": scheme, "source": evidence(head), "counts": counts, "recomputed_root": head.state_root.hex()}


def portable(head: history.Head, scheme: str, counts: dict, bundle: dict) -> dict:
    of = bundle["evidence"]
    more = {"manifest_sha256": bundle["manifest_sha256"], "file_sha256": of.sha256, "record_chain": of.chain}
    return direct(head, scheme, counts) | {"format": PORTABLE} | more


def conversion(head: history.Head, checkpoint: history.Head, scheme: str, original: dict, counts: dict, token: bytes, digests: dict, balances, found, audit: dict | None) -> dict:
    amounts = {k: str(v) if BALANCES[k] is SUM else v for k, v in asdict(balances).items()}
    out = _common(CONVERSION) | {"scheme": scheme, "source": evidence(head), "counts": counts, "recomputed_root": checkpoint.state_root.hex(), "original_counts": original, "checkpoint": evidence(checkpoint)}
    return out | {"token": token.hex(), "inputs": digests, "balances": amounts, "history": asdict(found)} | ({"audit": audit} if audit else {})


def prune(head: history.Head, found: dict, genesis_root: bytes | None = None, dry_run: bool = True, compacted: bool = False) -> dict:
    """found: what snapshot.prune said."""
    measures = {k: v for k, v in found.items() if k not in ("state_counts", "protected_digest")}
    out = _common(PRUNE) | {"source": evidence(head), "dry_run": dry_run, "compacted": compacted, "measures": measures}
    return out | {k: found[k] for k in ("state_counts", "protected_digest")} | ({"genesis_root": genesis_root.hex()} if genesis_root else {})


def checked(report: dict) -> dict:
    """The report, if it has all fields of its kind and no others, and they go together."""
    kind = report.get("format") if isinstance(report, dict) else None
    if kind not in SHAPES or report.get("version") != VERSION:
        raise ValueError(f"unknown report {kind!r}")
    shaped(report, SHAPES[kind])
    if report["source"]["head_before"] != report["source"]["head_after"]:
        raise ValueError("the head moved while the report was made")
    if kind == PRUNE and report["dry_run"] and report["compacted"]:
        raise ValueError("a dry run compacts nothing")
    if kind != PRUNE:
        c, of = report["counts"], report["checkpoint" if kind == CONVERSION else "source"]["head_before"]
        if c["records"] != c["accounts"] + c["storage_slots"] + c["code_records"] or not c["code_records"] <= c["code_references"] <= c["accounts"] or report["recomputed_root"] != of["state_root"]:
            raise ValueError("counts or roots of the report do not go together")
    return report


def write(spark: SparkSession, path: str, report: dict) -> None:
    staging.write_text(spark, path, json.dumps(checked(report), indent=1, sort_keys=True))


def read(spark: SparkSession, path: str) -> dict:
    return checked(strict_json(staging.read_text(spark, path)))


def same(a: dict, b: dict) -> bool:
    """Whether two reports say the same, whenever and by whichever version they were made."""
    made = ("verified_at", "tool_version", "engine_version")
    return {k: v for k, v in a.items() if k not in made} == {k: v for k, v in b.items() if k not in made}

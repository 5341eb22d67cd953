"""The conversion of a token's balances from end to end: inputs, history, state, checkpoint; and its verification by doing all of it again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions.keccak import keccak
from ledgerloom.plans import audit, convert, history, report, snapshot
from ledgerloom.plans.progress import Progress
from ledgerloom.plans.staging import staged
from ledgerloom.sources import freezer, inputs

#: Tables of the cold history, and whether their items are packed.
COLD = {"hashes": False, "headers": True, "receipts": True}


@dataclass
class Options:
    """The token, and paths of the operator's inputs; what is None is not used."""

    token: bytes
    witness: str
    code: str
    retain: str | None = None
    alloc: str | None = None
    audit: str | None = None
    cold: str | None = None
    extra: bytes = b""

    def inputs(self) -> dict[str, str]:
        return {k: v for k in ("witness", "code", "retain", "alloc", "audit") if (v := getattr(self, k))}


@dataclass
class Converted:
    state: snapshot.State
    checkpoint: history.Head
    original: dict
    balances: convert.Balances
    history: history.Evidence
    audit: dict | None
    digests: dict[str, str]


def _good(rows: DataFrame, what: str) -> DataFrame:
    """Input lines, if none of them has a fault."""
    if bad := rows.where("fault IS NOT NULL").first():
        raise ValueError(f"{what}: {bad.fault}")
    return rows


def replay(kv: DataFrame, head: history.Head, options: Options, progress: Progress) -> Converted:
    """The state after conversion with the checkpoint on top of the head, all from the source and the inputs; writes no target."""
    spark = kv.sparkSession
    before = audit.digests(list(options.inputs().values()))
    code, summary = inputs.read_code(options.code), inputs.read_audit(options.audit) if options.audit else None
    if summary:
        audit.match_head(summary, head.number, "0x" + head.hash.hex(), "0x" + head.state_root.hex())
    witness = _good(staged(inputs.read_witness(spark, options.witness), "witness"), "witness")
    retained = _good(inputs.read_retention(spark, options.retain, "0x" + options.token.hex()), "retention list") if options.retain else None
    with progress.phase("original state") as say:
        state = snapshot.traverse(kv, head.state_root)
        original = state.counts()
        say.update(records=original["records"], root=head.state_root.hex())
    with progress.phase("history") as say:
        cold = None
        if options.cold:
            tables = freezer.read_freezer(spark, options.cold, COLD)
            cold = {"hash": tables["hashes"], "header": tables["headers"], "receipts": tables["receipts"]}
        found, events = history.scan(kv, head, options.token, cold)
        say.update(records=found.blocks)
    with progress.phase("balances"):
        pieces = convert.pieces(events, convert.preimages(kv), witness, options.token, retained)
        token_code = state.accounts.where(state.accounts["account_hash"] == snapshot._bin(keccak(options.token))).first()
        out, root, balances = convert.convert(state, options.token, *(staged(p, "evidence") for p in pieces), code, retained)
    accepted = None
    if summary:
        total = balances.migrated_native + balances.remaining_supply
        slots = balances.eoa_holders + balances.converted_contract_holders + balances.retained_contract_holders + (balances.self_balance > 0)
        audit.match_accounting(summary, audit.Accounting(head.number, "0x" + bytes(token_code.code_hash).hex(), slots, total, balances.original_supply))
        accepted = {"balance_sum": str(total), "supply_difference": str(total - balances.original_supply)}
        if (to := summary["identity"]["to"]) < head.number:
            accepted["earlier_head"] = {"number": to, "hash": summary["identity"]["toHash"][2:].lower(), "state_root": summary["targetState"]["root"][2:].lower()}
    if options.alloc:
        with progress.phase("overlay"):
            out, root = convert.overlay_alloc(out, inputs.read_alloc(spark, options.alloc))
    with progress.phase("nodes") as say:
        snapshot.check_roots(out, root)  # built anew from the leaves, where the nodes were patched
        say["root"] = root.hex()
    header = convert.checkpoint(head.header, root, options.extra)
    audit.confirm(before)
    return Converted(out, history.Head(head.number + 1, keccak(header), root, header), original, balances, found, accepted, {f"{k}_sha256": before[v] for k, v in options.inputs().items()})


def _report(done: Converted, head: history.Head, options: Options, scheme: str) -> dict:
    return report.conversion(head, done.checkpoint, scheme, done.original, done.state.counts(), options.token, done.digests, done.balances, done.history, done.audit)


def migrate(kv: DataFrame, head: history.Head, options: Options, target: str, scheme: str, confirm: Callable | None = None) -> dict:
    """An artifact of the converted state, with the checkpoint as its head."""
    progress = Progress(kv.sparkSession, "convert")
    done = replay(kv, head, options, progress)

    def unchanged() -> None:
        audit.confirm({options.inputs()[k.removesuffix("_sha256")]: v for k, v in done.digests.items()})
        if confirm:
            confirm()

    with progress.phase("artifact"):
        return snapshot.write_artifact(done.state, done.checkpoint, target, scheme, _report(done, head, options, scheme), unchanged, history.empty_body(done.checkpoint))


def verify(kv: DataFrame, head: history.Head, options: Options, target: str, confirm: Callable | None = None) -> dict:
    """Replays the conversion from source and inputs, and holds the artifact and its report against what comes out."""
    spark: SparkSession = kv.sparkSession
    stored = snapshot.read_artifact(spark, target, report.CONVERSION)
    given = {f"{k}_sha256" for k in options.inputs()}
    if given != set(stored["inputs"]):
        raise ValueError(f"inputs are {sorted(given)}, the artifact was made of {sorted(stored['inputs'])}")
    done = replay(kv, head, options, Progress(spark, "verify"))
    if confirm:
        confirm()
    return snapshot._verified(spark, target, stored, _report(done, head, options, stored["scheme"]), done.state, done.checkpoint, history.empty_body(done.checkpoint))

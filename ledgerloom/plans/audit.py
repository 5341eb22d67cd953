"""Acceptance of an earlier audit, and the fences that end an operation: inputs and head must be as they were."""

from __future__ import annotations

from dataclasses import dataclass

from ledgerloom.sources import inputs


@dataclass
class Accounting:
    """What a state's token says: its code's digest, how many slots hold a balance, their sum and the recorded supply."""

    height: int
    code_hash: str
    slots: int
    balances: int
    supply: int


def match_head(audit: dict, number: int, block_hash: str, state_root: str) -> None:
    """The audit's target is the head, with its hash and root, or lies before it."""
    to = audit["identity"]["to"]
    if to > number:
        raise ValueError("audit target is ahead of the head")
    if to == number and (audit["identity"]["toHash"], audit["targetState"]["root"]) != (block_hash, state_root):
        raise ValueError("audit target is another head")


def match_accounting(audit: dict, found: Accounting) -> None:
    """Same code and same difference of balances and supply; at the audit's own height the same amounts too."""
    target, to = audit["targetState"], audit["identity"]["to"]
    if to > found.height:
        raise ValueError("audit target is ahead of the accounting")
    pairs = {"ovmCodeHash": found.code_hash, "differenceWei": str(found.balances - found.supply)}
    if to == found.height:
        pairs |= {"balanceSlots": found.slots, "balancesWei": str(found.balances), "supplyWei": str(found.supply)}
    for name, value in pairs.items():
        if target[name] != value:
            raise ValueError(f"audit has {name} {target[name]}, the source {value}")


def digests(paths: list[str]) -> dict[str, str]:
    return {p: inputs.file_digest(p) for p in paths}


def confirm(before: dict[str, str]) -> None:
    """Reads all inputs again: each must have the digest that it had when it was used."""
    for path, want in before.items():
        if inputs.file_digest(path) != want:
            raise ValueError(f"{path} has changed")

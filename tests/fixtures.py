"""A small legacy database: a token contract, holders with and without code or account, two blocks of history."""

from ledgerloom.functions import rlp, u256
from ledgerloom.functions.keccak import EMPTY_CODE, EMPTY_LIST, EMPTY_ROOT, keccak
from ledgerloom.plans import history, trie

TOKEN = bytes.fromhex("deaddeaddeaddeaddeaddeaddeaddeaddead0000")
AMOUNTS = [11, 22, 33, 44, 55, 66]
NEW_CODE = bytes.fromhex("6080604052")


def holder(n):
    return (1000 + n).to_bytes(20, "big")


def trie_rows(leaves):
    """Root and key-value rows of a trie of 32-byte keys."""
    if not leaves:
        return EMPTY_ROOT, {}
    top, every = trie.build(sorted((trie.nibbles(k), v) for k, v in leaves.items()))
    return top.hash, {n.hash: n.blob for n in every if len(n.blob) >= 32 or n is top}


def header(parent, root, number, txs, receipts, bloom, gas):
    return rlp.encode([parent, EMPTY_LIST, bytes(20), root, txs, receipts, bloom, 1, number, 30_000_000, gas, number + 1, b"", bytes(32), bytes(8)])


def event(topic, source, target, amount):
    return [TOKEN, [topic, source.rjust(32, b"\0"), target.rjust(32, b"\0")], amount.to_bytes(32, "big")]


def database(first_amount=1, supply=308, extra_slot=False):
    """key to value, and the head's state root."""
    word = lambda n: n.to_bytes(32, "big")
    storage = {word(2): supply, word(3): int.from_bytes(b"Token".ljust(31, b"\0") + bytes([10]), "big")}
    storage |= {u256.mapping_slot(holder(n + 1), 0): a for n, a in enumerate(AMOUNTS)}
    storage |= {u256.mapping_slot(TOKEN, 0): 77, u256.nested_slot(holder(2), holder(4), 1): 0x1234}
    if extra_slot:
        storage[word(99)] = 5
    kv = {}
    root, rows = trie_rows({keccak(k): rlp.encode(v) for k, v in storage.items()})
    kv |= rows
    token_code, code = b"\x60\x00\x00", b"\x60\x01\x00"
    kv |= {keccak(token_code): token_code, keccak(code): code}
    accounts = {keccak(TOKEN): rlp.Account(1, 0, root, keccak(token_code)).full()}
    for n in range(1, 9):
        if n != 5:  # a balance without an account
            has = keccak(code) if n in (2, 3, 4) else keccak(token_code) if n == 8 else EMPTY_CODE
            accounts[keccak(holder(n))] = rlp.Account(n, 0, EMPTY_ROOT, has).full()
    state, rows = trie_rows(accounts)
    kv |= rows
    genesis = header(bytes(32), state, 0, EMPTY_ROOT, EMPTY_ROOT, bytes(256), 0)
    logs = [event(history.TRANSFER, holder(2), holder(4), first_amount), event(history.TRANSFER, holder(1), holder(4), 1), event(history.APPROVAL, holder(2), holder(4), 0x1234)]
    receipt = rlp.receipt([b"\x01", (21000).to_bytes(2, "big"), logs, b"", b"", b"", b""])
    head = header(keccak(genesis), state, 1, keccak(b"transactions"), trie.list_root([receipt.consensus()]), receipt.bloom, 21000)
    stored = rlp.encode([[b"\x01", 21000, logs, b"", b"", b"", b""]])
    for number, blob, receipts in ((0, genesis, b"\xc0"), (1, head, stored)):
        num, own = number.to_bytes(8, "big"), keccak(blob)
        kv |= {b"h" + num + b"n": own, b"h" + num + own: blob, b"r" + num + own: receipts, b"H" + own: num}
    kv[b"LastBlock"] = keccak(head)
    return kv, state


def frame(spark, kv):
    return spark.createDataFrame([(bytearray(k), bytearray(v)) for k, v in kv.items()], "key binary, value binary")

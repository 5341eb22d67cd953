"""Pieces of SQL for the queries' SQL: Keccak-256, recursive length prefixes and tries' roots, as DuckDB can work them out."""

from __future__ import annotations

FULL = (1 << 64) - 1


def _round_constants() -> list[int]:
    """By the rule: bit 2^j - 1 of constant i is the next bit of an LFSR of degree 8."""
    out, r = [], 1
    for _ in range(24):
        c = 0
        for j in range(7):
            c |= (r & 1) << ((1 << j) - 1)
            r = (r << 1) ^ (0x171 if r & 0x80 else 0)
        out.append(c)
    return out


def _rotations() -> dict[tuple[int, int], int]:
    out, x, y = {(0, 0): 0}, 1, 0
    for t in range(24):
        out[x, y] = (t + 1) * (t + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    return out


def let(value: str, name: str, use: str) -> str:
    return f"list_transform([{value}], lambda {name}: {use})[1]"


def _xor(*parts: str) -> str:
    out = parts[0]
    for p in parts[1:]:
        out = f"xor({out}, {p})"
    return out


def _turn(x: str, n: int) -> str:
    return f"((({x} & {FULL >> n}::UBIGINT) << {n}::UBIGINT) | ({x} >> {64 - n}::UBIGINT))" if n else x


def _round(s: str, constant: str) -> str:
    turns = _rotations()
    columns = "[" + ", ".join(_xor(*[f"{s}[{x + 5 * y + 1}]" for y in range(5)]) for x in range(5)) + "]"
    mixed = "[" + ", ".join(f"xor(c[{(x + 4) % 5 + 1}], {_turn(f'c[{(x + 1) % 5 + 1}]', 1)})" for x in range(5)) + "]"
    added = "[" + ", ".join(f"xor({s}[{i + 1}], d[{i % 5 + 1}])" for i in range(25)) + "]"
    moved = [""] * 25
    for (x, y), n in turns.items():
        moved[y + 5 * ((2 * x + 3 * y) % 5)] = _turn(f"a[{x + 5 * y + 1}]", n)
    out = []
    for i in range(25):
        x, y = i % 5, i // 5 * 5
        lane = f"xor(b[{i + 1}], (xor(b[{(x + 1) % 5 + y + 1}], {FULL}::UBIGINT) & b[{(x + 2) % 5 + y + 1}]))"
        out.append(_xor(lane, constant) if i == 0 else lane)
    return let(columns, "c", let(mixed, "d", let(added, "a", let("[" + ", ".join(moved) + "]", "b", "[" + ", ".join(out) + "]"))))


def backwards(digits: str) -> str:
    """Sixteen hex digits with their bytes turned round."""
    return " || ".join(f"substr({digits}, {k}, 2)" for k in range(15, 0, -2))


def keccak(digits: str) -> str:
    """The digest, in hex, of bytes given in hex."""
    size = "(length(h) // 2)"
    pad = f"(136 - {size} % 136)"
    padded = f"h || CASE WHEN {pad} = 1 THEN '81' ELSE '01' || repeat('00', {pad} - 2) || '80' END"
    lane = f"('0x' || {backwards('g')})::UBIGINT"
    block = f"list_transform(range(0, 25), lambda i: CASE WHEN i < 17 THEN {let('substr(p, 272 * k + 16 * i + 1, 16)', 'g', lane)} ELSE 0::UBIGINT END)"
    blocks = f"list_transform(range(0, length(p) // 272), lambda k: {block})"
    rounds = "[" + ", ".join(f"[{c}::UBIGINT]" for c in _round_constants()) + "]"
    absorbed = "list_transform(range(1, 26), lambda i: xor(u[i], v[i]))"
    permuted = f"list_reduce(list_prepend({absorbed}, {rounds}), lambda s, r: {_round('s', 'r[1]')})"
    state = f"list_reduce(list_prepend(list_transform(range(0, 25), lambda i: 0::UBIGINT), {blocks}), lambda u, v: {permuted})"
    words = f"list_transform(range(1, 5), lambda i: {let(f'printf({chr(39)}%016x{chr(39)}, z[i])', 'g', backwards('g'))})"
    return let(digits, "h", let(padded, "p", let(state, "z", f"array_to_string({words}, '')")))


def digits_of(number: str) -> str:
    """A number from nought on, in as few bytes as it needs, in hex; nought needs none."""
    return let(f"CASE WHEN {number} = 0 THEN '' ELSE lower(to_base({number}, 16)) END", "e", "CASE WHEN length(e) % 2 = 1 THEN '0' || e ELSE e END")


def rlp_text(digits: str) -> str:
    """Encodes up to 55 bytes, in hex."""
    return let(digits, "w", "CASE WHEN length(w) = 2 AND w < '80' THEN w ELSE to_base(128 + length(w) // 2, 16, 2) || w END").replace("to_base(128", "lower(to_base(128").replace("16, 2)", "16, 2))")


def rlp_list(*items: str) -> str:
    """Encodes a list of encoded items, up to 65,535 bytes."""
    head = "CASE WHEN length(q) < 112 THEN lower(to_base(192 + length(q) // 2, 16, 2)) WHEN length(q) < 512 THEN 'f8' || lower(to_base(length(q) // 2, 16, 2)) ELSE 'f9' || lower(to_base(length(q) // 2, 16, 4)) END"
    return let(" || ".join(items), "q", f"{head} || q")


def trie_roots(leaves: str, deepest: int = 12) -> str:
    """(owner, root, n) from a relation of (owner, key: 64 digits, value: digits): tables to go on with, the last is named roots.

    A branch is where two neighbours in the order of keys part; its parent is the next one above where any two part. From
    the deepest level up, references of one branch come together, and go on to the branch above. Values are of so many
    bytes that no node is less than 32.
    """
    apart = "coalesce(list_min(list_filter(range(1, 65), lambda i: substr(key, i, 1) <> substr(beside, i, 1))) - 1, -1)"
    packed = lambda digits, odd, even: f"CASE WHEN length({digits}) % 2 = 1 THEN '{odd}' || {digits} ELSE '{even}' || {digits} END"
    reference = lambda blob: f"'a0' || {keccak(blob)}"
    leaf = reference(rlp_list(rlp_text(packed("rest", "3", "20")), rlp_text("value")))
    items = "array_to_string(list_transform(range(0, 16), lambda d: coalesce(refs[lower(to_base(d, 16))], '80')), '') || '80'"
    branch, extension = reference(rlp_list(items)), reference(rlp_list(rlp_text(packed("path", "1", "00")), "ref"))
    return f"""
sorted AS (SELECT owner, key, value, lag(key) OVER w AS before, lead(key) OVER w AS after FROM {leaves} WINDOW w AS (PARTITION BY owner ORDER BY key)),
parted AS (SELECT owner, key, value, (SELECT {apart} FROM (SELECT before AS beside)) AS low, (SELECT {apart} FROM (SELECT after AS beside)) AS high FROM sorted),
lengths AS (SELECT DISTINCT owner, substr(key, 1, high) AS branch, high AS depth FROM parted WHERE high >= 0),
below AS (SELECT l.owner, l.branch, l.depth, p.low, p.high FROM parted p JOIN (SELECT DISTINCT owner, depth FROM lengths) d ON p.owner = d.owner JOIN lengths l ON l.owner = d.owner AND l.depth = d.depth AND l.branch = substr(p.key, 1, d.depth)),
parents AS (SELECT owner, branch, depth, greatest(coalesce(max(low) FILTER (low < depth), -1), coalesce(max(high) FILTER (high < depth), -1)) AS up FROM below GROUP BY ALL),
ends AS (SELECT owner, key, value, greatest(low, high) AS up, substr(key, greatest(low, high) + 2) AS rest FROM parted),
rising(level, owner, branch, up, nibble, ref) AS (
  SELECT {deepest}, owner, substr(key, 1, greatest(up, 0)), up, CASE WHEN up < 0 THEN '' ELSE substr(key, up + 1, 1) END, {leaf} FROM ends
  UNION ALL
  SELECT level - 1, owner, CASE WHEN now THEN substr(branch, 1, greatest(above, 0)) ELSE branch END, CASE WHEN now THEN above ELSE up END,
    CASE WHEN NOT now THEN nibble WHEN above < 0 THEN '' ELSE substr(branch, above + 1, 1) END,
    CASE WHEN NOT now THEN ref WHEN path = '' THEN ref ELSE {extension} END
  FROM (SELECT level, owner, branch, up, nibble, now, above, CASE WHEN now THEN substr(branch, above + 2) ELSE '' END AS path, CASE WHEN now THEN {branch} ELSE lone END AS ref
    FROM (SELECT g.*, p.up AS above FROM (
      SELECT level, owner, branch, up, up = level AS now, CASE WHEN up = level THEN '' ELSE nibble END AS nibble, map_from_entries(list((nibble, ref))) AS refs, any_value(ref) AS lone
      FROM rising WHERE level >= 0 GROUP BY level, owner, branch, up, CASE WHEN up = level THEN '' ELSE nibble END) g LEFT JOIN parents p ON now AND p.owner = g.owner AND p.branch = g.branch AND p.depth = g.up))),
roots AS (SELECT r.owner, substr(r.ref, 3) AS root, n.n FROM rising r JOIN (SELECT owner, count(*) AS n FROM {leaves} GROUP BY owner) n ON n.owner = r.owner WHERE r.level = -1)"""

"""Cropped or edited copies among images, by local descriptors.

Corners, a number by area, are found on a pyramid of scales; around each, binary tests between pairs of pixels are turned by the patch's
orientation. A descriptor's segments are keys of hash tables: images that share a key are compared in full, descriptor
by descriptor under Hamming distance, and are copies if enough matches agree on one similarity transform. Of a bucket
each image is compared with the least first; what that links is compared all with all by blocks, within tasks.
"""

from __future__ import annotations

from functools import cache, reduce
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_weighted, shuffles_go, small_batches, staged, table, unstaged
from ledgerloom.llm.components import connected

#: Pyramid: scales of its levels, which cover the turns that are accepted; a corner is the strongest so many pixels around, so that their number grows with the area.
LEVELS = tuple(0.8**k for k in range(5))
APART = 6
#: Bits of a descriptor, radius of the patch in which orientation and tests lie; bits of a table's key, where the tables' segments begin (they go round).
BITS, RADIUS = 256, 10
SEGMENT = 54
STARTS = tuple(BITS * k // 8 for k in range(8))
TURNS = 32
#: Tests see pixels that are smoothed by these boxes: noise turns few bits, so that keys can be long, and unlike images seldom share one.
SMOOTH = (5, 5)
#: Tests chosen one after another lie so many parts of a descriptor apart.
PARTS = 8
#: Bits in which matching descriptors may differ; pixels by which a match may miss the transform; matches that must agree.
DIFFER, MISS, AGREE = 64, 3.0, 6
#: Images of the usual size that are described at once; images of a block, of which a larger bucket has several.
IMAGES, BUCKET = 64, 256
#: Transforms that may agree by chance, of two images.
CHANCE = 0.05
#: Corners that are described at once; distances, or points under transforms, that are worked out at once; points whose distances to all are.
CORNERS, CELLS, PLACES = 4096, 1 << 21, 128


#: Binary tests that are drawn, of which BITS are chosen; how wide they lie, in parts of RADIUS; how one-sided a chosen one may be.
POOL, WIDE, FAR, SIDED = 3072, 1 / 1.9, 0.8, 0.25


@cache
def _tests(seed: int = 5):
    """Offsets by turn, test and end, as (x, y): tests whose bits are even and depend little on each other, over corners of random pictures of several grains.

    Chosen greedily, the evenest first, under the least bound on correlation that leaves enough of them; those that
    were chosen one after another lie apart. Keys of dependent bits would bring unlike images together.
    """
    draw = np.random.default_rng(seed)
    points = np.clip(draw.normal(0, RADIUS * WIDE, (POOL, 2, 2)), -RADIUS * FAR, RADIUS * FAR)
    angle = np.arange(TURNS) * 2 * np.pi / TURNS
    turn = np.stack([np.stack([np.cos(angle), -np.sin(angle)], -1), np.stack([np.sin(angle), np.cos(angle)], -1)], -2)
    tests = np.rint(np.einsum("tij,bpj->tbpi", turn, points)).astype(np.int64)
    seen = []
    for cells in (48, 32, 24, 16, 12):
        at = np.clip((np.arange(96) + 0.5) * cells / 96 - 0.5, 0, cells - 1.001)
        low, part = at.astype(np.int64), at - at.astype(np.int64)
        grid = draw.normal(0, 1, (6, cells, cells))
        tall = grid[:, low] * (1 - part[:, None]) + grid[:, low + 1] * part[:, None]
        images = np.clip(128 + 45 * (tall[:, :, low] * (1 - part) + tall[:, :, low + 1] * part), 0, 255)
        seen += [np.stack(d) for _, d in describe(images.astype(np.uint8), tests) if len(d)]
    bits = np.unpackbits(np.concatenate(seen), axis=1)[:, :POOL].astype(np.float32)
    mean = bits.mean(axis=0)
    unit = (bits - mean) / np.maximum(bits.std(axis=0), 1e-6)
    alike = np.abs(unit.T @ unit) / len(bits)
    even = [k for k in np.argsort(np.abs(mean - 0.5), kind="stable") if abs(mean[k] - 0.5) < SIDED]
    for bound in np.arange(0.1, 1.01, 0.02):
        chosen, worst = [], np.zeros(POOL)
        for k in even:
            if worst[k] <= bound and len(chosen) < BITS:
                chosen.append(k)
                worst = np.maximum(worst, alike[k])
        if len(chosen) == BITS:
            break
    return tests[:, np.array(chosen).reshape(-1, PARTS).T.ravel()]


def _box(a: np.ndarray, size: int) -> np.ndarray:
    for axis in (1, 2):
        pad = [(0, 0)] * 3
        pad[axis] = (size // 2 + 1, size // 2)
        total = np.cumsum(np.pad(a, pad, mode="edge"), axis=axis, dtype=np.float32)
        a = np.take(total, range(size, total.shape[axis]), axis) - np.take(total, range(total.shape[axis] - size), axis)
    return a / (size * size)


def _scaled(a: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1.0:
        return a
    for axis in (1, 2):
        n = max(int(round(a.shape[axis] * scale)), 1)
        at = np.clip((np.arange(n) + 0.5) / scale - 0.5, 0, a.shape[axis] - 1)
        low = np.minimum(at.astype(np.int64), max(a.shape[axis] - 2, 0))
        part = (at - low).astype(np.float32).reshape([-1 if k == axis else 1 for k in range(3)])
        a = np.take(a, low, axis) * (1 - part) + np.take(a, np.minimum(low + 1, a.shape[axis] - 1), axis) * part
    return a


def _highest(a: np.ndarray) -> np.ndarray:
    """The largest value up to APART pixels around each, by axes."""
    for axis in (1, 2):
        pad = [(0, 0)] * 3
        pad[axis] = (APART, APART)
        wide, n = np.pad(a, pad, mode="edge"), a.shape[axis]
        a = np.take(wide, range(n), axis)
        for k in range(1, 2 * APART + 1):
            np.maximum(a, np.take(wide, range(k, k + n), axis), out=a)
    return a


def describe(images: np.ndarray, tests: np.ndarray) -> list:
    """Images of one size (n, h, w) to, for each, (points as x + iy, descriptors of BITS / 8 bytes)."""
    found = [([], []) for _ in images]
    disc = np.array([(x, y) for y in range(-7, 8) for x in range(-7, 8) if x * x + y * y <= 49])
    edge = RADIUS + 1
    for scale in LEVELS:
        a = _box(_scaled(images.astype(np.float32), scale), 3)
        n, h, w = a.shape
        if min(h, w) <= 2 * edge:
            continue
        gx, gy = np.zeros_like(a), np.zeros_like(a)
        gx[:, :, 1:-1], gy[:, 1:-1] = a[:, :, 2:] - a[:, :, :-2], a[:, 2:] - a[:, :-2]
        xx, yy, xy = _box(gx * gx, 5), _box(gy * gy, 5), _box(gx * gy, 5)
        corner = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        inner = corner[:, edge:-edge, edge:-edge]
        every = np.nonzero((inner >= _highest(inner)) & (inner > 1.0))
        soft = a
        for size in SMOOTH:
            soft = _box(soft, size)
        for k in range(0, len(every[0]), CORNERS):
            which, y, x = every[0][k : k + CORNERS], every[1][k : k + CORNERS] + edge, every[2][k : k + CORNERS] + edge
            patch = a[which[:, None], y[:, None] + disc[:, 1], x[:, None] + disc[:, 0]]
            turn = np.rint(np.arctan2(patch @ disc[:, 1], patch @ disc[:, 0]) * TURNS / (2 * np.pi)).astype(np.int64) % TURNS
            offset = tests[turn]
            value = soft[which[:, None, None], np.clip(y[:, None, None] + offset[..., 1], 0, h - 1), np.clip(x[:, None, None] + offset[..., 0], 0, w - 1)]
            bits = np.packbits(value[..., 0] < value[..., 1], axis=1)
            points = ((x + 0.5) + 1j * (y + 0.5)) / scale
            for at, i in enumerate(which):
                found[i][0].append(points[at])
                found[i][1].append(bits[at])
    return found


def _descriptors(tests: np.ndarray):
    """A function of (image_id, width, height, pixels) to (image_id, digest, xs, ys, bits): images whose size is not that of their pixels have no points."""
    from hashlib import blake2b

    small = tests.astype(np.int8)  # goes to every task

    def run(batches):
        tests = small.astype(np.int64)
        for batch in batches:
            ids, widths, heights = (batch.column(k).to_pylist() for k in range(3))
            pixels = [p.as_py() or b"" for p in batch.column(3)]
            sizes: dict = {}
            for i, p in enumerate(pixels):
                if widths[i] and heights[i] and widths[i] * heights[i] == len(p):
                    sizes.setdefault((heights[i], widths[i]), []).append(i)
            out = {}
            for (h, w), of in sizes.items():
                step = max(1, IMAGES * 9216 // (h * w))
                for k in range(0, len(of), step):
                    part = of[k : k + step]
                    stack = np.stack([np.frombuffer(pixels[i], dtype=np.uint8).reshape(h, w) for i in part])
                    out.update(zip(part, describe(stack, tests), strict=True))
            none = ([], [])
            rows = [out.get(i, none) for i in range(len(ids))]
            digests = [blake2b(p + f"{w}x{h}".encode(), digest_size=16).digest() for p, w, h in zip(pixels, widths, heights, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array([[float(z.real) for z in r[0]] for r in rows], pa.list_(pa.float32())), pa.array([[float(z.imag) for z in r[0]] for r in rows], pa.list_(pa.float32())), pa.array([b"".join(d.tobytes() for d in r[1]) for r in rows], pa.binary())],
                names=["image_id", "digest", "xs", "ys", "bits"],
            )

    return run


def _keys(batches):
    """(node, bits) to (key, node): the number of a segment and its bits, once an image."""
    place = 1 << np.arange(SEGMENT, dtype=np.int64)
    for batch in batches:
        keys, ids = [], []
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            bits = np.unpackbits(np.frombuffer(raw.as_py(), dtype=np.uint8).reshape(-1, BITS // 8), axis=1).astype(np.int64)
            bits = np.concatenate([bits, bits[:, :SEGMENT]], axis=1)
            parts = [bits[:, s : s + SEGMENT] @ place | k << SEGMENT for k, s in enumerate(STARTS)]
            key = np.unique(np.concatenate(parts))
            keys.append(key)
            ids.append(np.full(len(key), i, dtype=np.int64))
        cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([cat(keys), cat(ids)], names=["key", "node"])


def _nearest(da: np.ndarray, db: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of descriptors that are each other's nearest, and at DIFFER bits or fewer; some rows at a time."""
    to, to_at = np.empty(len(da), dtype=np.int64), np.empty(len(da), dtype=np.int64)
    back, back_at = np.zeros(len(db), dtype=np.int64), np.full(len(db), BITS + 1)
    step = max(1, CELLS // len(db))
    halves = [np.unpackbits(np.ascontiguousarray(d).view(np.uint8), axis=1).astype(np.float32) - 0.5 for d in (da, db)]
    for k in range(0, len(da), step):
        apart = BITS / 2 - 2 * (halves[0][k : k + step] @ halves[1].T)  # equal bits add a quarter, others take one: exact
        to[k : k + step], to_at[k : k + step] = apart.argmin(axis=1), apart.min(axis=1)
        least = apart.min(axis=0)
        back = np.where(least < back_at, apart.argmin(axis=0) + k, back)
        back_at = np.minimum(least, back_at)
    own = np.flatnonzero((back[to] == np.arange(len(da))) & (to_at <= DIFFER))
    return own, to[own]


def _places(z: np.ndarray) -> np.ndarray:
    """For each point the first that stands for it: levels find one corner several times."""
    label, n, free = np.empty(len(z), dtype=np.int64), 0, (1 << len(z)) - 1
    for start in range(0, len(z), PLACES):
        near = np.packbits(np.abs(z[start : start + PLACES, None] - z) <= 2 * MISS, axis=1, bitorder="little")
        for i, row in enumerate(near, start):
            if free >> i & 1:
                own = int.from_bytes(row.tobytes(), "little") & free
                free ^= own
                while own:
                    label[(own & -own).bit_length() - 1] = n
                    own &= own - 1
                n += 1
    return label


def _needed(m: int, z: np.ndarray) -> int:
    """Places that must agree: AGREE, or as many as chance is not expected to bring together among the transforms of m matches to points z."""
    by_chance = m * np.pi * MISS * MISS / max(float(np.ptp(z.real) * np.ptp(z.imag)), 1.0)
    term, tail = exp(-by_chance), 1.0
    for k in range(m):
        if k + 2 >= AGREE and m * m / 2 * tail < CHANCE:
            return k + 2
        tail, term = tail - term, term * by_chance / (k + 1)
    return max(m + 1, AGREE)


def agreeing(za: np.ndarray, da: np.ndarray, zb: np.ndarray, db: np.ndarray) -> int:
    """Places of the matches of two images' points that one turn, scale and shift brings together: the most, or the first AGREE or more that are met; fewer than AGREE where chance would do as much."""
    if not len(za) or not len(zb):
        return 0
    own, to = _nearest(da, db)
    if len(own) < AGREE:
        return 0
    a, b = za[own], zb[to]
    places = _places(a), _places(b)
    if min(p.max() for p in places) + 1 < AGREE:
        return 0
    needed = _needed(len(own), zb)
    best, k, step, most = 0, 0, 1, max(1, CELLS // len(a) ** 2)
    while k < len(a):  # the transforms of some points with all later ones: of a few first, which do for most copies
        i, j = np.nonzero(np.arange(k, min(k + step, len(a)))[:, None] < np.arange(len(a)))
        i += k
        k, step = k + step, min(4 * step, most)
        far = (np.abs(a[i] - a[j]) > 2 * MISS) & (b[i] != b[j])
        i, j = i[far], j[far]
        turn = (b[i] - b[j]) / (a[i] - a[j])
        fair = (np.abs(turn) > 0.4) & (np.abs(turn) < 2.5)
        i, turn = i[fair], turn[fair]
        shift = b[i] - turn * a[i]
        hits = np.abs(turn[:, None] * a + shift[:, None] - b) <= MISS
        for h in hits[hits.sum(axis=1) >= needed]:
            best = max(best, min(len(set(p[h].tolist())) for p in places))
            if best >= needed:
                return best
    return min(best, AGREE - 1)


def _points(xs, ys, bits):
    return np.asarray(xs.values) + 1j * np.asarray(ys.values), np.frombuffer(bits.as_py(), dtype=np.uint64).reshape(-1, BITS // 64)


def _verified(batches):
    """Rows sorted by (a, salt, b): the one without b has the points of a, the others those of images to compare with it. To (u, v), the pairs of which AGREE matches agree."""
    at, one = None, None
    for batch in batches:
        us, vs = [], []
        for k, (a, salt, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
            points = _points(*(batch.column(c)[k] for c in (3, 4, 5)))
            if b is None:
                at, one = (a, salt), points
            elif at == (a, salt) and agreeing(*one, *points) >= AGREE:
                us.append(a)
                vs.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


#: Images that one is compared with in a group of rows; images of a block of a component, of which two meet in a task.
GROUP, BLOCK = 64, 64
#: Parts in which pairs are compared, one after another: what one has shuffled goes before the next begins.
SLICES = 3
POINTS = ["xs", "ys", "bits"]


def _linked(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs (a, b) whose points agree, as (u, v). Points of b travel once a pair, those of a once for each GROUP of its pairs."""
    counted = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    others = pairs.join(counted, "a").select("a", F.pmod(F.xxhash64("b"), "groups").alias("salt"), "b", F.col("b").alias("node"))
    own = counted.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), F.col("a").alias("node"))
    sides, links = staged(others.unionByName(own), "media-sides"), []
    for k in range(SLICES):
        both = sides.where(F.pmod(F.xxhash64("a"), F.lit(SLICES)) == k).join(points, "node").select("a", "salt", "b", *POINTS)
        both = both.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        links.append(staged(both.mapInArrow(_verified, "u long, v long"), "media-links"))
    return reduce(DataFrame.unionByName, links)


def _among(batches):
    """Rows sorted by (root, i, j), block, node and points, to (node, links): all pairs of block i with block j, or of i with itself."""

    def compared(group):
        links = dict.fromkeys((node for _, node, _ in group), 0)
        group.sort(key=lambda x: x[1])  # the smaller node first, as everywhere
        for k, (block, a, one) in enumerate(group):
            for other, b, two in group[k + 1 :]:
                if (block != other) == apart and agreeing(*one, *two) >= AGREE:
                    links[a] += 1
                    links[b] += 1
        return links

    def told(found):
        return pa.RecordBatch.from_arrays([pa.array([n for n, c in found if c], pa.int64()), pa.array([c for _, c in found if c], pa.int64())], names=["node", "links"])

    at, group, apart = None, [], False
    for batch in batches:
        found = []
        for k, (*key, block, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True)):
            if key != at:
                found += compared(group).items()
                at, group, apart = key, [], key[1] != key[2]
            group.append((block, node, _points(*(batch.column(c)[k] for c in (5, 6, 7)))))
        yield told(found)
    yield told(compared(group).items())


def _counted(roots: DataFrame, links: DataFrame, points: DataFrame) -> DataFrame:
    """(node, links): how many of its component's other nodes each agrees with. Those of two nodes have their link; others' nodes meet by blocks, and no pair of them is a row."""
    sizes = staged(roots.groupBy("root").agg(F.count("*").alias("of")).withColumn("blocks", F.ceil(F.col("of") / BLOCK).cast("int")), "media-sizes")
    sized = join_weighted(roots, sizes.select("root", "of", F.col("of").alias("n"), "blocks"), "root", "n")
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    met = sized.where("of > 2").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node")
    met = met.join(points, "node").select("root", "i", "j", "block", "node", *POINTS).repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    many = met.mapInArrow(_among, "node long, links long")
    return staged(sized.where("of = 2").select("node", F.lit(1).cast("long").alias("links")).unionByName(many.groupBy("node").agg(F.sum("links").alias("links"))), "media-counts")


def _met(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """keys (key, node) to the pairs (a, b) of each bucket's least node with the others, and to the entries (key, root, node) of buckets of over two, root being the least.

    Keys are counted by an aggregate, so that a hot one is no task's, and joined by weight.
    """
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("root"), F.max("node").alias("last")).where("n > 1")
    shared = staged(shared, "media-shared")
    entries = join_weighted(keys, shared.where("n > 2").select("key", "root", "n"), "key", "n").where("root IS NOT NULL")
    entries = staged(entries.select("key", "root", "node"), "media-buckets")
    pairs = shared.where("n = 2").select(F.col("root").alias("a"), F.col("last").alias("b"))
    pairs = pairs.unionByName(entries.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b")))
    return staged(pairs.distinct(), "media-pairs"), entries


def _across(entries: DataFrame, roots: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b), a < b, that share a key, lie in different components and are not known; a large bucket's are formed by blocks against blocks, in many tasks."""
    of = entries.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of = staged(of, "media-entries")
    mixed = of.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    mixed = staged(mixed.select("key", "n", F.ceil(F.col("n") / BUCKET).cast("int").alias("blocks")), "media-mixed")
    sized = join_weighted(of, mixed, "key", "n").where("blocks IS NOT NULL")
    sized = staged(sized.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")), "media-blocks")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = sized.select("key", F.col("node").alias("a"), F.col("root").alias("of_a"), F.col("block").alias("i"), every.alias("j"))
    right = sized.select("key", F.col("node").alias("b"), F.col("root").alias("of_b"), every.alias("i"), F.col("block").alias("j"))
    pairs = left.join(right, ["key", "i", "j"]).where("a < b AND of_a != of_b").select("a", "b").distinct()
    return staged(pairs.join(known, ["a", "b"], "left_anti"), "media-pairs")


def copies(images: DataFrame) -> DataFrame:
    """image_id, component_id, links of every image (image_id, width, height, pixels: 8 bits of grey, by rows).

    Equal pixels are one class, in which one stands for all; component_id is the smallest id of the classes that links
    reach, null if none has one; links counts the verified ones of the image's class. Any two classes that share a table
    key are compared, and all of a component that links of a bucket's classes with its least make, so that a group of n
    different copies has up to n * (n - 1) / 2 links, all of which are counted, within tasks.
    Rows without an id, and rows of one id with other pixels, are images of their own. Null pixels, and sizes that do not
    fit them, have no points: only equal ones link.
    """
    small_batches(images.sparkSession, 4 * IMAGES)
    shuffles_go(images.sparkSession)
    described = staged(images.select(F.col("image_id").cast("long").alias("image_id"), F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), "pixels").mapInArrow(_descriptors(_tests()), "image_id long, digest binary, xs array<float>, ys array<float>, bits binary"), "media-points")
    any_of = [F.any_value(c).alias(c) for c in POINTS]  # equal pixels have equal points
    classes = described.groupBy("digest").agg(F.min("image_id").alias("first"), F.count("*").alias("n"), *any_of)
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "media-classes")  # numbered once, as written
    points = classes.select("node", *POINTS)
    rows = staged(described.select("image_id", "digest"), "media-rows")
    unstaged(described)
    pairs, entries = _met(points.select("node", "bits").mapInArrow(_keys, "key long, node long"))
    links = _linked(pairs, points)
    roots = staged(connected(links), "media-roots")
    across = _across(entries, roots, pairs)
    counts = _counted(roots, links, points)
    if across.take(1):
        more = _linked(across, points)
        counts = counts.unionByName(more.select(F.explode(F.array("u", "v")).alias("node"), F.lit(1).cast("long").alias("links")))
        roots = staged(connected(links.unionByName(more)), "media-roots")
    counts = counts.groupBy("node").agg(F.sum("links").alias("links"))
    labels = classes.select("digest", "first", "n", "node").join(roots, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labels = staged(labels.select("digest", "first", "n", "root", F.coalesce("links", F.lit(0)).alias("links")), "media-labels")
    least = staged(labels.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("of")), "media-least")
    labels = join_weighted(labels, least, "root", "of").select("digest", "component_id", "links", "n")
    return join_weighted(rows, staged(labels, "media-classes-labelled"), "digest", "n").select("image_id", "component_id", "links")


# --- images to look at: the tables hold none, so each vector is drawn, and once more as a cropped and edited copy

#: Side of an image and of its copy; cells of the grid that a vector is drawn on.
SIDE, CUT, GRID = 96, 78, 24


def _drawn(batches):
    plans: dict = {}
    cell = np.clip((np.arange(SIDE) + 0.5) * GRID / SIDE - 0.5, 0, GRID - 1.001)
    low, part = cell.astype(np.int64), (cell - cell.astype(np.int64)).astype(np.float32)
    for batch in batches:
        ids, out = batch.column(0).to_pylist(), []
        for i, v in zip(ids, batch.column(1), strict=True):
            v = np.nan_to_num(np.asarray(v.values if v.is_valid else [], dtype=np.float32))
            if len(v) not in plans:
                plans[len(v)] = np.random.default_rng(len(v)).normal(0, 1, (GRID * GRID, len(v))).astype(np.float32)
            grid = (plans[len(v)] @ (v / (np.linalg.norm(v) or 1))).reshape(GRID, GRID)
            tall = grid[low] * (1 - part[:, None]) + grid[low + 1] * part[:, None]
            picture = tall[:, low] * (1 - part) + tall[:, low + 1] * part
            grey = np.clip(128 + 45 * picture, 0, 255)
            turn = int(abs(v).sum() * 1e4) if len(v) else 0  # how the copy is cropped and edited follows from the vector
            y, x = turn % (SIDE - CUT), turn // 7 % (SIDE - CUT)
            copy = np.rot90(grey[y : y + CUT, x : x + CUT], turn % 4) * (0.8 + turn % 3 * 0.15) + (turn % 5) * 6
            noise = np.random.default_rng(turn).normal(0, 2, copy.shape)
            for kind, image in ((0, grey), (1, copy + noise)):
                out.append((None if i is None else 2 * i + kind, image.shape[1], image.shape[0], np.clip(image, 0, 255).astype(np.uint8).tobytes()))
        cols = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary())], names=["image_id", "width", "height", "pixels"])


def media_of(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) to image_id, width, height, pixels: 2 * vec_id its picture, and 2 * vec_id + 1 a cropped, turned, brightened and noisy copy."""
    small_batches(vectors.sparkSession, 4 * IMAGES)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_drawn, "image_id long, width int, height int, pixels binary")


def op2_media_copies(spark, sf_dir):
    return copies(media_of(table(spark, sf_dir, "embeddings")))

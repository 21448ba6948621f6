"""SimHash near-duplicates by a generalised pigeonhole search.

Fingerprints of every text are reduced to the distinct ones, so exact copies
cost one probe however many there are. The 64 bits are dealt into partitions
of correlated bits; thresholds t_1..t_m with sum(t) = radius - m + 1 (-1: the
partition is not probed) are chosen by dynamic programming on estimated
candidate counts. By the pigeonhole principle, two fingerprints within
``radius`` bits differ by at most t_i bits on some partition i, so probing
every value within t_i on each partition and verifying the whole
fingerprint loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmart.session import materialize

from .components import connected_components

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
#: Fingerprints drawn for the estimates below; results do not depend on it.
SAMPLE = 4096
BLOCK = 1 << 16
PROBE_COST, CANDIDATE_COST = 1.0, 0.02


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text: bit b is set if over half of its shingles' hashes have it."""
    own = text.lower().split()
    if not own:
        return 0
    joined = b" ".join(own)
    start = np.zeros(len(own) + 1, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in own], out=start[1:])
    n = max(1, len(own) - shingle + 1)
    begin = start[:n].tolist()
    end = (start[min(shingle, len(own)):] - 1).tolist()
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(begin[lo:lo + BLOCK], end[lo:lo + BLOCK], strict=True)], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            fp = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts],
                          dtype=np.uint64).view(np.int64)
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(fp)],
                                             names=[*rest, "fp"])

    return run


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits into ``parts`` groups of near equal size, correlated bits together."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little").astype(float)
    bits -= bits.mean(axis=0)
    scale = np.sqrt((bits ** 2).sum(axis=0)) + 1e-9
    related = np.abs(bits.T @ bits) / np.outer(scale, scale)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        room = -(-len(left) // (parts - k))
        own = [max(sorted(left), key=lambda b: sum(related[b][x] for x in left))]
        left.discard(own[0])
        while len(own) < room:
            nxt = max(sorted(left), key=lambda b: sum(related[b][x] for x in own))
            own.append(nxt)
            left.discard(nxt)
        groups.append(sorted(own))
    return groups


def _ball(width: int, radius: int) -> int:
    return sum(comb(width, r) for r in range(radius + 1))


def allocate(near: list[np.ndarray], widths: list[int], n: int, radius: int
             ) -> tuple[float, list[int]]:
    """Cheapest thresholds with sum radius - m + 1.

    ``near[i][t]`` is the estimated share of pairs that differ by at most t
    bits on partition i; the cost of t is its probes plus its candidates.
    """
    m = len(widths)
    goal = radius - m + 1
    best = {0: (0.0, [])}
    for i in range(m):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, radius + 1):
                own = 0.0 if t < 0 else (PROBE_COST * n * (1 + _ball(widths[i], t))
                                         + CANDIDATE_COST * n * n * near[i][t])
                option = (cost + own, [*chosen, t])
                if used + t not in step or option < step[used + t]:
                    step[used + t] = option
        best = step
    return best[goal]


def plan_search(sample: np.ndarray, n: int, radius: int = RADIUS
                ) -> tuple[list[list[int]], list[int]]:
    """Bit groups and thresholds of least estimated cost for ``n`` fingerprints."""
    found = None
    for m in range(1, radius + 2):
        groups = group_bits(sample, m)
        near = []
        for own in groups:
            mask = np.uint64(sum(1 << b for b in own))
            part = sample & mask
            count = np.zeros(BITS + 1)
            for k in range(0, len(part), 256):
                gap = np.bitwise_count(part[k:k + 256, None] ^ part[None, :])
                count += np.bincount(gap.ravel(), minlength=BITS + 1)
            count[0] -= len(part)
            uniform = np.cumsum([comb(len(own), r) for r in range(radius + 1)]) / 2.0 ** len(own)
            seen = np.cumsum(count)[:radius + 1] / max(1, len(part) * (len(part) - 1))
            near.append(np.maximum(seen, uniform))
        cost, thresholds = allocate(near, [len(g) for g in groups], n, radius)
        if found is None or cost < found[0]:
            found = cost, groups, thresholds
    return found[1], found[2]


def _keys(groups: list[list[int]], thresholds: list[int], probe: bool):
    """Rows (part, key, fp): the fingerprint's own value, or all values that it probes."""
    masks = []
    for i, (own, t) in enumerate(zip(groups, thresholds, strict=True)):
        if t < 0:
            continue
        flips = [0] if not probe else [sum(1 << b for b in c) for r in range(t + 1)
                                       for c in combinations(own, r)]
        masks.append((i, np.uint64(sum(1 << b for b in own)), np.array(flips, dtype=np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column("fp"), dtype=np.int64).view(np.uint64)
            for i, mask, flips in masks:
                step = max(1, (1 << 18) // len(flips))
                for lo in range(0, len(fp), step):
                    own = fp[lo:lo + step]
                    key = ((own & mask)[:, None] ^ flips[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), i, dtype=np.int32)),
                         pa.array(key.view(np.int64)),
                         pa.array(np.repeat(own, len(flips)).view(np.int64))],
                        names=["part", "key", "fp"])

    return run


def similar_fingerprints(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints that differ by 1 to ``radius`` bits."""
    n = distinct.count()
    rows = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    sample = np.array([r.fp for r in rows], dtype=np.int64).view(np.uint64)
    if n < 2:
        return distinct.select(F.col("fp").alias("u"), F.col("fp").alias("v")).filter("u < v")
    groups, thresholds = plan_search(sample, n, radius)
    schema = "part int, key long, fp long"
    data = distinct.select("fp").mapInArrow(_keys(groups, thresholds, False), schema)
    probe = distinct.select("fp").mapInArrow(_keys(groups, thresholds, True), schema)
    a, b = probe.alias("a"), data.alias("b")
    close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius
    return a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.key") == F.col("b.key"))
                  & (F.col("a.fp") < F.col("b.fp")) & close).select(
        F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def _with_roots(distinct: DataFrame, radius: int) -> DataFrame:
    """(fp, root, first): fingerprints with their component."""
    roots = connected_components(similar_fingerprints(distinct, radius))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, radius: int = RADIUS,
                   mark_col: str | None = None) -> DataFrame:
    """Fingerprint and near-duplicate group of every row.

    Words are runs of other bytes than ASCII white space with A-Z in lower
    case; shingles of ``shingle`` words, repeats included, are hashed by XXH64
    with seed 42. Rows link when their fingerprints differ by at most
    ``radius`` bits; a group is a connected component.

    Returns id_col, fp (long) and component (smallest id of the group); one
    row for each input row. With ``mark_col`` also the text's xxhash64 under
    that name, and stays: whether the row is its group's first by id, rows
    without one last, and mark. Other columns of ``docs`` are not read.

    * NULL or empty text, or white space only: fingerprint zero, linked like
      any other.
    * NULL id: the row belongs to its group, but its id is never the smallest
      unless the whole group has none (component is then NULL).
    * Repeated rows: each is returned; they are in one group.
    * Empty table: no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    if mark_col:
        rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"),
                           F.col(text_col).alias("text"))
        prints = materialize(rows.mapInArrow(
            _fingerprints(shingle), f"id {id_type}, mark long, fp long"), "simhash")
        place = F.struct(F.col("id").isNull().alias("none"), "id", "mark")
        distinct = materialize(prints.groupBy("fp").agg(F.min(place).alias("first")), "simhash")
        classes = _with_roots(distinct, radius)
        lowest = classes.groupBy("root").agg(F.min("first").alias("least"))
        labels = classes.join(lowest, "root").select("fp", "least")
        return prints.join(labels, "fp").select(
            F.col("id").alias(id_col), "fp", F.col("least.id").alias("component"),
            F.col("mark").alias(mark_col), (place == F.col("least")).alias("stays"))
    prints = materialize(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(_fingerprints(shingle), f"id {id_type}, fp long"), "simhash")
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash")
    classes = _with_roots(distinct, radius)
    smallest = classes.groupBy("root").agg(F.min("first").alias("component"))
    labels = classes.join(smallest, "root").select("fp", "component")
    return prints.join(labels, "fp").select(F.col("id").alias(id_col), "fp", "component")

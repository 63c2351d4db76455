"""Items into containers of fixed capacity with little unused space.

Linear grouping: large items, sorted by size, fall into groups of equal
cardinality and are rounded up to the largest of their group; a plan over these
few sizes is optimised by column generation; the plan's places are then filled
with the actual items, and the small items go where they fit best.

The driver sees only counts per size, of which there are at most ``capacity``.
A plan says "container kind p, so many times", so the container of an item is
arithmetic on the item's rank: it is joined to rules, of which there are few,
not to containers.
"""

from __future__ import annotations

import bisect
import logging

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import with_position
from ..session import cut

_log = logging.getLogger(__name__)

GROUPS = 64
SMALL = 1 / 8  # items of at most this share of the capacity are small


def linear_groups(hist: dict[int, int], groups: int) -> list[tuple[int, int]]:
    """(rounded size, items), largest first; groups differ by at most one size's items.

    Items of one size never lie in different groups, so a size that fills a whole
    group is not rounded at all.
    """
    total = sum(hist.values())
    out: list[tuple[int, int]] = []
    top = held = 0
    for s in sorted(hist, reverse=True):
        top = top or s
        held += hist[s]
        if held * groups >= total:
            out.append((top, held))
            top = held = 0
    if held:
        out.append((top, held))
    return out


def _price(values: np.ndarray, sizes: np.ndarray, limits: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern with the greatest value: bounded knapsack by rows of multiples."""
    best = np.zeros(capacity + 1)
    took = np.zeros((len(sizes), capacity + 1), dtype=np.int16)
    for i, (v, s) in enumerate(zip(values, sizes, strict=True)):
        base = best.copy()
        for m in range(1, min(int(limits[i]), capacity // int(s)) + 1):
            if v <= 0:
                break
            cand = np.full(capacity + 1, -1.0)
            cand[m * s :] = base[: capacity + 1 - m * s] + m * v
            better = cand > best + 1e-12
            best[better], took[i, better] = cand[better], m
    pattern, room = np.zeros(len(sizes), dtype=np.int64), capacity
    for i in range(len(sizes) - 1, -1, -1):
        pattern[i] = took[i, room]
        room -= int(pattern[i]) * int(sizes[i])
    return float(best[capacity]), pattern


def optimise(sizes: list[int], demand: list[int], capacity: int) -> tuple[list[tuple[np.ndarray, int]], int]:
    """Container kinds (items of each size) and how often, for all of ``demand``; and a lower bound of their number.

    Column generation on the linear relaxation until no kind of container would
    improve it; its solution is rounded down and the few items left over are packed
    by best fit, largest first.  The demand is raised by tiny unequal amounts, so
    that no exchange of columns leaves the solution as it was and the same columns
    never come back.
    """
    m = len(sizes)
    if not m:
        return [], 0
    sz, need = np.array(sizes), np.array(demand, dtype=float)
    cols = [np.eye(m, dtype=np.int64)[i] * min(capacity // sizes[i], demand[i]) for i in range(m)]
    basis = np.array(cols, dtype=float).T
    raised, bound, last = need + 1e-4 * (1 + np.arange(m)) / m, 0.0, np.inf
    while True:
        price = np.linalg.solve(basis.T, np.ones(m))
        worth, pattern = _price(price, sz, np.array(demand), capacity)
        bound = max(bound, float(price @ need) / max(1.0, worth))  # prices over the best worth are a dual solution
        if worth <= 1 + 1e-7:
            break
        way, x = np.linalg.solve(basis, pattern.astype(float)), np.linalg.solve(basis, raised)
        if x.sum() >= last:  # below what doubles can tell apart
            break
        last = x.sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(way > 1e-9, x / way, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        basis[:, out], cols[out] = pattern, pattern
    x = np.linalg.solve(basis, need)
    left, plan = np.array(demand), []
    for j in np.argsort(-x):
        n = int(np.floor(x[j] + 1e-6))
        used = cols[j] > 0
        if used.any():
            n = min(n, int((left[used] // cols[j][used]).min()))
        if n > 0 and used.any():
            plan.append((cols[j].copy(), n))
            left = left - n * cols[j]
    # what rounding down left: fewer than one container of each kind
    loose: list[tuple[int, np.ndarray]] = []
    for i in range(m):
        while left[i] > 0:
            room = [k for k, (r, _) in enumerate(loose) if r >= sizes[i]]
            if not room:
                q = min(int(left[i]), capacity // sizes[i])
                whole = int(left[i]) // (capacity // sizes[i])
                if whole > 1:  # many of one kind
                    p = np.zeros(m, dtype=np.int64)
                    p[i] = q
                    plan.append((p, whole))
                    left[i] -= whole * q
                    continue
                loose.append((capacity, np.zeros(m, dtype=np.int64)))
                room = [len(loose) - 1]
            k = min(room, key=lambda j: loose[j][0])
            r, p = loose[k]
            p = p.copy()
            p[i] += 1
            loose[k] = (r - sizes[i], p)
            left[i] -= 1
    return plan + [(p, 1) for _, p in loose], int(np.ceil(bound - 1e-6))


def place_large(groups: list[tuple[int, int]], plan: list[tuple[np.ndarray, int]]) -> tuple[list[tuple[int, int, int, int]], int]:
    """Rules (lo, hi, container, per) on the rank of large items, and the containers used.

    Item of rank r in [lo, hi) goes to container ``container + (r - lo) // per``.
    """
    start = np.cumsum([0] + [n for _, n in groups])[:-1]
    done = np.zeros(len(groups), dtype=np.int64)
    rules, box = [], 0
    for pattern, n in plan:
        for g in np.flatnonzero(pattern):
            per = int(pattern[g])
            take = min(per * n, groups[g][1] - int(done[g]))
            if take > 0:
                lo = int(start[g] + done[g])
                rules.append((lo, lo + take, box, per))
                done[g] += take
        box += n
    return rules, box


def place_small(small: dict[int, int], room: dict[int, int], boxes: int, capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rules (size, lo, hi, place, per) for small items, largest first, by best fit.

    ``room`` counts containers by free space; a *place* is a container's rank by
    free space (0 to boxes - 1) or, from ``boxes`` on, a new container.  All
    containers of equal free space are handled as ranges, never one by one.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    at = 0
    for r in sorted(room):
        free[r] = [(at, at + room[r])]
        at += room[r]
    keys = sorted(free)
    rules, new = [], boxes

    def give(r: int, lo: int, hi: int) -> None:
        if r <= 0:
            return
        if r not in free:
            bisect.insort(keys, r)
            free[r] = []
        free[r].append((lo, hi))

    for s in sorted(small, reverse=True):
        left, rank = small[s], 0
        while left > 0:
            i = bisect.bisect_left(keys, s)
            if i == len(keys):
                n = -(-left // (capacity // s))
                give(capacity, new, new + n)
                new += n
                continue
            r = keys[i]
            lo, hi = free[r].pop()
            if not free[r]:
                del free[r]
                keys.pop(i)
            per = r // s  # what is left after one item fits better than any other space
            boxes_full = min(hi - lo, left // per)
            if boxes_full:
                rules.append((s, rank, rank + boxes_full * per, lo, per))
                give(r - per * s, lo, lo + boxes_full)
                rank += boxes_full * per
                left -= boxes_full * per
                lo += boxes_full
            if left and lo < hi:  # fewer than one container takes
                rules.append((s, rank, rank + left, lo, left))
                give(r - left * s, lo, lo + 1)
                rank, left, lo = rank + left, 0, lo + 1
            if lo < hi:
                give(r, lo, hi)
    return rules, new


def _first_ranks(hist: dict[int, int]) -> dict[int, int]:
    """Rank of the first item of each size when items stand largest first."""
    out, at = {}, 0
    for s in sorted(hist, reverse=True):
        out[s], at = at, at + hist[s]
    return out


def _by_size(rules: list[tuple[int, int, int, int]], hist: dict[int, int], first: dict[int, int]) -> list[tuple[int, int, int, int, int, int]]:
    """Rules (lo, hi, place, per) on ranks, cut at the borders of sizes: (size, from, to, lo, place, per)."""
    sizes = sorted(hist, reverse=True)
    starts = [first[s] for s in sizes]
    out = []
    for lo, hi, place, per in rules:
        i = bisect.bisect_right(starts, lo) - 1
        while i < len(sizes) and starts[i] < hi:
            out.append((sizes[i], max(lo, starts[i]), min(hi, starts[i] + hist[sizes[i]]), lo, place, per))
            i += 1
    return out


def _assign(items: DataFrame, rules: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """``items`` with ``_place``, by their size and rank.

    A hash join on the size; the rules number at most the sizes, of which there
    are no more than the capacity, plus those of the plan.
    """
    table = items.sparkSession.createDataFrame(rules, "_s long, _from long, _to long, _lo long, _first_place long, _per long")
    met = items.join(F.broadcast(table), "_s").where((F.col("_pos") >= F.col("_from")) & (F.col("_pos") < F.col("_to")))
    place = F.col("_first_place") + F.floor((F.col("_pos") - F.col("_lo")) / F.col("_per"))
    return met.withColumn("_place", place.cast("long")).drop("_from", "_to", "_lo", "_first_place", "_per")


def pack(items: DataFrame, key: str, size: str, capacity: int, groups: int = GROUPS, small: float = SMALL) -> DataFrame:
    """(key, piece, first, last, container) for every item.

    ``first`` to ``last`` (without ``last``) is the piece's range in its item.  An
    item over ``capacity`` is divided into full pieces, each a container of its
    own, and a rest that is packed like any item; other items are one piece.
    Items of size 0 (and null sizes) take no space and go to container 0.
    Containers are numbered from 0.  ``key`` must be unique.  An empty table gives
    no rows.
    """
    spark = items.sparkSession
    rows = cut(items.select(F.col(key), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_n")))
    full = F.floor(F.col("_n") / capacity).cast("int")
    rest = rows.select(key, full.alias("piece"), (full * F.lit(capacity)).cast("long").alias("first"), F.col("_n").alias("last"), (F.col("_n") - full * F.lit(capacity)).alias("_s"))
    empty = rest.where("last = 0").select(key, "piece", "first", "last", F.lit(0).cast("long").alias("container"))

    order = with_position(rest.where("_s > 0"), F.col("_s").desc(), F.col(key), name="_pos")
    hist = {r["_s"]: r["n"] for r in order.groupBy("_s").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    limit = int(capacity * small)
    large, tiny = {s: n for s, n in hist.items() if s > limit}, {s: n for s, n in hist.items() if s <= limit}
    grouped = linear_groups(large, groups)
    plan, bound = optimise([s for s, _ in grouped], [n for _, n in grouped], capacity)
    rules, boxes = place_large(grouped, plan)
    _log.info("%d containers for large items, at least %d as they are rounded", boxes, bound)

    first = _first_ranks(hist)
    big = _assign(order.where(F.col("_s") > limit), _by_size(rules, hist, first)).select(key, "piece", "first", "last", "_s", F.col("_place").alias("container"))
    big = cut(big)

    used = big.groupBy("container").agg((F.lit(capacity) - F.sum("_s")).alias("_room"))
    used = with_position(used, F.col("_room"), F.col("container"), name="_place")
    room = {r["_room"]: r["n"] for r in used.groupBy("_room").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    filled = sum(room.values())
    fit, end = place_small(tiny, room, filled, capacity)
    fit = [(first[s] + lo, first[s] + hi, place, per) for s, lo, hi, place, per in fit]
    low = _assign(order.where(F.col("_s") <= limit), _by_size(fit, hist, first)).join(used.select("_place", "container"), "_place", "left")
    fresh = F.col("_place") - F.lit(filled) + F.lit(boxes)
    low = low.select(key, "piece", "first", "last", F.coalesce("container", fresh).alias("container"))

    many = rows.where(F.col("_n") >= capacity).select(key, F.explode(F.sequence(F.lit(0), full - 1)).alias("piece"))
    whole = with_position(many, F.col(key), F.col("piece"), name="_at").select(
        key, "piece",
        (F.col("piece") * F.lit(capacity)).cast("long").alias("first"), ((F.col("piece") + 1) * F.lit(capacity)).cast("long").alias("last"),
        (F.col("_at") + F.lit(boxes + end - filled)).cast("long").alias("container"),
    )
    return big.drop("_s").unionByName(low).unionByName(whole).unionByName(empty)

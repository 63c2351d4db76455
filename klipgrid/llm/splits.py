"""Splits that keep related records together.

Components by parallel hooking and shortcutting over a parent table, then
split totals by subset sums over the multiplicities of component sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import with_position
from ..operators.skew import hot_values, join_unique
from ..session import cut

MAX_BITS = 1 << 22  # of subset-sum bitsets kept for the way back: 512 kB


def links_through(df: DataFrame, node: str, via: str) -> DataFrame:
    """Edges (a, b) between nodes that share a value of ``via``: a star each.

    All nodes of a ``via`` are linked to its smallest one, so a value shared by
    k nodes gives k - 1 edges, not all pairs.  Nulls link nothing.
    """
    rows = df.where(F.col(node).isNotNull() & F.col(via).isNotNull()).select(F.col(node).alias("b"), F.col(via).alias("_via"))
    hub = rows.groupBy("_via").agg(F.min("b").alias("a"), F.max("b").alias("_z")).where("a < _z").drop("_z")
    return join_unique(cut(rows), hub, "_via").where("a < b").select("a", "b").distinct()


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, root): the smallest node of each node's connected component.

    Each round every edge offers the grandparents of its ends to each other's
    parents and to the ends themselves (hooking), takes the minimum, and then
    parents are replaced by their parents (shortcutting).  Roots only fall, so
    the rounds end; on paths they are logarithmic.  Each round's table is written
    to the shared folder.
    """
    # parents of nodes without an edge never change, so only linked nodes take part
    both = cut(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")))
    hubs = hot_values(both, "v")
    parent = cut(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("_m")).select("node", F.least("node", "_m").alias("root")))
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("g"))
        # most nodes may have one parent, and one node most of the edges
        grand = cut(join_unique(parent, up, "root").select("node", "root", "g"))  # g: the parent's parent
        offers = join_unique(both, grand.select(F.col("node").alias("v"), F.col("g").alias("gv")), "v", hot=hubs).groupBy(F.col("u").alias("node")).agg(F.min("gv").alias("gv"))
        near = grand.join(offers, "node").select("node", "root", F.least("g", "gv").alias("m"))
        # to the node itself, and to its parent
        lower = near.select("node", "m").union(near.select("root", "m")).groupBy("node").agg(F.min("m").alias("m"))
        nxt = parent.join(lower, "node", "left").select("node", "root", F.least("root", F.coalesce("m", "root")).alias("new"))
        nxt = cut(nxt)
        moved = nxt.where("new < root").limit(1).count()
        parent = nxt.select("node", F.col("new").alias("root"))
        if not moved:
            break
    if nodes is None:
        return parent
    return nodes.join(parent, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def choose_counts(sizes: dict[int, int], target: int, max_bits: int = MAX_BITS) -> dict[int, int]:
    """How many components of each size to take so their total is closest to ``target``.

    ``sizes`` maps size to multiplicity.  A bitset holds the reachable totals;
    each multiplicity is cut into powers of two.  Of two equally close totals the
    smaller is taken.  The way back needs the bitset before each step: of chains
    with more than ``max_bits`` only the middle is made, and each half is worked
    off by itself, so at most one bitset a halving is held and the choice is exact
    at any size.
    """
    taken: dict[int, int] = {}
    total = sum(s * m for s, m in sizes.items())
    target = max(0, min(target, total))
    limit = min(total, target + max(sizes, default=0))
    mask = (1 << (limit + 1)) - 1
    steps: list[tuple[int, int]] = []  # size, how many
    for s, m in sorted(sizes.items(), reverse=True):
        m, k = min(m, limit // s if s else 0), 1
        while m > 0:
            k = min(k, m)
            steps.append((s, k))
            m, k = m - k, k * 2

    def reached(bits: int, lo: int, hi: int) -> int:
        for s, k in steps[lo:hi]:
            bits |= (bits << (s * k)) & mask
        return bits

    bits = reached(1, 0, len(steps))
    below = bits & ((1 << (target + 1)) - 1)
    lo = below.bit_length() - 1
    above = bits >> (target + 1)
    hi = target + 1 + (above & -above).bit_length() - 1 if above else None
    at = lo if hi is None or target - lo <= hi - target else hi
    del bits, below, above

    def back(before: int, lo: int, hi: int, at: int) -> int:
        """Undo steps ``hi`` - 1 to ``lo`` from total ``at``; ``before`` is reachable before ``lo``."""
        if hi - lo > 1 and (hi - lo) * (limit + 1) > max_bits:
            mid = (lo + hi) // 2
            return back(before, lo, mid, back(reached(before, lo, mid), mid, hi, at))
        chain = [before]
        for i in range(lo, hi - 1):
            chain.append(reached(chain[-1], i, i + 1))
        for (s, k), b in zip(reversed(steps[lo:hi]), reversed(chain)):
            if not b >> at & 1:
                at -= s * k
                taken[s] = taken.get(s, 0) + k
        return at

    if steps:
        back(1, 0, len(steps), at)
    return taken


def choose_splits(sizes: dict[int, int], permille: dict[str, int]) -> dict[tuple[str, int], int]:
    """Number of components of each (split, size); smaller splits choose first."""
    total = sum(s * m for s, m in sizes.items())
    left, out = dict(sizes), {}
    names = sorted(permille, key=lambda x: (permille[x], x))
    for name in names[:-1]:
        got = choose_counts(left, round(total * permille[name] / 1000))
        for s, n in got.items():
            out[name, s] = n
            left[s] -= n
    for s, n in left.items():
        out[names[-1], s] = n
    return out


def _rules(spark: SparkSession, picked: dict[tuple[str, int], int]) -> DataFrame:
    rows, start = [], {}
    for (name, size), n in sorted(picked.items()):
        if n:
            lo = start.get(size, 0)
            rows.append((size, lo, lo + n, name))
            start[size] = lo + n
    return spark.createDataFrame(rows, "size long, lo long, hi long, split string")


def related_splits(df: DataFrame, record: str, relation: str, permille: dict[str, int]) -> DataFrame:
    """(record, split) for every non-null record id of ``df``.

    Records that share a non-null ``relation`` value, directly or through other
    records, get the same split.  A record without any relation is a component of
    its own.  Repeated rows change nothing; an empty table gives no rows.
    The table of sizes brought to the driver has at most sqrt(2 n) rows.
    """
    spark = df.sparkSession
    rows = df.where(F.col(record).isNotNull()).select(F.col(record).alias("_rec"), F.col(relation).alias("_rel")).distinct()
    rows = cut(rows)
    root = components(links_through(rows, "_rel", "_rec"))
    first = rows.groupBy("_rec").agg(F.min("_rel").alias("node"))
    comp = join_unique(cut(first), root, "node", "left").select(
        "_rec", F.when(F.col("node").isNull(), F.concat(F.lit("r:"), F.col("_rec").cast("string"))).otherwise(F.concat(F.lit("c:"), F.coalesce("root", "node").cast("string"))).alias("comp")
    )
    comp = cut(comp)
    sized = comp.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    order = with_position(sized, F.col("size"), F.col("comp"))
    order = cut(order)
    hist = order.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("start"))
    table = {r["size"]: r["n"] for r in hist.collect()}  # one row per different size
    if not table:
        return comp.select(F.col("_rec").alias(record), F.lit(None).cast("string").alias("split"))
    rules = F.broadcast(_rules(spark, choose_splits(table, permille)))  # splits x different sizes
    ranked = order.join(F.broadcast(hist.select("size", "start")), "size").withColumn("_r", F.col("pos") - F.col("start"))
    placed = ranked.join(rules, "size").where((F.col("_r") >= F.col("lo")) & (F.col("_r") < F.col("hi"))).select("comp", "split")
    return join_unique(comp, placed, "comp").select(F.col("_rec").alias(record), "split")


def related_groups(df: DataFrame, node: str, via: str) -> DataFrame:
    """(node, root, n): the component of each linked node and how many nodes it has, a row per node."""
    root = components(links_through(df, node, via))
    return join_unique(root, root.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "root").select("node", "root", "n")


def related_pairs(df: DataFrame, node: str, via: str) -> DataFrame:
    """All pairs (a, b), a < b, of different nodes of one component.

    There are as many as the square of a component; ``related_groups`` says the
    same in a row per node.
    """
    root = components(links_through(df, node, via))
    left, right = root.select("root", F.col("node").alias("a")), root.select("root", F.col("node").alias("b"))
    return left.join(right, "root").where("a < b").select("a", "b")

"""Continuous periods and gaps of overlapping integer intervals.

The aggregate state is a list of sorted, disjoint intervals.  States merge by
linear merge, so they can be combined in any tree: map tasks build a state per
key and time block from their own rows, levels of a reduction tree merge up to
``FAN`` states each, and one pass stitches blocks that touch.  A state covers at
most ``BLOCK`` positions, so it never exceeds ``BLOCK / 2`` intervals however
many rows a key has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut

BLOCK = 1 << 16  # positions of one state
FAN = 64  # states that one node of the tree merges
FLUSH = 1 << 20  # intervals a map task holds before it hands states on


def merge_sorted(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Disjoint, non-touching intervals of each group; any order in, sorted out.

    The stable sort is a run-merging sort: concatenated sorted states cost
    linear time.  Intervals that touch (end + 1 = next start) become one.
    """
    if len(start) == 0:
        return group, start, end
    span = int(end.max()) - int(start.min()) + 3
    shift = group.astype(np.int64) * span - int(start.min())
    s, e = start + shift, end + shift
    order = np.argsort(s, kind="stable")
    s, e, g = s[order], e[order], group[order]
    reach = np.maximum.accumulate(e)
    first = np.flatnonzero(np.r_[True, s[1:] > reach[:-1] + 1])
    last = np.r_[first[1:] - 1, len(s) - 1]
    g = g[first]
    back = g.astype(np.int64) * span - int(start.min())
    return g, s[first] - back, reach[last] - back


def _split_blocks(key: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut intervals at block borders: key, block, start, end."""
    b0 = s // BLOCK
    n = e // BLOCK - b0 + 1
    rep = np.repeat(np.arange(len(s)), n)
    block = b0[rep] + (np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n))
    return key[rep], block, np.maximum(s[rep], block * BLOCK), np.minimum(e[rep], block * BLOCK + BLOCK - 1)


_STATE = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("block", T.LongType()), T.StructField("node", T.LongType()),
    T.StructField("starts", T.ArrayType(T.LongType(), False)), T.StructField("ends", T.ArrayType(T.LongType(), False)),
])
_ARROW = pa.schema([("key", pa.string()), ("block", pa.int64()), ("node", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[cuts, len(values)], pa.int32()), pa.array(values, pa.int64()))


def _emit(names: list[str], key: np.ndarray, block: np.ndarray, s: np.ndarray, e: np.ndarray, node: int) -> Iterator[pa.RecordBatch]:
    """States of (key, block) from disjoint pieces sorted by both."""
    for i in range(0, len(s), FLUSH):
        k, b, x, y = key[i : i + FLUSH], block[i : i + FLUSH], s[i : i + FLUSH], e[i : i + FLUSH]
        cuts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (b[1:] != b[:-1])])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()).take(pa.array(k[cuts])), pa.array(b[cuts]), pa.array(np.full(len(cuts), node)), _lists(x, cuts), _lists(y, cuts)], schema=_ARROW
        )


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States of a map task, built as its rows stream by."""
    node = TaskContext.get().partitionId()
    code: dict[str, int] = {}
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def out() -> Iterator[pa.RecordBatch]:
        if held:
            k, s, e = merge_sorted(*(np.concatenate(x) for x in zip(*held, strict=True)))
            k, b, s, e = _split_blocks(k, s, e)
            yield from _emit(list(code), k, b, s, e, node)
        held.clear()
        code.clear()

    for batch in batches:
        words = batch.column(0).dictionary_encode()
        names = words.dictionary.to_pylist()
        own = np.array([code.setdefault(x, len(code)) for x in names], dtype=np.int64)
        k = own[words.indices.to_numpy(zero_copy_only=False)] if names else np.zeros(0, np.int64)
        held.append(merge_sorted(k, *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))))
        if sum(len(x[1]) for x in held) > FLUSH:
            held[:] = [merge_sorted(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            if len(held[0][1]) > FLUSH // 2:
                yield from out()
    yield from out()


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list-of-lists column, and how many each row has."""
    inner = col.flatten()
    per = np.diff(inner.offsets.to_numpy())
    ends = np.r_[0, np.cumsum(per)]
    off = col.offsets.to_numpy() - col.offsets.to_numpy()[0]
    return inner.flatten().to_numpy(zero_copy_only=False), np.diff(ends[off])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One node of the tree a row: lists of states in, one state out."""
    for b in batches:
        if not b.num_rows:
            continue
        starts, per = _flat(b.column("starts"))
        ends, _ = _flat(b.column("ends"))
        row, s, e = merge_sorted(np.repeat(np.arange(b.num_rows), per), starts, ends)
        cuts = np.searchsorted(row, np.arange(b.num_rows))
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("block"), b.column("node"), _lists(s, cuts), _lists(e, cuts)], schema=_ARROW)


def interval_states(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """One merged state per (key, block) of the valid intervals of ``df``."""
    rows = df.where(F.col(key).isNotNull() & (F.col(end) >= F.col(start))).select(
        F.col(key).cast("string"), F.col(start).cast("long"), F.col(end).cast("long")
    )
    width = max(1, rows.rdd.getNumPartitions())  # map tasks, hence states a (key, block) can have
    states = rows.mapInArrow(_partial, _STATE)
    while True:
        width = -(-width // FAN)
        node = F.pmod("node", F.lit(width)).alias("node")
        grouped = states.groupBy("key", "block", node).agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))
        states = grouped.mapInArrow(_merge, _STATE)
        if width == 1:
            return states


def periods_and_gaps(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Covered periods of each key and the gaps between them.

    Both bounds belong to an interval.  Rows with a null key, a null bound or
    end < start cover nothing; repeated rows change nothing; touching intervals
    are one period.  Columns: ``key``, ``kind`` ('period' or 'gap'), ``start``,
    ``end``.  A key with one period has no gap; an empty table gives no rows.

    A state lists the pieces of one block, so all but its first and last piece are
    periods already, and the gaps between its pieces are gaps.  Only the outer
    pieces are stitched over the borders of blocks: a window sees at most two rows
    per ``BLOCK`` positions of a key, however many intervals it has.
    """
    states = cut(interval_states(df, key, start, end).withColumn("n", F.size("starts")))
    row = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("start"), b.alias("end"))
    at = lambda c, i: F.element_at(c, i)
    # complete within a block: inner pieces, and what lies between two pieces
    own = F.concat(
        F.when(F.col("n") > 2, F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda i: row("period", at("starts", i), at("ends", i)))).otherwise(F.array()),
        F.when(F.col("n") > 1, F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda i: row("gap", at("ends", i) + 1, at("starts", i + 1) - 1))).otherwise(F.array()),
    )
    inner = states.where("n > 1").select("key", F.inline(own))
    piece = lambda i: F.struct(at("starts", i).alias("s"), at("ends", i).alias("e"))
    outer = states.select("key", "block", F.inline(F.when(F.col("n") > 1, F.array(piece(F.lit(1)), piece(F.lit(-1)))).otherwise(F.array(piece(F.lit(1))))))
    seq = Window.partitionBy("key").orderBy("s")
    before = outer.withColumns({"prev": F.lag("e").over(seq), "same": F.coalesce(F.lag("block").over(seq) == F.col("block"), F.lit(False))})
    apart = F.col("prev").isNull() | (F.col("s") > F.col("prev") + 1)
    before = before.withColumn("no", F.sum(apart.cast("long")).over(seq.rowsBetween(Window.unboundedPreceding, 0)))
    # the gap between the pieces of one block is listed above
    gaps = before.where(F.col("prev").isNotNull() & ~F.col("same") & (F.col("s") > F.col("prev") + 1)).select("key", F.lit("gap").alias("kind"), (F.col("prev") + 1).alias("start"), (F.col("s") - 1).alias("end"))
    whole = before.groupBy("key", "no").agg(F.min("s").alias("start"), F.max("e").alias("end")).select("key", F.lit("period").alias("kind"), "start", "end")
    return inner.unionByName(whole).unionByName(gaps)

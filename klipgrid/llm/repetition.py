"""Repeated content inside one document, judged by a learned decision list.

The exact share of repeated content needs a walk through the text in Python.
What a few counts say about it comes cheap, as Spark expressions; a decision list
learned over these counts settles most documents, and only the others are walked
through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DROP = regex.compile(r"[^\p{L}\p{M}\p{N}]+")
_BLANKS = r"[\x{09}-\x{0D}\x{1C}-\x{1F}\x{85}\p{Z}]+"  # what Python's str.split takes for blanks
_CACHE = 1 << 17

#: Counted for each document; the first three are bounds of the share from above, the next from below.
STATS = ["top_1", "top_2", "top_3", "low_3", "n_words", "n_different", "per_different", "n_chars", "chars_per_word", "n_lines"]
ABOVE, BELOW = ("top_1", "top_2", "top_3"), ("low_3",)


class _Words:
    """Token -> compared form; the cache is emptied when full, which changes no result."""

    def __init__(self) -> None:
        self.seen: dict[str, str] = {}

    def __call__(self, text: str) -> list[str]:
        if len(self.seen) > _CACHE:
            self.seen.clear()
        out, seen = [], self.seen
        for t in text.split():
            w = seen.get(t)
            if w is None:
                w = seen[t] = _DROP.sub("", t).casefold()
            if w:
                out.append(w)
        return out


def repeated_words(words: list, run: int = 3) -> int:
    """Words inside a run of ``run`` words that also starts earlier."""
    seen: set = set()
    covered = upto = 0  # words before ``upto`` are counted already
    for i in range(len(words) - run + 1):
        gram = tuple(words[i : i + run])
        if gram in seen:
            covered += i + run - max(i, upto)
            upto = i + run
        else:
            seen.add(gram)
    return covered


def exact_shares(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``share``: the share of words in repeated runs, by walking through each text.

    0 for null, empty and wordless texts.
    """
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("share", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            out = []
            for t in b.column(len(keys)).to_pylist():
                w = words(t) if t else []
                out.append(repeated_words(w) / len(w) if w else 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(out, pa.float64())], names=[*keys, "share"])

    return df.select(*keys, text).mapInArrow(run, schema)


def counted(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, ``_text`` and the columns ``STATS``, as Spark expressions.

    With n words, d1 different words, and d2, d3 different runs of two and three:
    a word in a run that stood before is a word that stood before, so at most
    n - d1 words are repeated content.  Each repeated run of three holds two
    repeated runs of two, and a stretch of L words at least 2L/3 of them, so at
    most 1.5 (n - 1 - d2) words are; each repeated run of three covers at most
    three words, so at most 3 (n - 2 - d3) are, and at least n - 2 - d3 + 2.

    Upper bounds must not miss an equality, lower ones not invent one.  So words
    are compared in capitals above (coarser than folding) and in small letters
    below (finer).  Texts with code points that this JVM doesn't know may be split
    otherwise in Python: their bounds say nothing.  Runs are compared by 64-bit
    hashes.
    """
    plain = F.regexp_replace(F.coalesce(F.col("_text"), F.lit("")), r"[^\p{L}\p{M}\p{N}\x{09}-\x{0D}\x{1C}-\x{1F}\x{85}\p{Z}]", "")
    split = lambda c: F.filter(F.split(c, _BLANKS), lambda x: x != "")
    hashes = lambda c: F.transform(split(c), lambda x: F.xxhash64(x))
    rows = df.select(*keys, F.col(text).alias("_text"))
    # a generator of one row is a border over which no filter is pushed, so that words are split once, not once in each use
    once = lambda df, keep, cols: df.select(*keep, F.inline(F.array(F.struct(*cols))))
    rows = once(rows, [*keys, "_text"], [plain.alias("_p")])
    rows = once(rows, [*keys, "_text", "_p"], [hashes(F.upper(F.lower("_p"))).alias("_u"), hashes(F.lower("_p")).alias("_l")])
    n = F.size("_u")
    runs = lambda c, k: F.size(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.xxhash64(*[F.try_element_at(F.col(c), i + j) for j in range(k)]))))
    rows = once(rows, [*keys, "_text", "_p"], [x.alias(a) for a, x in {
        "n": n.cast("double"), "d1": F.size(F.array_distinct("_u")).cast("double"), "d2": runs("_u", 2).cast("double"), "d3": runs("_u", 3).cast("double"), "e3": runs("_l", 3).cast("double"),
        "odd": F.coalesce(F.col("_text").rlike(r"\p{Cn}"), F.lit(False)),
    }.items()])
    c = F.col
    per = lambda x: F.when(c("odd"), F.lit(1.0)).when(c("n") > 0, F.least(F.lit(1.0), x / c("n"))).otherwise(F.lit(0.0))
    again = c("n") - 2 - c("e3")
    return rows.select(
        *keys, "_text", per(c("n") - c("d1")).alias("top_1"), F.when(c("n") < 3, per(F.lit(0.0))).otherwise(per((c("n") - 1 - c("d2")) * 1.5)).alias("top_2"),
        F.when(c("n") < 3, per(F.lit(0.0))).otherwise(per((c("n") - 2 - c("d3")) * 3)).alias("top_3"),
        F.when(~c("odd") & (c("n") >= 3) & (again > 0), (again + 2) / c("n")).otherwise(F.lit(0.0)).alias("low_3"),
        c("n").alias("n_words"), c("d1").alias("n_different"), F.when(c("n") > 0, c("n") / c("d1")).otherwise(F.lit(0.0)).alias("per_different"),
        F.length("_p").cast("double").alias("n_chars"), F.when(c("n") > 0, F.length("_p") / c("n")).otherwise(F.lit(0.0)).alias("chars_per_word"),
        F.size(F.split(F.coalesce("_text", F.lit("")), "\n")).cast("double").alias("n_lines"),
    )


class DecisionList:
    """Ordered rules: conjunctions of thresholds, each naming a class.

    Sequential covering: a rule grows by the condition with the best gain until
    it covers no other class on the growing part, is pruned back while that does
    not hurt on the pruning part, and the rows it covers are taken away.  A
    threshold stands at the outermost covered row, never between rows, so a rule
    claims no ground that it has not seen; rows that no rule covers get no class.
    """

    def __init__(self, rules: list[tuple[list[tuple[str, str, float]], str]]) -> None:
        self.rules = rules

    @staticmethod
    def _grow(x: np.ndarray, y: np.ndarray, tried: list[int], max_conditions: int) -> list[tuple[int, str, float]]:
        live, rule = np.ones(len(y), bool), []
        while (live & ~y).any() and len(rule) < max_conditions:
            p0, n0 = (live & y).sum(), (live & ~y).sum()
            base = np.log2(p0 / (p0 + n0))
            best = None
            for j in tried:
                v = x[live, j]
                pos = y[live]
                order = np.argsort(v, kind="stable")
                v, pos = v[order], pos[order]
                cp, tot = np.cumsum(pos), np.arange(1, len(v) + 1)
                # '<=' ends where the value changes after a positive row; '>=' begins at one
                for op, p, t, edge in (("<=", cp, tot, np.r_[v[1:] != v[:-1], False]), (">=", p0 - np.r_[0, cp[:-1]], len(v) - np.arange(len(v)), np.r_[False, v[1:] != v[:-1]])):
                    ok = edge & (p > 0)
                    if not ok.any():
                        continue
                    gain = np.where(ok, p * (np.log2(np.maximum(p, 1) / t) - base), -1.0)
                    k = int(np.argmax(gain))
                    if gain[k] > 0 and (best is None or gain[k] > best[0] + 1e-9):
                        best = (gain[k], j, op, v[k])
            if best is None:
                break
            _, j, op, at = best
            keep = x[:, j] <= at if op == "<=" else x[:, j] >= at
            inside = x[live & keep & y, j]  # back to the outermost row of the class
            at = float(inside.max() if op == "<=" else inside.min())
            rule.append((j, op, at))
            live &= x[:, j] <= at if op == "<=" else x[:, j] >= at
        return rule

    @staticmethod
    def _covers(x: np.ndarray, rule: list[tuple[int, str, float]]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for j, op, at in rule:
            out &= x[:, j] <= at if op == "<=" else x[:, j] >= at
        return out

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray, names: list[str], max_rules: int = 16, max_conditions: int = 4, first: dict[str, tuple[str, ...]] | None = None) -> DecisionList:
        """Learn from rows ``x`` with classes ``labels``; rarer classes come first.

        Of equally good conditions the one on a column in ``first`` of the class wins.

        Every third row is for pruning.  A class whose rows give no pure rule
        gets none; without rows the list is empty.
        """
        rules = []
        kinds, counts = np.unique(labels, return_counts=True) if len(labels) else ([], [])
        part = np.arange(len(labels)) % 3 == 2
        live = np.ones(len(labels), bool)
        for kind in [k for _, k in sorted(zip(counts, kinds, strict=True))]:
            y = labels == kind
            tried = sorted(range(len(names)), key=lambda j: names[j] not in (first or {}).get(str(kind), ()))
            while (live & y & ~part).any() and len(rules) < max_rules:
                rest = live | ~y  # rows of other classes count although a rule took them away
                g, test = rest & ~part, rest & part
                rule = cls._grow(x[g], y[g], tried, max_conditions)

                def worth(r: list) -> float:
                    c = cls._covers(x[test], r)
                    p, n = (c & y[test]).sum(), (c & ~y[test]).sum()
                    return (p - n) / max(1, p + n)

                while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
                    rule = rule[:-1]
                covered = cls._covers(x, rule)
                if (covered & ~y).any():  # a row of the pruning part is in the way: grow with it, unpruned
                    rule = cls._grow(x[rest], y[rest], tried, max_conditions)
                    covered = cls._covers(x, rule)
                if not rule or (covered & ~y).any() or not (covered & live).any():
                    break  # not pure on all rows seen: better no rule
                rules.append(([(names[j], op, at) for j, op, at in rule], str(kind)))
                live &= ~covered
        return cls(rules)

    def column(self, otherwise: str) -> Column:
        """The list as one CASE expression; ``otherwise`` where no rule holds."""
        out = None
        for conditions, kind in self.rules:
            test = F.lit(True)
            for name, op, at in conditions:
                test = test & (F.col(name) <= F.lit(at) if op == "<=" else F.col(name) >= F.lit(at))
            out = F.when(test, kind) if out is None else out.when(test, kind)
        return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def proven(rules: DecisionList, share: float) -> DecisionList:
    """The list, each rule narrowed to the part whose class its conditions prove; what it covers beyond is 'unsure'.

    'clean' is proven by a condition that holds a bound from above under ``share``,
    'repetitive' by one that holds a bound from below at ``share`` or over it.
    """
    out = []
    under = float(np.nextafter(share, 0.0))
    for conditions, kind in rules.rules:
        for k, (name, op, at) in enumerate(conditions):
            if kind == "clean" and name in ABOVE and op == "<=":
                out.append(([*conditions[:k], (name, op, min(at, under)), *conditions[k + 1 :]], kind))
            elif kind == "repetitive" and name in BELOW and op == ">=":
                out.append(([*conditions[:k], (name, op, max(at, share)), *conditions[k + 1 :]], kind))
        out.append((conditions, "unsure"))
    return DecisionList(out)


def learn(df: DataFrame, keys: list[str], text: str, share: float, sample_rows: int) -> DecisionList:
    """The decision list of a corpus, from at most ``sample_rows`` labelled documents."""
    # a threshold on the hash, so that no task sends the driver more than its share
    part = sample_rows / max(1, df.count())
    near = df if part >= 1 else df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < int(0.95 * part * (1 << 30)))
    labelled = exact_shares(counted(near, keys, text), [*keys, *STATS], "_text")
    got = labelled.select(*STATS, "share").limit(sample_rows).toPandas()
    x = got[STATS].to_numpy(dtype=np.float64)
    return DecisionList.fit(x, np.where(got["share"].to_numpy() >= share, "repetitive", "clean"), STATS, first={"clean": ABOVE, "repetitive": BELOW})


def judged(df: DataFrame, keys: list[str], text: str, rules: DecisionList, share: float = 0.4) -> DataFrame:
    """``keys``, ``_text`` and ``verdict`` of each document by the list: 'repetitive', 'clean' or 'unsure'."""
    return counted(df, keys, text).withColumn("verdict", proven(rules, share).column("unsure")).select(*keys, "_text", "verdict")


def flag_repetitive(df: DataFrame, keys: list[str], text: str, share: float = 0.4, sample_rows: int = 20_000, rules: DecisionList | None = None) -> DataFrame:
    """Documents whose share of words in repeated 3-word runs is at least ``share``.

    Counts of every document are Spark expressions; none is the share itself.  At
    most ``sample_rows`` documents, chosen by hash of the keys, are labelled by
    walking through them, and a decision list over the counts is fitted to these.
    Its ordered expression then settles the documents that a rule covers whose
    class the counts prove ('repetitive' or 'clean'); the others are 'unsure',
    and only their texts are walked through.  So the list decides which documents
    are examined, and a rule that errs beyond its sample can't lose or invent one.

    Returns ``keys`` and ``verdict`` ('repetitive' by the list, 'examined' by the
    walk).  Null, empty and wordless texts are clean.  Repeated rows give repeated
    results; an empty table gives none.
    """
    df = df.select(*keys, text)
    rules = learn(df, keys, text, share, sample_rows) if rules is None else rules
    rows = judged(df, keys, text, rules, share).where("verdict <> 'clean'")
    out = T.StructType([*[df.schema[k] for k in keys], T.StructField("verdict", T.StringType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            keep, name = [], []
            for i, (t, v) in enumerate(zip(b.column(len(keys)).to_pylist(), b.column(len(keys) + 1).to_pylist(), strict=True)):
                if v == "unsure":
                    w = words(t) if t else []
                    if not w or repeated_words(w) < share * len(w) - 1e-9:
                        continue
                keep.append(i)
                name.append("repetitive" if v == "repetitive" else "examined")
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(keep, pa.int64())) for c in b.columns[: len(keys)]], pa.array(name, pa.string())], names=[*keys, "verdict"])

    # settled ones need no text
    return rows.select(*keys, F.when(F.col("verdict") == "unsure", F.col("_text")).alias("_text"), "verdict").mapInArrow(walk, out)

"""At most so many records per contributor, the best ones, kept batch by batch in a state table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import row_at_weight
from ..session import cut


class CapState:
    """State table in a folder: admitted records, cutoffs, and the log of displaced records.

    ``order`` is a list of (column, descending?); nulls come last either way and
    the columns together must tell records apart.  A contributor with ``cap``
    records or more is full, and its cutoff is the order columns of its last kept
    record.  Cutoffs only rise, so a record behind one never comes back.

    Each batch is one version and only adds files: ``admitted`` holds its records
    that no cutoff turned away, ``cutoffs`` the new cutoffs of the contributors
    whose cutoff moved, ``log`` the records displaced by it.  What is kept follows
    from records and cutoffs, so nothing is rewritten; contributors that a batch
    doesn't name are not touched.  A version counts once its small state file is
    written, after its tables: a batch that fails leaves the version before it.
    The folder may be opened again by any later session.
    """

    def __init__(self, spark: SparkSession, path: str, contributor: str, order: list[tuple[str, bool]], cap: int, version: int, schema: T.StructType | None, written: dict[str, list[int]]) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.contributor, self.order, self.cap = contributor, [tuple(o) for o in order], cap
        self.version, self.schema, self.written = version, schema, written
        self._keys = [f"_o{i}" for i in range(len(order))]

    # -- the folder

    @classmethod
    def create(cls, spark: SparkSession, path: str, contributor: str, order: list[tuple[str, bool]], cap: int) -> CapState:
        """An empty state at ``path``; an error if there is one."""
        if cap < 1:
            raise ValueError("a cap below 1 keeps nothing")
        state = cls(spark, path, contributor, order, cap, 0, None, {"admitted": [], "cutoffs": [], "log": []})
        if state._versions():
            raise FileExistsError(path)
        state._commit()
        return state

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> CapState:
        """The state at ``path`` as of ``version``, by default the latest."""
        probe = cls(spark, path, "", [], 1, 0, None, {})
        known = probe._versions()
        if not known or (version is not None and version not in known):
            raise FileNotFoundError(f"{path}: no version {version if known else ''}")
        at = max(known) if version is None else version
        m = json.loads("".join(r[0] for r in spark.read.text(probe._state_file(at)).collect()))  # one small file
        schema = T.StructType.fromJson(m["schema"]) if m["schema"] else None
        return cls(spark, path, m["contributor"], m["order"], m["cap"], at, schema, m["written"])

    def _fs(self):  # noqa: ANN202
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _state_file(self, version: int) -> str:
        return f"{self.path}/state-{version:08d}.json"

    def _versions(self) -> list[int]:
        hits = self._fs().globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/state-*.json"))
        return [int(h.getPath().getName()[6:14]) for h in (hits or [])]

    def _commit(self) -> None:
        """Write the state file under another name and rename it: it is there whole or not at all."""
        m = {"contributor": self.contributor, "order": self.order, "cap": self.cap, "schema": self.schema.jsonValue() if self.schema else None, "written": self.written}
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        fs, final = self._fs(), self._state_file(self.version)
        out = fs.create(hadoop(final + ".tmp"), True)
        out.write(bytearray(json.dumps(m).encode()))
        out.close()
        if not fs.rename(hadoop(final + ".tmp"), hadoop(final)):
            raise RuntimeError(f"version {self.version} was written by someone else")

    def _write(self, df: DataFrame, part: str, version: int) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{part}/v={version}")

    def _read(self, part: str, fields: T.StructType) -> DataFrame:
        paths = [f"{self.path}/{part}/v={v}" for v in self.written[part]]
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*fields.fields, T.StructField("v", T.IntegerType())]))
        return self.spark.read.option("basePath", f"{self.path}/{part}").schema(T.StructType([*fields.fields, T.StructField("v", T.IntegerType())])).parquet(*paths)

    # -- its tables

    def _fields(self, rec: bool) -> T.StructType:
        own = [T.StructField("_who", self.schema[self.contributor].dataType), *[T.StructField(k, self.schema[n].dataType) for k, (n, _) in zip(self._keys, self.order, strict=True)]]
        return T.StructType(own + ([T.StructField("_rec", self.schema)] if rec else []))

    def _own(self, df: DataFrame) -> DataFrame:
        """``df`` as _who, _o0.. and _rec, which holds its columns whatever their names."""
        rec = df.select(F.struct(*[F.col(f"`{c}`") for c in self.schema.names]).alias("_rec"))
        order = [F.col("_rec").getField(n).alias(k) for k, (n, _) in zip(self._keys, self.order, strict=True)]
        return rec.select(F.col("_rec").getField(self.contributor).alias("_who"), *order, "_rec").where("_who is not null")

    def _marks(self) -> DataFrame:
        """(_who, _o0..): the latest cutoff of each full contributor."""
        rows = self._read("cutoffs", self._fields(False))
        if len(self.written["cutoffs"]) > 1:
            rows = rows.groupBy("_who").agg(F.max_by(F.struct(*self._keys), "v").alias("m")).select("_who", "m.*")
        return rows.select("_who", *self._keys)

    def _rank_columns(self) -> list[Column]:
        out = []
        for k, (_, desc) in zip(self._keys, self.order, strict=True):
            out += [F.col(k).isNull().cast("int"), F.col(k).desc() if desc else F.col(k).asc()]
        return out

    def _against(self, df: DataFrame, marks: DataFrame) -> DataFrame:
        """``df`` with ``_beyond``: whether a record ranks behind its contributor's cutoff."""
        marks = marks.select(F.col("_who").alias("_full"), *[F.col(k).alias(f"_at{k}") for k in self._keys])
        tied, behind = F.lit(True), F.lit(False)
        for k, (_, desc) in zip(self._keys, self.order, strict=True):
            a, b = F.col(k), F.col(f"_at{k}")
            worse = F.coalesce((a < b) if desc else (a > b), a.isNull() & b.isNotNull())
            behind, tied = behind | (tied & worse), tied & a.eqNullSafe(b)
        both = df.join(marks, F.col("_who") == F.col("_full"), "left")
        return both.select(*df.columns, (F.col("_full").isNotNull() & behind).alias("_beyond"))

    def add(self, batch: DataFrame) -> None:
        """Merge a batch into the state as a new version; records without a contributor take no part.

        The batch is filtered against the cutoffs.  For the contributors that it
        fills or overfills, the order columns alone (not the records) of the kept
        and the new rows are range-sorted, and the row at rank ``cap`` is read as
        the new cutoff.  A contributor with most of the rows is spread like any
        other.
        """
        if self.schema is None:
            self.schema = batch.schema
        v = self.version + 1
        old = self._marks()
        pool = self._own(batch)
        if self.written["cutoffs"]:
            pool = cut(self._against(pool, old))
            turned, pool = pool.where("_beyond").drop("_beyond"), pool.where(~F.col("_beyond")).drop("_beyond")
        else:
            turned = None
        self._write(pool, "admitted", v)
        written = {**self.written, "admitted": [*self.written["admitted"], v]}
        new = CapState(self.spark, self.path, self.contributor, self.order, self.cap, v, self.schema, written)

        keys = new._read("admitted", self._fields(False))
        if self.version:
            # only contributors with news, and of their rows those not displaced before
            named = keys.where(F.col("v") == v).select("_who").distinct()
            keys = self._against(keys.join(named, "_who", "left_semi"), old).where(~F.col("_beyond")).drop("_beyond")
        keys = keys.drop("v").withColumn("_one", F.lit(1).cast("long"))
        full = keys.groupBy("_who").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") >= self.cap).withColumn("_cap", F.lit(self.cap).cast("long"))
        at = row_at_weight(keys, ["_who"], self._rank_columns(), "_one", full, "_cap").select("_who", *self._keys)
        self._write(at, "cutoffs", v)
        new.written["cutoffs"] = [*self.written["cutoffs"], v]

        # kept before or new, and behind the cutoff now
        moved = self.spark.read.schema(self._fields(False)).parquet(f"{self.path}/cutoffs/v={v}")
        rows = new._read("admitted", self._fields(True)).drop("v")
        fallen = self._against(rows, moved).where("_beyond").drop("_beyond")
        if self.version:
            fallen = self._against(fallen, old).where(~F.col("_beyond")).drop("_beyond")
        fallen = fallen if turned is None else fallen.unionByName(turned)
        self._write(fallen.select("_rec"), "log", v)
        new.written["log"] = [*self.written["log"], v]
        new._commit()
        self.version, self.written = new.version, new.written

    @property
    def kept(self) -> DataFrame:
        """Records kept so far; an error before the first batch, which brings the columns."""
        rows = self._read("admitted", self._fields(True)).drop("v")
        return self._against(rows, self._marks()).where(~F.col("_beyond")).select("_rec.*")

    @property
    def cutoffs(self) -> DataFrame:
        """The last kept record's order columns of each full contributor."""
        return self._marks().select(F.col("_who").alias(self.contributor), *[F.col(k).alias(n) for k, (n, _) in zip(self._keys, self.order, strict=True)])

    def log(self, version: int | None = None) -> DataFrame:
        """Records displaced so far, or by one version."""
        rows = self._read("log", T.StructType([T.StructField("_rec", self.schema)]))
        return (rows if version is None else rows.where(F.col("v") == version)).select("_rec.*")


def cap_contributors(records: DataFrame, contributor: str, order: list[tuple[str, bool]], cap: int, batch: Column, batches: int, path: str) -> CapState:
    """State at ``path`` after all records with a contributor, taken in ``batches`` batches.

    ``batch`` is a number from 0 to ``batches - 1`` for each record.  The result
    does not depend on it: identical records that tie at the cutoff are kept
    together.  Records with a null contributor take no part.  An empty table gives
    an empty state.
    """
    state = CapState.create(records.sparkSession, path, contributor, order, cap)
    for i in range(batches):
        state.add(records.where(batch == i))
    return state

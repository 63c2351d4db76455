"""Token ids of whole texts by a public byte-level tokenizer.

A long text is cut into overlapping chunks, each pre-tokenised from its own
start.  Where the boundaries of two neighbours meet in their overlap, both go on
alike, so the pieces between such places are encoded independently.  All of that
happens in the task that reads the text: no text is moved and the corpus is read
once.  For texts too long for one task the same chunks may be spread over many
(``spread``).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = "/opt/tokenizers"
CHUNK = 8192  # characters of a chunk, without the overlap
OVERLAP = 512

# Fixed value: the published pattern that splits text before the merges of byte_bpe_50k.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Between a character that is no white space and a blank followed by none, every tokenisation has a boundary.
_SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f])(?= [^\s\x1c-\x1f])")
_DOUBLE = regex.compile(r"[\s\x1c-\x1f] | [\s\x1c-\x1f]")
_CACHE = 1 << 17


class Encoder:
    """Ids of pieces of text; words seen before come from a cache that is emptied when full."""

    def __init__(self, folder: str = FOLDER, name: str = "byte_bpe_50k") -> None:
        import tiktoken

        with open(f"{folder}/{name}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coding = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.vocabulary = {i: b for b, i in ranks.items()}
        self.ids: dict[str, bytes] = {}

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if len(self.ids) > _CACHE:
            self.ids.clear()
        if _DOUBLE.search(text):
            words = _SAFE.split(text)
        else:
            words = text.split(" ")
            words[1:] = [" " + w for w in words[1:]]
        seen, out = self.ids, []
        for w in words:
            b = seen.get(w)
            if b is None:
                b = np.array(self.coding.encode_ordinary(w), dtype="<i4").tobytes()
                if len(w) < 64:
                    seen[w] = b
            out.append(b)
        return b"".join(out)

    def encode_long(self, text: str, chunk: int, overlap: int) -> bytes:
        """The same, chunk by chunk."""
        if len(text) <= chunk:
            return self.encode_bytes(text)
        seen, out = self.ids, []
        for words in pretokens(text, chunk, overlap):
            if len(seen) > _CACHE:
                seen.clear()
            for w in words:
                b = seen.get(w)
                if b is None:
                    b = np.array(self.coding.encode_ordinary(w), dtype="<i4").tobytes()
                    if len(w) < 64:
                        seen[w] = b
                out.append(b)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text: raw bytes of the ids, concatenated."""
        return b"".join(self.vocabulary[i] for i in ids).decode("utf-8", "replace")


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(folder: str, name: str) -> Encoder:
    """One encoder per worker process and file."""
    if (folder, name) not in _encoders:
        _encoders[folder, name] = Encoder(folder, name)
    return _encoders[folder, name]


def boundaries(text: str) -> list[int]:
    """Ends of the pre-tokens of ``text``; all characters belong to one."""
    return [m.end() for m in _pattern.finditer(text)]


_pattern = regex.compile(PATTERN)


def _split(text: str) -> tuple[list[str], list[int]]:
    """Pre-tokens of a piece of text, and where each ends."""
    words = _pattern.findall(text)
    return words, np.cumsum([len(w) for w in words]).tolist() if words else []


def pretokens(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[str]]:
    """Pre-tokens of ``text``, some at a time, from overlapping chunks stitched where they meet.

    Each chunk is split from its own start.  The next one takes over at the first
    boundary in the overlap that both have.  If they have none there (a run without
    a break that is longer than the overlap), the text is split on from the last
    boundary that is certain, with chunks twice as long until they meet.
    """
    base, size, skip = 0, chunk + overlap, 0  # the chunk at hand, and how many of its words are taken already
    words, ends = _split(text[:size])
    while base + size < len(text):
        sure = max(skip, len(words) - 2)  # the last two may depend on characters beyond the chunk
        start = base + size - overlap
        more, stops = _split(text[start : start + chunk + overlap])
        heads = {start: 0} | {start + e: i + 1 for i, e in enumerate(stops) if e < overlap}
        at = next((i for i in range(skip, sure) if base + ends[i] >= start and base + ends[i] in heads), None)
        if at is not None:
            yield words[skip : at + 1]
            skip = heads[base + ends[at]]
            base, size, words, ends = start, chunk + overlap, more, stops
        else:
            yield words[skip:sure]
            base, size, skip = base + (ends[sure - 1] if sure else 0), 2 * size, 0
            words, ends = _split(text[base : base + size])
    yield words[skip:]


def make_chunks(df: DataFrame, key: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, k, n, text): chunk k of n with ``overlap`` characters of the next one."""
    schema = T.StructType([df.schema[key], T.StructField("k", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.columns
            if not b.num_rows:
                continue
            texts = texts.to_pylist()
            take, k, n, out = [], [], [], []
            for i, t in enumerate(texts):
                t = t or ""
                count = max(1, -(-len(t) // chunk))
                for j in range(count):
                    take.append(i)
                    k.append(j)
                    n.append(count)
                    out.append(t if count == 1 else t[j * chunk : (j + 1) * chunk + overlap])
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(take)), pa.array(k, pa.int32()), pa.array(n, pa.int32()), pa.array(out, pa.string())], names=[key, "k", "n", "text"])

    return df.select(key, F.col(text)).mapInArrow(run, schema)


def _edges(key: str, chunk: int, overlap: int):  # noqa: ANN202
    """Boundaries in the overlap zones at both ends of each chunk, as places in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, tails = [], []
            for k, n, t in zip(b.column("k").to_pylist(), b.column("n").to_pylist(), b.column("text").to_pylist(), strict=True):
                at = boundaries(t)
                base = k * chunk
                # unless the text ends here, the last two may depend on characters beyond the chunk
                sure = at[:-2] if len(t) == chunk + overlap else at
                heads.append([base] + [base + x for x in at if x < overlap] if k else [])
                # white space before a stitch would look like the end of the text, which the pattern minds
                tails.append([base + x for x in sure if x >= chunk and not t[x - 1].isspace()] if k < n - 1 else [])
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(heads, lists), pa.array(tails, lists)], names=[key, "k", "n", "text", "head", "tail"])

    return run


def stitch(chunks: DataFrame, key: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, k, piece): the pieces of texts of several chunks, between stitches.

    A text with neighbours that nowhere agree (one unbroken run longer than the
    overlap) becomes a single piece again, so the ids are right for any text.
    """
    kind = T.ArrayType(T.LongType())
    schema = T.StructType([*chunks.schema.fields, T.StructField("head", kind), T.StructField("tail", kind)])
    at = Window.partitionBy(key).orderBy("k")
    marked = chunks.repartition(key, "k").mapInArrow(_edges(key, chunk, overlap), schema)
    marked = marked.withColumn("to", F.array_min(F.array_intersect("tail", F.lead("head").over(at)))).drop("head", "tail")
    marked = marked.withColumn("from", F.when(F.col("k") == 0, F.lit(0).cast("long")).otherwise(F.lag("to").over(at)))
    marked = marked.withColumn("broken", F.max((F.col("to").isNull() & (F.col("k") < F.col("n") - 1)).cast("int")).over(Window.partitionBy(key)))
    skip = (F.col("from") - F.col("k") * chunk).cast("int")
    end = F.when(F.col("to").isNull(), F.length("text")).otherwise((F.col("to") - F.col("k") * chunk).cast("int"))
    good = marked.where("broken = 0").select(key, "k", F.col("text").substr(skip + 1, end - skip).alias("text")).repartition(key, "k")
    own = F.when(F.col("k") == F.col("n") - 1, F.col("text")).otherwise(F.substring("text", 1, chunk))
    whole = marked.where("broken = 1").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("k", own.alias("t")))).alias("p"))
    whole = whole.select(key, F.lit(0).alias("k"), F.array_join(F.col("p.t"), "").alias("text"))
    return good.unionByName(whole)


def _lists(ids: list[bytes], sizes: np.ndarray) -> pa.Array:
    # at most 2^31 ids in a batch: texts of a batch are bounded by its bytes
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))


def _encode(keys: list[str], folder: str, name: str, count: bool, chunk: int, overlap: int):  # noqa: ANN202
    """Ids, or their number, of the column behind ``keys``; null is ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(folder, name)
        for b in batches:
            parts = [coder.encode_long(t, chunk, overlap) if t else b"" for t in b.column(len(keys)).to_pylist()]
            sizes = np.array([len(p) // 4 for p in parts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(sizes) if count else _lists(parts, sizes)], names=[*keys, "ids"])

    return run


def _encoded(df: DataFrame, key: str, text: str, folder: str, name: str, count: bool, chunk: int, overlap: int, spread: int | None) -> tuple[DataFrame, DataFrame | None]:
    """(key, ids) of texts encoded in place, and (key, k, ids) of the pieces of those over ``spread`` characters."""
    kind = T.StructField("ids", T.LongType() if count else T.ArrayType(T.IntegerType(), False))
    whole = T.StructType([df.schema[key], kind])
    rows = df.select(key, F.col(text).alias("_text"))
    if spread is None:
        return rows.mapInArrow(_encode([key], folder, name, count, chunk, overlap), whole), None
    long = F.coalesce(F.length("_text") > max(spread, chunk), F.lit(False))
    here = rows.where(~long).mapInArrow(_encode([key], folder, name, count, chunk, overlap), whole)
    pieces = stitch(make_chunks(rows.where(long), key, "_text", chunk, overlap), key, chunk, overlap)
    schema = T.StructType([df.schema[key], T.StructField("k", T.IntegerType()), kind])
    return here, pieces.mapInArrow(_encode([key, "k"], folder, name, count, chunk, overlap), schema)


def encode_corpus(df: DataFrame, key: str, text: str, folder: str = FOLDER, name: str = "byte_bpe_50k", chunk: int = CHUNK, overlap: int = OVERLAP, spread: int | None = None) -> DataFrame:
    """(key, ids) for every row: ids of the text as it stands, no special tokens.

    Null and empty texts have the empty list.  Strings that spell a special token
    are ordinary text.  A text is encoded by the task that reads it, in time linear
    in its length.  With ``spread`` texts of more characters than that are dealt out
    to tasks chunk by chunk, at the price of a second look at the table; then
    ``key`` should be unique and not null for them, as their pieces are put together
    by it.
    """
    here, pieces = _encoded(df, key, text, folder, name, False, chunk, overlap, spread)
    if pieces is None:
        return here
    joined = pieces.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("p"))
    return here.unionByName(joined.select(key, F.flatten("p.ids").alias("ids")))


def count_tokens(df: DataFrame, key: str, text: str, folder: str = FOLDER, name: str = "byte_bpe_50k", chunk: int = CHUNK, overlap: int = OVERLAP, spread: int | None = None) -> DataFrame:
    """(key, n_tokens) for every row, 0 for null and empty texts."""
    here, pieces = _encoded(df, key, text, folder, name, True, chunk, overlap, spread)
    here = here.withColumnRenamed("ids", "n_tokens")
    return here if pieces is None else here.unionByName(pieces.groupBy(key).agg(F.sum("ids").alias("n_tokens")))


def decode_corpus(df: DataFrame, key: str, ids: str, folder: str = FOLDER, name: str = "byte_bpe_50k") -> DataFrame:
    """(key, text) for every row: the raw bytes of the ids, joined and read as UTF-8.

    An empty list is '', a null list null.  Bytes that are no UTF-8 (ids cut from
    the middle of a text) become U+FFFD; an id that the tokenizer doesn't have is an
    error.
    """
    schema = T.StructType([df.schema[key], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(folder, name)
        for b in batches:
            texts = [None if x is None else coder.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return df.select(key, ids).mapInArrow(run, schema)

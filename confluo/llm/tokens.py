"""Token counts, and token ids as Simple-8b files.

Counts: each block of documents is reduced to per-document pre-token frequencies, pieces are
counted once for each distinct pre-token that the worker doesn't know yet, and the two are joined
inside the block; nothing is shuffled, and no ids are made for documents.  (A shuffled join of
all (document, pre-token) pairs would move more bytes than the corpus itself.)

Files: documents are range-partitioned by id, encoded, packed and written as segments, each a
self-contained Simple-8b container; the table of segments is Parquet, so any store that Spark
writes to can hold it and a lost task is just run again.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.shipping import ship
from ..plans.storage import new_path
from . import simple8b
from .textio import add_columns, give_back, texts_of
from .vocabulary import read_spec, vocabulary

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
END_ID = 2
#: Ids after which a segment is closed; a longer document has a segment to itself.
SEGMENT_IDS = 1 << 19
#: Texts handled at a time inside an Arrow batch, in bytes.
SLICE_BYTES = 1 << 20
_MAGIC = b"S8B1"
_HEAD = struct.Struct("<4sIQII")  # magic, documents, ids, words, block offsets


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def count_tokens(docs: DataFrame, tokenizer: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit of the whole text.

    Null counts as the empty text: 0 bytes, 0 tokens.  Bytes that are no UTF-8 are counted as they are and tokenized
    as U+FFFD, as in the files.  Input columns of these names are replaced; other columns, repeated rows and row order
    within a partition are kept; an empty table gives an empty table.
    """
    spec = read_spec(tokenizer)

    def make():
        known = vocabulary(spec)

        def score(texts: list[bytes]) -> list[pa.Array]:
            n = [c for part in _slices(texts) for c in known.count([t.decode("utf-8", "replace") for t in part]).tolist()]
            return [
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(n, pa.int64()),
                pa.array([c > limit for c in n], pa.bool_()),
            ]

        return score

    return add_columns(docs, text_col, [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())], make)


def pack_segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One container: header, document ids and lengths, block offsets, words."""
    words, offsets = simple8b.encode(np.concatenate(ids) if ids else np.zeros(0, np.uint64))
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join(
        [
            _HEAD.pack(_MAGIC, len(ids), sum(map(len, ids)), len(words), len(offsets)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            known.tobytes(),
            np.array([len(x) for x in ids], "<u8").tobytes(),
            offsets.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
        ]
    )


def unpack_segment(data: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    """Document ids and token ids of a container; a foreign or cut container is an error."""
    magic, docs, n, n_words, n_offsets = _HEAD.unpack_from(data)
    at = _HEAD.size
    if magic != _MAGIC or len(data) != at + docs * 17 + n_offsets * 4 + n_words * 8:
        raise ValueError("not a whole Simple-8b segment")
    ids = np.frombuffer(data, "<i8", docs, at).tolist()
    known = np.frombuffer(data, np.uint8, docs, at + docs * 8).tolist()
    lengths = np.frombuffer(data, "<u8", docs, at + docs * 9).astype(np.int64)
    words = np.frombuffer(data, "<u8", n_words, at + docs * 17 + n_offsets * 4)
    values = simple8b.decode(words, n)
    return [d if k else None for d, k in zip(ids, known, strict=True)], np.split(values.astype("<u4"), np.cumsum(lengths)[:-1]) if docs else []


_SEGMENT = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("start_in_part", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> None:
    """Write the ids of all texts, each ended by ``end_id``, in ascending order of ``id_col`` to ``path``.

    Null texts are empty (the end id alone).  Rows with a null id come first; rows that share an id are ordered by
    a hash of their text.  Columns besides id and text are not written.
    """
    spark, spec = docs.sparkSession, read_spec(tokenizer)
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("body"))
        .repartitionByRange(n, F.col("id").asc_nulls_first(), F.xxhash64("body"))
        .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("body"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = vocabulary(spec), TaskContext.get().partitionId()
        seq = begun = held = 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            columns = [[part], [seq], [begun], [held], [pack_segment(doc_ids, ids)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                names=_SEGMENT.names,
            )

        for batch in batches:
            at = 0
            names = batch.column(0).to_pylist()
            for some in _slices(texts_of(batch)):
                for one in known.encode(some):
                    if ids and held + len(one) >= SEGMENT_IDS:
                        yield segment()
                        seq, begun, held = seq + 1, begun + held, 0
                        doc_ids.clear()
                        ids.clear()
                    doc_ids.append(names[at])
                    ids.append(np.append(one, np.uint32(end_id)))
                    held += len(one) + 1
                    at += 1
        if ids:
            yield segment()
        give_back()

    ordered.mapInArrow(run, _SEGMENT).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, decoded from them.

    start counts the ids of all documents before it.  Only one total per file partition meets at the driver.
    """
    ship(spark)
    segments = spark.read.schema(_SEGMENT).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before = np.concatenate([[0], np.cumsum([r["n"] for r in totals], dtype=np.int64)]).tolist()
    offsets = dict(zip([r["part"] for r in totals], before, strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, begun, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                doc_ids, ids = unpack_segment(payload)
                lengths = np.array([len(x) for x in ids], np.int64)
                starts = offsets[part] + begun + np.cumsum(lengths) - lengths
                crcs = [zlib.crc32(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(lengths), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
        give_back()

    return segments.select("part", "start_in_part", "payload").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, tokenizer_path()).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizer_path())
    return read_token_files(spark, path)

"""Token ids as Arrow files of equal-length sequences with masks.

Documents are range-sorted by id; every task encodes its range, appends the end
id to each document, cuts the stream into sequences of ``seq_len`` and writes
them as fixed-size-list batches of one Arrow file (uncompressed, footer, so a
memory map gives any sequence and its mask without copying), with a second
small file that says where each document starts.  Only a part's last sequence
is padded; its mask says where.  The written manifest names the files of the
tasks that succeeded, so a task that ran twice leaves nothing in the result.

Defined results: null texts are empty (the end id alone); documents without an
id come first; documents of one id follow each other by text, repeated rows as
often as they are there; texts of any length are encoded whole; an empty table
gives an empty manifest; other columns never matter.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstats.llm.tokens import END_ID, TOKEN_SLICE, TokenEncoder, file_text, id_kind
from reelstats.llm.words import slices, texts_of
from reelstats.session import materialize, parts_for, scratch_path

MANIFEST = "part long, path string, n_docs long, n_tokens long, n_sequences long"
RECORDS = "doc_id long, start long, n_tokens long, ids_crc32 long"


# Names that Hadoop and Arrow give to the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "wasbs": "abfss"}


def arrow_uri(path: str) -> str:
    """The URI by which Arrow knows a Hadoop path: other scheme names, three slashes for a local file."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return "file://" + path
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Hadoop URI or of a plain local path."""
    uri = arrow_uri(path)
    if uri.startswith("file://"):
        return pafs.LocalFileSystem(), uri.removeprefix("file://")
    return pafs.FileSystem.from_uri(uri)


def sequence_schema(seq_len: int, dtype: pa.DataType) -> pa.Schema:
    return pa.schema([pa.field("input_ids", pa.list_(pa.field("item", dtype, False), seq_len), False),
                      pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), seq_len), False)])


def sequence_batch(ids: np.ndarray, schema: pa.Schema, seq_len: int) -> pa.RecordBatch:
    """Whole sequences of ``ids``, the last one padded with zeros and masked out."""
    n = -(-len(ids) // seq_len)
    full = np.zeros(n * seq_len, ids.dtype)
    full[:len(ids)] = ids
    mask = np.arange(n * seq_len) < len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.FixedSizeListArray.from_arrays(pa.array(full), type=schema.field(0).type),
         pa.FixedSizeListArray.from_arrays(pa.array(mask), type=schema.field(1).type)], schema=schema)


class SequenceFile:
    """Random access to the sequences of one written file, without copying on a local map."""

    def __init__(self, path: str):
        fs, where = open_fs(path)
        source = pa.memory_map(where) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(where)
        self.reader = pa.ipc.open_file(source)
        self.per_batch = self.reader.get_batch(0).num_rows

    @property
    def n_batches(self) -> int:
        return self.reader.num_record_batches

    def batch_ids(self, k: int) -> np.ndarray:
        """The ids of batch ``k`` in a row, a view of the file."""
        return self.reader.get_batch(k).column(0).flatten().to_numpy()

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of sequence ``i``."""
        row = self.reader.get_batch(i // self.per_batch).slice(i % self.per_batch, 1)
        return row.column(0).flatten().to_numpy(), row.column(1).flatten().to_numpy(zero_copy_only=False)


def write_part(folder: str, tokenizer: str, seq_len: int, per_batch: int, end_id: int):
    def run(batches):
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        fs, root = open_fs(folder)
        encoder = TokenEncoder(tokenizer)
        kind = np.dtype(id_kind(encoder.vocab_size))
        schema = sequence_schema(seq_len, pa.from_numpy_dtype(kind))
        docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        name = f"part-{part:06d}-{attempt}"
        out = docs = None
        pending, held, total, n_docs, n_seq = [], 0, 0, 0, 0
        block = seq_len * per_batch
        for batch in slices(batches, max_bytes=TOKEN_SLICE):
            if out is None:
                fs.create_dir(root, recursive=True)
                out = pa.ipc.new_file(fs.open_output_stream(f"{root}/{name}.arrow"), schema)
                docs = pa.ipc.new_file(fs.open_output_stream(f"{root}/{name}.docs.arrow"), docs_schema)
            ids, offsets = encoder.encode(texts_of(batch), end_id)
            docs.write_batch(pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(offsets[:-1] + total),
                 pa.array(np.diff(offsets))], schema=docs_schema))
            total, n_docs = total + len(ids), n_docs + batch.num_rows
            pending.append(ids.astype(kind))
            held += len(ids)
            if held >= block:
                row = np.concatenate(pending)
                cut = len(row) // block * block
                for at in range(0, cut, block):
                    out.write_batch(sequence_batch(row[at:at + block], schema, seq_len))
                n_seq += cut // seq_len
                pending, held = [row[cut:]], len(row) - cut
        if out is None:
            return
        if held:
            out.write_batch(sequence_batch(np.concatenate(pending), schema, seq_len))
            n_seq += -(-held // seq_len)
        out.close()
        docs.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([f"{folder}/{name}"]), pa.array([n_docs], pa.int64()),
             pa.array([total], pa.int64()), pa.array([n_seq], pa.int64())],
            names=["part", "path", "n_docs", "n_tokens", "n_sequences"])
    return run


def write_sequences(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text", seq_len: int = 2048,
                    per_batch: int = 256, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Write the files in ascending id order; returns the manifest (one row per part)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "sequences")
    parts = parts or parts_for(docs)
    ordered = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text"))
    return materialize(ordered.mapInArrow(
        write_part(folder, file_text(tokenizer), seq_len, per_batch, end_id), MANIFEST), "manifest")


def read_part(batches):
    """Per document of each named file: its place in the whole stream, its size and the CRC of its ids."""
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
            ids = SequenceFile(f"{path}.arrow")
            fs, where = open_fs(f"{path}.docs.arrow")
            k, first, view = 0, 0, ids.batch_ids(0).astype("<u4")
            index = pa.ipc.open_file(fs.open_input_file(where))
            for docs in map(index.get_batch, range(index.num_record_batches)):
                starts, sizes = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                crcs = np.zeros(len(starts), np.int64)
                for r, (at, end) in enumerate(zip(starts.tolist(), (starts + sizes).tolist())):
                    crc = 0
                    while at < end:
                        if at >= first + len(view):
                            first, k = first + len(view), k + 1
                            view = ids.batch_ids(k).astype("<u4")
                        upto = min(end, first + len(view))
                        crc = zlib.crc32(view[at - first:upto - first], crc)
                        at = upto
                    crcs[r] = crc
                yield pa.RecordBatch.from_arrays(
                    [docs.column("doc_id"), pa.array(starts + base), pa.array(sizes), pa.array(crcs)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files alone; start counts the ids of all documents before it."""
    # one row per part: a bounded table
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return (placed.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            .mapInArrow(read_part, RECORDS))

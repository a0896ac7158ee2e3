"""Token ids in Arrow stream files of fixed-size lists.

A shard holds the ids of its documents one after another, cut into sequences of equal length. The
shard's ``ids`` file is an Arrow IPC file whose batches have the columns ``ids`` and ``mask``, both
fixed-size lists, so sequence *i* is found by arithmetic and read without a copy. The last sequence
is filled up with id 0 under a mask of false. The ``docs`` file next to it says which document
begins where. Ids are stored as unsigned 16-bit integers if the vocabulary allows, else 32-bit.

Shards follow the order of ``doc_id``; the manifest of a write lists the files of the attempts that
succeeded, so a task that ran twice leaves a stray file but no wrong row.

Defined cases: a null or empty text gives the end id alone; a null ``doc_id`` comes first; rows
that share a ``doc_id`` follow each other by the hash of their text; an empty table gives no shard.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.config import shared_folder
from layerloom.llm.byte_bpe import END_ID, encoder
from layerloom.llm.common import stage

SEQUENCE = 2048
# Documents that go to a Python worker at once.
ARROW_ROWS = 2500
# Sequences in one record batch of a file.
BATCH = 128
MANIFEST = (
    "shard int, ids_file string, docs_file string, n_docs long, n_tokens long, sequence int"
)
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
READ_BACK = "doc_id long, shard int, in_shard long, n_tokens long, ids_crc32 long"


def _open(uri: str):
    """File system and path of a shared location."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


class _Sequences:
    """Writes a stream of ids as batches of equal-length sequences."""

    def __init__(self, sink, dtype: np.dtype, length: int):
        self.length, self.dtype, self.held, self.n = length, dtype, [], 0
        ids, mask = pa.list_(pa.from_numpy_dtype(dtype), length), pa.list_(pa.bool_(), length)
        self.schema = pa.schema([("ids", ids), ("mask", mask)])
        self.writer = pa.ipc.new_file(sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.n += len(ids)
        full = BATCH * self.length
        if self.n >= full:
            flat = np.concatenate(self.held)
            cut = len(flat) // full * full
            for k in range(0, cut, full):
                self._write(flat[k : k + full], full)
            self.held, self.n = [flat[cut:]], len(flat) - cut

    def _write(self, flat: np.ndarray, real: int) -> None:
        mask = np.arange(len(flat)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (flat, mask)]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        if self.n:
            flat = np.concatenate(self.held)
            pad = -len(flat) % self.length
            self._write(np.concatenate([flat, np.full(pad, END_ID, self.dtype)]), len(flat))
        self.writer.close()


class SequenceFile:
    """Random access to the sequences of one ids file."""

    def __init__(self, uri: str, sequence: int = SEQUENCE):
        fs, path = _open(uri)
        local = fs.type_name == "local"
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.reader, self.length = pa.ipc.open_file(self.source), sequence
        batches = self.reader.num_record_batches
        last = self.reader.get_batch(batches - 1).num_rows if batches else 0
        self.rows = max(0, batches - 1) * BATCH + last
        self.held: tuple[int, pa.RecordBatch] | None = None

    def __len__(self) -> int:
        return self.rows

    def column(self, batch: int, name: str = "ids") -> np.ndarray:
        """All values of one batch, end to end; ids without a copy."""
        # Readers go on from where they were, so the last batch is kept: one fetch a batch.
        if self.held is None or self.held[0] != batch:
            self.held = (batch, self.reader.get_batch(batch))
        values = self.held[1].column(name).flatten()
        return values.to_numpy(zero_copy_only=name == "ids")

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if not 0 <= i < self.rows:
            raise IndexError(i)
        at = slice(i % BATCH * self.length, (i % BATCH + 1) * self.length)
        return self.column(i // BATCH)[at], self.column(i // BATCH, "mask")[at]

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Consecutive ids from place ``start``, batch by batch."""
        size = BATCH * self.length
        while n > 0:
            got = self.column(start // size)[start % size : start % size + n]
            yield got
            start, n = start + len(got), n - len(got)


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
) -> DataFrame:
    """Encode all texts and write them in order of ``id_col``; returns the staged manifest.

    Texts are dealt out by ranges of (id, hash of the text), so neither a document repeated many
    times nor a dense stretch of ids fills one task, and are encoded where they are written: what
    moves is text, not ids. A task holds one document and one batch of sequences at a time.
    """

    def shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        code = encoder(tokenizer)
        dtype = np.dtype("<u2" if code.vocab_size <= 1 << 16 else "<u4")
        number = TaskContext.get().partitionId()
        name = f"{folder}/shard-{number:06d}-{uuid.uuid4().hex}"
        seqs, fs, index = None, None, None
        total = rows = 0
        for batch in batches:
            ids_of = code.run(batch.column("text"))
            starts, counts = [], []
            for ids in ids_of:
                if seqs is None:
                    fs, path = _open(name)
                    fs.create_dir(path.rpartition("/")[0])
                    sinks = [fs.open_output_stream(f"{path}.{x}.arrow") for x in ("ids", "docs")]
                    seqs = _Sequences(sinks[0], dtype, sequence)
                    index = pa.ipc.new_file(sinks[1], INDEX)
                seqs.add(np.append(ids, np.array([END_ID], ids.dtype)))
                starts.append(total)
                counts.append(len(ids) + 1)
                total += len(ids) + 1
            if starts:
                columns = [batch.column("doc_id").cast(pa.int64()), pa.array(starts), pa.array(counts)]
                index.write_batch(pa.record_batch(columns, schema=INDEX))
                rows += len(starts)
        if seqs is not None:
            seqs.close()
            index.close()
            for sink in sinks:
                sink.close()
            row = [[number], [f"{name}.ids.arrow"], [f"{name}.docs.arrow"], [rows], [total], [sequence]]
            types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
            names = ["shard", "ids_file", "docs_file", "n_docs", "n_tokens", "sequence"]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(row, types)], names=names)

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = picked.withColumn("h", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    return stage(ordered.select("doc_id", "text").mapInArrow(shard, MANIFEST), ARROW_ROWS)


def read(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: place among all ids, number of ids and their CRC-32.

    One task per shard; only the manifest, a row per shard, is counted and ordered as a whole.
    """

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            ids = SequenceFile(row["ids_file"], row["sequence"])
            fs, path = _open(row["docs_file"])
            with fs.open_input_file(path) as source:
                index = pa.ipc.open_file(source)
                for k in range(index.num_record_batches):
                    docs = index.get_batch(k)
                    sums = []
                    for start, n in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist()):
                        crc = 0
                        for part in ids.span(start, n):
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    yield pa.record_batch(
                        [
                            docs.column("doc_id"),
                            pa.array([row["shard"]] * len(sums), pa.int32()),
                            docs.column("start"),
                            docs.column("n_tokens"),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "shard", "in_shard", "n_tokens", "ids_crc32"],
                    )

    # With a number of its own: adaptive execution would put a small manifest into one task.
    shards = max(1, manifest.count())
    dealt = manifest.repartitionByRange(shards, "shard").mapInArrow(documents, READ_BACK)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))
    first = manifest.select("shard", before.alias("before"))
    return dealt.join(first, "shard").select(
        "doc_id", (F.col("before") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )


def new_folder(spark) -> str:
    return f"{shared_folder(spark)}/llm/sequences-{uuid.uuid4().hex[:12]}"

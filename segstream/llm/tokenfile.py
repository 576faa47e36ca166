"""Token ids in Arrow IPC files with fixed-size-list batches.

Documents are range-partitioned and sorted by doc_id; each task writes one file
of equal-length sequences (``ids`` fixed_size_list, ``mask`` fixed_size_list of
booleans: which ids are real) and one small index file (doc_id, start in the
file, n_tokens). A reader maps the file: any sequence of any batch is a view of
it, found by division, without copying or decoding what lies before it.

Files go below the shared folder through Arrow's file systems, named by task
attempt; only the names that successful tasks report are read, so lost
executors and repeated tasks leave nothing behind that counts. The driver gets
one row for each file (name, number of ids), never one for each document.

Ids take 16 bits where the vocabulary allows it, else 32.

Defined results: a null or empty text is its end id alone; null doc_ids come
first, equal doc_ids in an unspecified order; an empty table gives an empty
result; other columns are dropped.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segstream.llm.common import fresh_folder
from segstream.llm.tokens import encoder

SEQUENCE = 2048
BATCH_ROWS = 128
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class SequenceWriter:
    """Streams ids into one file; a batch is written as soon as it is full."""

    def __init__(self, uri: str, dtype: np.dtype, length: int = SEQUENCE, batch_rows: int = BATCH_ROWS):
        self.length, self.room, self.dtype = length, length * batch_rows, dtype
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        store, path = file_system(uri)
        store.create_dir(path.rpartition("/")[0])
        self.sink = store.open_output_stream(path)
        self.index_sink = store.open_output_stream(f"{path}.index")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.index_writer = pa.ipc.new_file(self.index_sink, INDEX)
        self.held: list[np.ndarray] = []
        self.waiting = self.total = 0

    def add(self, doc_ids: list[int | None], ids: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in ids], np.int64)
        starts = self.total + np.cumsum(sizes) - sizes
        self.index_writer.write_batch(pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes)], schema=INDEX))
        self.held += ids
        n = int(sizes.sum())
        self.total += n
        self.waiting += n
        if self.waiting >= self.room:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.room * self.room
            for i in range(0, whole, self.room):
                self.write(flat[i : i + self.room], self.room)
            self.held = [flat[whole:].copy()]
            self.waiting = len(self.held[0])

    def write(self, flat: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(flat)) < real)
        lists = [pa.FixedSizeListArray.from_arrays(x, self.length) for x in (pa.array(flat), mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> int:
        if self.waiting:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, self.dtype)
            padded[: len(flat)] = flat
            self.write(padded, len(flat))
        for x in (self.writer, self.index_writer, self.sink, self.index_sink):
            x.close()
        return self.total


class SequenceFile:
    """Random access to the sequences of one file; local files are mapped."""

    def __init__(self, uri: str, batch_rows: int = BATCH_ROWS):
        store, path = file_system(uri)
        local = store.type_name == "local"
        self.source = pa.memory_map(path) if local else store.open_input_file(path)
        self.index_source = pa.memory_map(f"{path}.index") if local else store.open_input_file(f"{path}.index")
        self.reader, self.index = pa.ipc.open_file(self.source), pa.ipc.open_file(self.index_source)
        self.length, self.batch_rows = self.reader.schema.field("ids").type.list_size, batch_rows

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of the i-th sequence, as views."""
        batch = self.reader.get_batch(i // self.batch_rows)
        row = i % self.batch_rows
        ids, mask = batch["ids"].slice(row, 1), batch["mask"].slice(row, 1)
        return ids.flatten().to_numpy(), mask.flatten()

    def flat(self, b: int) -> np.ndarray:
        """All real ids of batch ``b``, a view; padding can only close a file."""
        batch = self.reader.get_batch(b)
        real = batch["mask"].flatten().true_count
        return batch["ids"].flatten().to_numpy()[:real]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) in the file's order, with one batch in memory
        besides the running document."""
        flat, batch, at = np.empty(0, np.uint16), 0, 0
        for k in range(self.index.num_record_batches):
            rows = self.index.get_batch(k)
            for doc_id, start, n in zip(*(rows[i].to_pylist() for i in range(3))):
                parts, need = [], n
                while need:
                    if at == len(flat):
                        flat, batch, at = self.flat(batch), batch + 1, 0
                    part = flat[at : at + need]
                    parts.append(part)
                    at += len(part)
                    need -= len(part)
                yield doc_id, start, parts[0] if len(parts) == 1 else np.concatenate(parts)

    def close(self) -> None:
        self.source.close()
        self.index_source.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> list[tuple[str, int]]:
    """Write ``docs`` (doc_id, text) and return (file, ids) in doc_id order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, out, part = encoder(tokenizer), None, 0
        end = np.array(end_id, e.dtype).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                if out is None:
                    part = rows["part"][0].as_py()
                    uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:12]}.arrow"
                    out = SequenceWriter(uri, e.dtype)
                ids = [np.frombuffer(x + end, e.dtype) for x in e.packed(rows["text"].to_pylist())]
                out.add(rows["doc_id"].to_pylist(), ids)
        if out is not None:
            total = out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "uri": [uri], "ids": pa.array([total], pa.int64())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").withColumn("part", F.spark_partition_id())
    files = ordered.mapInArrow(run, "part int, uri string, ids long").collect()  # one row for each file
    return [(r["uri"], r["ids"]) for r in sorted(files, key=lambda r: r["part"])]


def read_token_files(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """One row for each document, from the files alone; a task for each file."""
    base = np.cumsum([0, *(n for _, n in files)]).tolist()
    uris = [u for u, _ in files]
    names = ("doc_id", "start", "n_tokens", "ids_crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch["id"].to_pylist():
                f, rows = SequenceFile(uris[k]), []
                for doc_id, start, ids in f.documents():
                    rows.append((doc_id, base[k] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
                f.close()

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def token_digests(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """Write the files of ``docs`` below the shared folder, read them back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, fresh_folder(spark, "tokens"), tokenizer, end_id))

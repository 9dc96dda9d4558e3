"""Token-ID files: one concatenated id array with Elias-Fano document boundaries.

A file: 8 bytes of magic, the ids, Elias-Fano ends of documents, Elias-Fano document ids (less the
smallest), a JSON footer, its length, the magic. Rows are range-partitioned by doc_id, so files in
order hold all documents in ascending doc_id order. A task names its files after its own attempt and
Spark commits the list of files; files of lost or repeated attempts are never listed. The folder must
be one that pyarrow can open on every executor (file://, hdfs://, s3://, gs://).

Boundaries are read through select and in blocks decoded from the nearest sample: no file's boundaries or
doc_ids are ever expanded whole.

Defined cases: a null text is empty (only the end id); rows with a null doc_id come first; repeated
doc_ids keep one entry a row, ordered by the text's hash; a very long text has a file of its own or shares
one, and is read back whole; other columns are ignored; an empty table writes no file and gives no rows.
"""

from __future__ import annotations

import json
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import fresh_path
from .common import materialise
from .elias_fano import EliasFano
from .tokenise import columns_of, default_vocabulary, encoder

MAGIC = b"EFTOKEN1"
END_ID = 0
#: A file is closed after so many ids or documents; a longer document has a file of its own.
IDS_A_FILE, DOCS_A_FILE = 1 << 27, 1 << 20
LISTED = "file string, task int, number int, n_docs long, n_ids long"
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def open_place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


class TokenFileWriter:
    """Streams documents into one file; ids go out at once, only boundaries stay in memory."""

    def __init__(self, uri: str, width: int) -> None:
        self.uri, self.width = uri, width
        system, path = open_place(uri)
        self.out = system.open_output_stream(path)
        self.out.write(MAGIC)
        self.ends, self.ids = array("Q"), array("q")
        self.nulls = self.total = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.total += len(ids) // self.width
        self.ends.append(self.total)
        if doc_id is None:
            self.nulls += 1
        else:
            self.ids.append(doc_id)

    def close(self) -> None:
        base = self.ids[0] if self.ids else 0
        ends = EliasFano.encode(np.array(self.ends, dtype=np.uint64)).to_bytes()
        ids = EliasFano.encode(np.array(self.ids, dtype=np.int64).view(np.uint64) - np.array(base, np.int64).view(np.uint64)).to_bytes()
        foot = json.dumps({"width": self.width, "docs": len(self.ends), "nulls": self.nulls, "base": base, "ids": self.total, "ends": len(ends), "doc_ids": len(ids)}).encode()
        self.out.write(ends + ids + foot + len(foot).to_bytes(8, "little") + MAGIC)
        self.out.close()


class TokenFile:
    """Random access: document i's ids through two selects and one read."""

    def __init__(self, uri: str) -> None:
        system, path = open_place(uri)
        self.source = system.open_input_file(path)
        size = self.source.size()
        tail = self.source.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        n = int.from_bytes(tail[:8], "little")
        self.foot = json.loads(self.source.read_at(n, size - 16 - n))
        at = len(MAGIC) + self.foot["ids"] * self.foot["width"]
        self.ends = EliasFano.from_bytes(self.source.read_at(self.foot["ends"], at))
        self.doc_ids = EliasFano.from_bytes(self.source.read_at(self.foot["doc_ids"], at + self.foot["ends"]))

    def __len__(self) -> int:
        return self.foot["docs"]

    def ids(self, i: int) -> np.ndarray:
        start, width = (self.ends.select(i - 1) if i else 0), self.foot["width"]
        raw = self.source.read_at((self.ends.select(i) - start) * width, len(MAGIC) + start * width)
        return np.frombuffer(raw, f"<u{width}").astype("<u4")

    def doc_id_block(self, first: int, last: int) -> np.ma.MaskedArray:
        """doc_ids of documents first to last - 1; the nulls come first."""
        nulls = self.foot["nulls"]
        own = self.doc_ids.values(max(0, first - nulls), max(0, last - nulls)).astype(np.int64) + self.foot["base"]
        none = min(nulls, last) - min(nulls, first)
        return np.ma.array(np.concatenate([np.zeros(none, np.int64), own]), mask=np.arange(last - first) < none)

    def scan(self, step: int = 1 << 22, docs: int = 4096):
        """(first document, start, boundaries after it, ids) of runs of whole documents: boundaries of ``docs`` documents are
        decoded at a time, and about ``step`` ids read."""
        width, n = self.foot["width"], len(self)
        for at in range(0, n, docs):
            ends = self.ends.values(at, at + docs).astype(np.int64)
            start, first = (self.ends.select(at - 1) if at else 0), 0
            while first < len(ends):
                last = max(first + 1, int(np.searchsorted(ends, start + step, "right")))
                raw = self.source.read_at((int(ends[last - 1]) - start) * width, len(MAGIC) + start * width)
                yield at + first, start, ends[first:last] - start, np.frombuffer(raw, f"<u{width}").astype("<u4")
                start, first = int(ends[last - 1]), last


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes all documents and returns the committed list of files (a table in the shared folder)."""
    vocabulary = vocabulary or default_vocabulary()

    def write(batches):
        encode, writer, listed = encoder(vocabulary), None, []
        task = TaskContext.get()
        end = np.array([end_id], f"<u{encode.width}").tobytes()

        def close():
            writer.close()
            listed.append((writer.uri, task.partitionId(), len(listed), len(writer.ends), writer.total))

        for ids, texts in columns_of(batches):
            for doc_id, tokens in zip(ids, encode.encode(texts)):
                if writer is not None and (writer.total >= IDS_A_FILE or len(writer.ends) >= DOCS_A_FILE):
                    close()
                    writer = None
                if writer is None:
                    writer = TokenFileWriter(f"{folder}-{task.partitionId():05d}-{len(listed):04d}-{task.taskAttemptId()}.eftokens", encode.width)
                writer.add(doc_id, tokens + end)
        if writer is not None:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "task", "number", "n_docs", "n_ids"), x)) for x in listed], schema=pa.schema([("file", pa.string()), ("task", pa.int32()), ("number", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    # The text's hash and the row's number let the range of one repeated doc_id be split.
    keys = ["doc_id", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("row")]
    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(*keys, "text").repartitionByRange("doc_id", "mark", "row")
    dealt = dealt.sortWithinPartitions("doc_id", "mark", "row").select("doc_id", "text")
    return materialise(dealt.mapInArrow(write, LISTED), "token-files")


def read_token_files(listed: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    order = Window.orderBy("task", "number")  # one row a file: a short list
    placed = listed.withColumn("before", F.sum("n_ids").over(order) - F.col("n_ids"))
    files = max(1, listed.count())

    def read(batches):
        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = TokenFile(uri)
                for first, start, ends, ids in held.scan():
                    starts = np.concatenate([[0], ends[:-1]])
                    crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)]
                    doc_ids = held.doc_id_block(first, first + len(ends))
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids.data, mask=np.ma.getmaskarray(doc_ids)), pa.array(starts + start + before, pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crcs, pa.int64())], schema=READ)

    return placed.select("file", "before").repartition(files, "file").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, from Elias-Fano token files."""
    listed = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), fresh_path(spark, "tokens"))
    return read_token_files(listed)

"""Token output in training order: a keyed permutation of all sequences, written as fixed-stride shards.

Texts are encoded, joined by the end token in a stated order and cut into sequences of ``length`` tokens. The order is
that of files and rows in them where the documents come straight from files, else that of the ids; neither depends on
how the input is split into tasks. A keyed Feistel network with cycle-walking maps each sequence's number to a slot
of the same range, so that the training order is random, needs no sort key or table, and can be worked out again from
the key. Slots are dealt by range: shard k holds the slots from k * ``per_shard`` on, each at (slot - first) * stride
bytes, so that a reader resumes at any slot by one seek.

Tasks encode their rows into chunks of ``length`` tokens; once all counts are known, chunks are cut at the bounds of
sequences, packed by shard and sent to the task that fills the shard. A shard is written under a name of its own and
then moved in place at once; a repeated or speculative task finds it there, as the bytes are the same. Shards of an
earlier run in the folder, and what ended tasks left, are taken away by the driver.

Defined cases: null and empty texts give no tokens; rows of one id go by a hash of their texts, equal rows being
written each; the last sequence is filled up with the end token and has its true length in the manifest; ids of a
vocabulary of up to 65,536 tokens take two bytes, else four; ids of documents may be of any type that can be ordered;
other columns pass by; an empty table gives no shards and an empty manifest.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm import secret_scan
from actlens.llm.common import BATCH_ROWS, Scratch, arrow_map, column_of, ship, texts_of

LENGTH = 2048
PER_SHARD = 8192
END = 50256
#: Tasks that write shards, at most.
TASKS = 50_000
MEMO = 400_000


def feistel(numbers: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """A keyed permutation of range(n): a balanced Feistel network on an even number of bits, walked until in range."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "big")) for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((f ^ (f >> np.uint64(29))) & low)
        return (left << np.uint64(half)) | right

    out = once(np.asarray(numbers, np.uint64))
    while (outside := out >= np.uint64(n)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


class WordTokens(dict):
    """Chunk of text after a space -> its ids as bytes; None where a chunk can't be taken by itself."""

    def __init__(self, bpe, dtype: str) -> None:
        super().__init__()
        self.bpe, self.dtype = bpe, dtype

    def __missing__(self, chunk: str) -> bytes | None:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        ids = np.array(self.bpe.encode_ordinary(" " + chunk), self.dtype).tobytes()
        if len(chunk) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        parts = [self[x] for x in rest]
        if None in parts or not first or first[-1].isspace():
            return np.array(self.bpe.encode_ordinary(text), self.dtype).tobytes()
        return np.array(self.bpe.encode_ordinary(first), self.dtype).tobytes() + b"".join(parts)


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, file, block): rows in an order that does not depend on tasks; if ids give it, file and block are null."""
    try:
        return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    except AnalysisException:  # the rows do not come straight from files
        plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    keyed = plain.withColumn("__h", F.xxhash64("text"))
    return keyed.repartitionByRange("doc_id", "__h").sortWithinPartitions("doc_id", "__h").select("doc_id", "text", F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("block"))


def chunks(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """(file, first, place, n_tokens, begun, ids, ends, payload): the tokens of each stretch of the input in order.

    A stretch is what one task reads of a file at once, from byte ``first`` on. ``ids`` and ``ends`` are the documents of a
    chunk and where each ends in it; ``begun`` says that the first of them began in an earlier chunk.
    """
    path = vocabulary or secret_scan.default_vocabulary()
    dtype = "<u2" if end < 1 << 16 else "<u4"
    width, rows = int(dtype[-1]), in_order(docs)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    ship(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = WordTokens(secret_scan.encoding(path), dtype)
        stop, size = np.array([end], dtype).tobytes(), length * width
        names = ["file", "first", "place", "n_tokens", "begun", "ids", "ends", "payload"]
        stretch, place, held, marks, begun = ("", TaskContext.get().partitionId()), 0, b"", [], False
        out: list[tuple] = []
        id_arrow = pa.null()

        def cut(last: bool) -> None:
            nonlocal place, held, marks, begun
            at = k = 0
            while len(held) - at >= size or (last and at < len(held)):
                piece, first = held[at : at + size], k
                stop_at = at + len(piece)
                while k < len(marks) and marks[k][1] <= stop_at:
                    k += 1
                inside = marks[first : k + (k < len(marks) and (marks[k - 1][1] if k else at) < stop_at)]
                out.append((*stretch, place, len(piece) // width, begun, [i for i, _ in inside], [min(e, stop_at) // width - at // width for _, e in inside], piece))
                begun = bool(inside) and inside[-1][1] > stop_at
                place, at = place + 1, stop_at
            held, marks = held[at:], [(i, e - at) for i, e in marks[k:]]

        def written() -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(id_arrow), pa.list_(pa.int32()), pa.binary())
            batch = pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], names)
            out.clear()
            return batch

        for batch in batches:
            pieces, total = [held], len(held)
            id_arrow = column_of(batch, "doc_id").type
            for doc, text, file, block in zip(column_of(batch, "doc_id").to_pylist(), texts_of(batch, "text"), column_of(batch, "file").to_pylist(), column_of(batch, "block").to_pylist(), strict=True):
                if file is not None and (file, block) != stretch:
                    held = b"".join(pieces)
                    cut(True)
                    stretch, place, begun, pieces, total = (file, block), 0, False, [], 0
                if text:
                    pieces += [words.encode(text), stop]
                    total += len(pieces[-2]) + width
                    marks.append((doc, total))
            held = b"".join(pieces)
            cut(False)
            yield written()
        cut(True)
        if out:
            yield written()

    return rows.mapInArrow(run, f"file string, first long, place long, n_tokens long, begun boolean, ids array<{id_type}>, ends array<int>, payload binary")


def swept(spark, folder: str, pattern: str) -> None:
    """Takes the files of a pattern out of a folder."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.globStatus(path) or []:
        system.delete(status.getPath(), False)


def write_shards(docs: DataFrame, folder: str, key: int = 1, length: int = LENGTH, per_shard: int = PER_SHARD, end: int = END, vocabulary: str | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Writes the shards of all texts into ``folder`` and returns the manifest.

    The manifest has one row per sequence: (slot, shard, offset, sequence, first_doc, n_docs, n_tokens, sha256).
    ``folder`` is a URI that all executors reach and that both Spark and Arrow open (file, hdfs, s3, gs).
    """
    from pyarrow import fs

    spark, target = docs.sparkSession, folder.rstrip("/")
    fs.FileSystem.from_uri(target)  # a folder that the tasks can't open fails here
    swept(spark, target, "*shard-*")
    scratch = scratch or Scratch(spark, "tokens")
    held = scratch.put(chunks(docs, length, end, vocabulary))
    id_type = held.schema["ids"].dataType.elementType.simpleString()
    sizes = held.groupBy("file", "first").agg(F.sum("n_tokens").alias("n")).orderBy("file", "first").toArrow()  # one row per stretch
    counts = sizes.column("n").to_numpy()
    total = int(counts.sum())
    n = -(-total // length)
    bases = spark.createDataFrame(pa.table({"file": sizes.column("file"), "first": sizes.column("first"), "base": np.cumsum(counts) - counts})) if len(counts) else spark.createDataFrame([], "file string, first long, base long")
    dtype = np.dtype("<u2" if end < 1 << 16 else "<u4")
    width = dtype.itemsize

    def pack():
        compress = zstandard.ZstdCompressor(level=6).compress  # ids hold little per byte: less to shuffle

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts: dict[int, list[tuple]] = {}
            rows = [column_of(batch, c).to_pylist() for c in ("base", "place", "n_tokens", "begun", "ids", "ends", "payload")]
            cuts = []
            for base, place, size, begun, ids, ends, payload in zip(*rows, strict=True):
                at = base + place * length
                rest = length - at % length
                cuts += [(a, b, (at + a) // length, (at + a) % length, begun, ids, ends, payload) for a, b in ((0, min(rest, size)), (rest, size)) if a < b]
            slots = feistel(np.array([c[2] for c in cuts], np.int64), n, key).tolist()
            for (a, b, number, offset, begun, ids, ends, payload), slot in zip(cuts, slots, strict=True):
                low, high = bisect_right(ends, a), bisect_left(ends, b)
                # the first document goes on here if it began before this piece
                goes_on = begun if a == 0 and low == 0 else low < len(ends) and (ends[low - 1] if low else 0) < a
                parts.setdefault(slot // per_shard, []).append((slot, number, offset, ids[low], high - low + 1, goes_on, payload[a * width : b * width]))
            shards = list(parts)
            flat = list(zip(*(x for k in shards for x in parts[k]), strict=True)) or [()] * 7
            kinds = cell_type(column_of(batch, "ids").type.value_type)
            fields = [*flat[:3], [len(x) // width for x in flat[6]], *flat[3:6]]
            cells = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(fields, kinds, strict=True)], [f.name for f in kinds])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(parts[k]) for k in shards)]), pa.int32()), cells)
            return pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), lists, pa.array([compress(b"".join(x[6] for x in parts[k])) for k in shards], pa.binary())], ["shard", "cells", "payload"])

        return step

    cell = f"struct<slot:long,number:long,at:int,size:int,doc:{id_type},docs:int,goes_on:boolean>"
    placed = arrow_map(held.join(bases, ["file", "first"]), pack, f"shard long, cells array<{cell}>, payload binary")
    # ranges of shards by number, so that no sample is needed and a task has one shard, or a few of a very long table
    shards = max(1, -(-n // per_shard))
    tasks = min(shards, TASKS)
    placed = placed.withColumn("task", F.expr(f"cast(shard * {tasks} div {shards} as int)"))
    ordered = placed.repartitionById(tasks, "task").drop("task").sortWithinPartitions("shard")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(target)
        system.create_dir(base, recursive=True)
        unpack = zstandard.ZstdDecompressor().decompress
        now, body, cells, id_arrow = None, np.zeros(0, dtype), {}, pa.null()

        def done() -> pa.RecordBatch:
            first = now * per_shard
            count = min(per_shard, n - first)
            raw = body[: count * length].tobytes()
            final, own = f"{base}/shard-{now:06d}.bin", f"{base}/.shard-{now:06d}-{uuid.uuid4().hex}"
            if system.get_file_info(final).type == fs.FileType.NotFound:
                with system.open_output_stream(own) as out:
                    out.write(raw)
                system.move(own, final)
            rows = []
            for slot in sorted(cells):
                parts = sorted(cells[slot])
                docs_in = sum(p[3] for p in parts) - sum(p[4] for p in parts[1:])
                stride = length * width
                at = (slot - first) * stride
                rows.append((slot, now, at, parts[0][5], parts[0][2], docs_in, sum(p[1] for p in parts), hashlib.sha256(raw[at : at + stride]).hexdigest()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), id_arrow, pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], ["slot", "shard", "offset", "sequence", "first_doc", "n_docs", "n_tokens", "sha256"])

        for batch in batches:
            id_arrow = column_of(batch, "cells").type.value_type.field("doc").type
            for shard, found, payload in zip(column_of(batch, "shard").to_pylist(), column_of(batch, "cells").to_pylist(), column_of(batch, "payload").to_pylist(), strict=True):
                if shard != now:
                    if now is not None:
                        yield done()
                    now, body, cells = shard, np.full(per_shard * length, end, dtype), {}
                ids, at = np.frombuffer(unpack(payload), dtype), 0
                for x in found:
                    to = (x["slot"] - shard * per_shard) * length + x["at"]
                    body[to : to + x["size"]] = ids[at : at + x["size"]]
                    at += x["size"]
                    cells.setdefault(x["slot"], []).append((x["at"], x["size"], x["doc"], x["docs"], x["goes_on"], x["number"]))
        if now is not None:
            yield done()

    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    manifest = scratch.put(ordered.mapInArrow(write, f"slot long, shard long, offset long, sequence long, first_doc {id_type}, n_docs long, n_tokens long, sha256 string"))
    scratch.drop(held)
    swept(spark, target, ".shard-*")
    return manifest


def cell_type(id_type: pa.DataType) -> pa.DataType:
    """What is kept of a piece of a sequence: its slot, number, place and size, its first document and number of documents."""
    whole = [("slot", pa.int64()), ("number", pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("doc", id_type), ("docs", pa.int32()), ("goes_on", pa.bool_())]
    return pa.struct(whole)


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD, end: int = END) -> np.ndarray:
    """``count`` sequences from slot ``first`` on: one seek, then sequential reads."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder.rstrip("/"))
    dtype = "<u2" if end < 1 << 16 else "<u4"
    size, rows = int(dtype[-1]) * length, []
    while count > 0:
        shard, at = divmod(first, per_shard)
        take = min(count, per_shard - at)
        if system.get_file_info(f"{base}/shard-{shard:06d}.bin").type == fs.FileType.NotFound:
            break
        with system.open_input_file(f"{base}/shard-{shard:06d}.bin") as file:
            file.seek(at * size)
            raw = file.read(take * size)
        if not raw:
            break
        rows.append(np.frombuffer(raw, dtype).reshape(-1, length))
        first, count = first + take, count - take
    return np.concatenate(rows) if rows else np.zeros((0, length), dtype)

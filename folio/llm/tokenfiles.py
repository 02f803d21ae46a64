"""Token ids of documents in binary files with an index by key.

A folder has

- ``shard-N.bin``: SHARD_HEADER (magic, version, bytes of an id), then the ids of the documents one after the other, little-endian; shards
  and the documents in them ascend by doc_id (null first, then repeated ones by text);
- ``index-N.mph``: INDEX_HEADER (magic, version, keys, levels), bits of each level, the levels' bits, and for each key in the order of its
  minimal perfect hash: fingerprint, shard, ids before it in the shard, number of ids;
- ``manifest.json``: bytes of an id, number of indexes, and for each shard its number of ids and those of all shards before it.

The key of a document is its doc_id in decimals ("null" without one), ``#`` and how many documents of that doc_id stand before it. Files
are written under a name of the attempt and renamed when they are whole, so a repeated task replaces a file by an equal one.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.perfecthash import PerfectHash, hashes
from folio.llm.running import running
from folio.llm.scratch import Scratch
from folio.llm.textbytes import SLICE_BYTES

END_ID = 0
SHARD_HEADER, INDEX_HEADER = "<4sHH", "<4sHHQ"
MAGIC, INDEX_MAGIC, VERSION = b"FTOK", b"FMPH", 1
#: Keys of an index file on average, which one task holds.
KEYS_OF_INDEX = 50_000
#: Ids of a shard that one task reads.
IDS_OF_READ = 1 << 22
#: Entries of the memory of a worker for chunks of text.
MEMORY = 800_000
ENTRY = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u8")])


class Encoder:
    """Ids of whole texts. Its pre-tokenizer always parts before one blank or line feed between two characters that are no white space, so the
    chunks between such places are encoded once for many texts."""

    _CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
    _TWO = re.compile(r"\s\s")
    #: Where a full stop or comma follows anything but a common letter or digit, with which it makes no piece of its own.
    _NO_STOP = re.compile(r"[.,](?<![A-Za-z0-9À-ÖØ-öø-ÿ][.,])")

    def __init__(self, model: str) -> None:
        # Tasks are what runs in parallel here.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.parted = json.loads(model).get("pre_tokenizer") == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and not json.loads(model).get("normalizer")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        # Ids of pieces that begin with a blank or line feed, as the byte level writes them.
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins[[i for piece, i in vocabulary.items() if piece[:1] in ("Ġ", "Ċ")]] = True
        self.known: dict[str, bytes] = {}

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, f"<u{self.width}").tobytes()

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        return (np.array(e.ids, f"<u{self.width}") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))

    def _chunks(self, text: str) -> list[str]:
        if "\0" in text or self._TWO.search(text):
            return self._CUT.split(text)
        text = text.replace(" ", "\0 ").replace("\n", "\0\n")
        if not self._NO_STOP.search(text):
            text = text.replace(",\0", "\0,\0").replace(".\0", "\0.\0")
        return text.split("\0")

    def _learn(self, new: list[str]) -> None:
        """Chunks that hold one blank or line feed, in front of other characters, stay apart when joined and begin with a piece that tells it;
        the others are encoded alone."""
        one = [len(c) > 1 and c[0] in " \n" and not c[-1].isspace() and c.count(" ") + c.count("\n") == 1 for c in new]
        joined, alone = [c for c, j in zip(new, one, strict=True) if j], [c for c, j in zip(new, one, strict=True) if not j]
        self.known.update(zip(alone, map(np.ndarray.tobytes, self._encoded(alone)), strict=True))
        for i in range(0, len(joined), 5000):
            part = joined[i : i + 5000]
            ids = next(self._encoded(["".join(part)]))
            cuts = [*(np.flatnonzero(self.begins[ids]) * self.width).tolist(), len(ids) * self.width]
            raw = ids.tobytes()
            self.known.update(zip(part, [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))

    def payloads(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text with the end id."""
        end = self._bytes([END_ID])
        if not self.parted:
            return [ids.tobytes() + end for ids in self._encoded(texts)]
        if len(self.known) > MEMORY:
            self.known.clear()
        get = self.known.get
        parts = [self._chunks(t) for t in texts]
        found = [list(map(get, p)) for p in parts]
        gaps = [(f, i, p[i]) for p, f in zip(parts, found, strict=True) if None in f for i, x in enumerate(f) if x is None]
        if gaps:
            self._learn(list({c for _, _, c in gaps}))
            for f, i, c in gaps:
                f[i] = self.known[c]
        return [b"".join(f) + end for f in found]


_encoders: dict[int, Encoder] = {}


def _encoder(model: str) -> Encoder:
    key = hash(model)
    if key not in _encoders:
        _encoders[key] = Encoder(model)
    return _encoders[key]


class _NewFile:
    """A file that gets its name when it is whole."""

    def __init__(self, root: str, name: str) -> None:
        self.fs, path = pafs.FileSystem.from_uri(root)
        self.fs.create_dir(path)
        context = TaskContext.get()
        self.name, self.own = f"{path}/{name}", f"{path}/.{name}.{context.taskAttemptId() if context else 'driver'}"

    def __enter__(self):
        self.stream = self.fs.open_output_stream(self.own)
        return self.stream

    def __exit__(self, kind, value, trace) -> None:
        self.stream.close()
        if kind is None:
            self.fs.move(self.own, self.name)
        else:
            self.fs.delete_file(self.own)


def _open(root: str, name: str) -> pa.NativeFile:
    fs, path = pafs.FileSystem.from_uri(root)
    return fs.open_input_file(f"{path}/{name}")


def _writer(root: str, model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy()
            at = 0
            while at < len(sizes):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at : at + 10_000]), SLICE_BYTES, "right")))
                part = b.slice(at, n)
                yield part.column("doc_id"), [t or "" for t in part.column("text").to_pylist()]
                at += n

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, found = TaskContext.get().partitionId(), rows(batches)
        slice_ = next(found, None)
        if slice_ is None:
            return
        encoder, at = _encoder(model.value), 0
        with _NewFile(root, f"shard-{shard}.bin") as out:
            out.write(struct.pack(SHARD_HEADER, MAGIC, VERSION, encoder.width))
            while slice_ is not None:
                payloads = encoder.payloads(slice_[1])
                out.write(b"".join(payloads))
                n = np.array([len(p) // encoder.width for p in payloads], np.int64)
                starts = at + np.cumsum(n) - n
                at = int(starts[-1] + n[-1])
                yield pa.RecordBatch.from_arrays([slice_[0].cast(pa.int64()), pa.array(np.full(len(n), shard, np.int32)), pa.array(starts), pa.array(n)], names=["doc_id", "shard", "at", "n_tokens"])
                slice_ = next(found, None)

    return write


def _index_writer(root: str) -> Callable[[pa.Table], pa.Table]:
    def build(t: pa.Table) -> pa.Table:
        keys, bucket = t.column("key").to_pylist(), t.column("bucket")[0].as_py()
        a, b, fingerprint = hashes(keys)
        places = PerfectHash.over(a, b)
        entries = np.zeros(len(keys), ENTRY)
        slot = places(a, b)
        for name, values in (("fingerprint", fingerprint), *((n, t.column(c).to_numpy()) for n, c in (("shard", "shard"), ("at", "at"), ("n", "n_tokens")))):
            entries[name][slot] = values
        with _NewFile(root, f"index-{bucket}.mph") as out:
            out.write(struct.pack(INDEX_HEADER, INDEX_MAGIC, VERSION, len(places.sizes), places.n))
            for part in (np.array(places.sizes, "<u8"), places.words.astype("<u8"), entries):
                out.write(part.tobytes())
        return pa.table({"bucket": pa.array([bucket], pa.int64()), "n_keys": pa.array([len(keys)], pa.int64())})

    return build


def _index(root: str, bucket: int) -> tuple[PerfectHash, np.ndarray]:
    with _open(root, f"index-{bucket}.mph") as f:
        magic, version, levels, n = struct.unpack(INDEX_HEADER, f.read(struct.calcsize(INDEX_HEADER)))
        if magic != INDEX_MAGIC or version != VERSION:
            raise ValueError(f"index {bucket} is of another format")
        sizes = np.frombuffer(f.read(8 * levels), "<u8").astype(int).tolist()
        words = np.frombuffer(f.read(sum(sizes) // 8), "<u8")
        return PerfectHash(sizes, words), np.frombuffer(f.read(ENTRY.itemsize * n), ENTRY)


def _finder(root: str, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = -1, None
        for b in batches:
            bucket, keys = b.column("bucket").to_numpy(), b.column("key").to_pylist()
            bounds = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
            for start, end in zip(bounds, bounds[1:], strict=False):
                if start == end:
                    continue
                if bucket[start] != held:
                    held, index = int(bucket[start]), _index(root, int(bucket[start])) if bucket[start] < buckets else None
                a, c, fingerprint = hashes(keys[start:end])
                places, entries = index
                slot = places(a, c)
                hit = slot >= 0
                hit[hit] = entries["fingerprint"][slot[hit]] == fingerprint[hit]
                got = entries[np.where(hit, slot, 0)] if len(entries) else np.zeros(len(slot), ENTRY)
                columns = [pa.array(got[n].astype(np.int64), mask=~hit) for n in ("shard", "at", "n")]
                yield pa.RecordBatch.from_arrays([*b.slice(start, end - start).columns, *columns], names=[*b.schema.names, "shard", "at", "n_tokens"])

    return find


def _reader(root: str, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, stream = None, None
        for b in batches:
            ids, size, start = [], 0, 0
            for i, (shard, at, n) in enumerate(zip(*(b.column(c).to_pylist() for c in ("shard", "at", "n_tokens")), strict=True)):
                if shard != held:
                    if stream:
                        stream.close()
                    held, stream = shard, _open(root, f"shard-{shard}.bin")
                    if struct.unpack(SHARD_HEADER, stream.read(struct.calcsize(SHARD_HEADER))) != (MAGIC, VERSION, width):
                        raise ValueError(f"shard {shard} is of another format")
                stream.seek(struct.calcsize(SHARD_HEADER) + at * width)
                ids.append(np.frombuffer(stream.read(n * width), f"<u{width}").astype("<u4").tobytes())
                size += len(ids[-1])
                if size > 8 * SLICE_BYTES or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([*b.slice(start, len(ids)).columns, pa.array(ids, pa.binary())], names=[*b.schema.names, "ids"])
                    ids, size, start = [], 0, i + 1
        if stream:
            stream.close()

    return read


def key(doc_id: Column, nth: Column) -> Column:
    """Of the nth (from 0) document of a doc_id."""
    return F.concat_ws("#", F.coalesce(doc_id.cast("string"), F.lit("null")), nth.cast("string"))


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), more])


class TokenFiles:
    """A folder of shards with its indexes."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        with _open(root, "manifest.json") as f:
            found = json.loads(f.read())
        self.width, self.buckets, self.shards = found["id_bytes"], found["indexes"], found["shards"]

    @classmethod
    def write(cls, documents: DataFrame, model: str, root: str, scratch: Scratch) -> TokenFiles:
        """documents: doc_id and text (null: empty). model: the tokenizer's JSON. root: a folder or URI that the cluster shares."""
        spark = documents.sparkSession
        sent = spark.sparkContext.broadcast(model)
        docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"))
        dealt = docs.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
        entries = scratch.save(dealt.mapInArrow(_writer(root, sent), "doc_id long, shard int, at long, n_tokens long"))
        # Shards are as many as the tasks that wrote them.
        shards, before = [], 0
        for r in sorted(entries.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()):
            shards.append({"shard": r.shard, "ids": r.n, "before": before})
            before += r.n
        counted = running(entries.withColumns({"group": F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "nth": F.lit(1).cast("long")}), "group", [F.col("shard").asc(), F.col("at").asc()], ["nth"], scratch)
        keyed = counted.select(key(F.col("doc_id"), F.col("nth") - 1).alias("key"), "shard", "at", "n_tokens")
        buckets = max(1, -(-entries.count() // KEYS_OF_INDEX))
        placed = keyed.select(cls._bucket(F.col("key"), buckets), "*")
        scratch.save(placed.groupBy("bucket").applyInArrow(_index_writer(root), "bucket long, n_keys long"))
        with _NewFile(root, "manifest.json") as out:
            out.write(json.dumps({"id_bytes": _encoder(model).width, "indexes": buckets, "shards": shards}).encode())
        return cls(spark, root)

    @staticmethod
    def _bucket(key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets).cast("long")).alias("bucket")

    def find(self, keys: DataFrame) -> DataFrame:
        """Rows of keys (a column ``key``) with shard, at and n_tokens, null where no document has the key (but for one strange key in 2 ** 32).
        Each lookup takes one place of one index."""
        placed = keys.select(self._bucket(F.col("key"), self.buckets), *keys.columns)
        dealt = placed.repartition("bucket").sortWithinPartitions("bucket")
        return dealt.mapInArrow(_finder(self.root, self.buckets), _schema(placed, "shard long, at long, n_tokens long")).drop("bucket")

    def read(self, found: DataFrame) -> DataFrame:
        """Rows that ``find`` found, with ``start`` (ids of all documents before it) and ``ids`` (little-endian, 4 bytes each)."""
        there = found.where("shard is not null")
        dealt = there.repartition("shard", F.expr(f"at div {IDS_OF_READ}")).sortWithinPartitions("shard", "at")
        # A row for each shard.
        bases = self.spark.createDataFrame([(s["shard"], s["before"]) for s in self.shards], "shard long, _before long")
        read = dealt.mapInArrow(_reader(self.root, self.width), _schema(there, "ids binary"))
        return read.join(F.broadcast(bases), "shard").withColumn("start", F.col("_before") + F.col("at")).drop("_before")


def tokenized(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of all documents, written to files in the shared folder and looked up by key. Null texts are
    empty; documents of one doc_id (or without one) are so many keys; a table without rows gives no files and no rows. path: the tokenizer's JSON."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "tokens")
    with open(path, encoding="utf-8") as f:
        model = f.read()
    files = TokenFiles.write(documents, model, f"{scratch.root}/files", scratch)
    nth = documents.groupBy("doc_id").count().select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("nth"))
    return files.read(files.find(nth.select("doc_id", key(F.col("doc_id"), F.col("nth")).alias("key")))).select("doc_id", "start", "n_tokens", "ids")

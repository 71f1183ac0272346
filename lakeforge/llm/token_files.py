"""Token-id files with one shared zstandard dictionary.

A file set has two tables.  `dictionary` holds the dictionary (or nothing, if
the sample was too small for one) and its SHA-256.  `blocks` holds one row per
block of documents in ascending doc_id order: the dictionary's hash, the ids
and token counts of its documents, the offset index, and the payload, in which
each document is a zstandard frame of its own.  A reader finds a document by
the block's `first_doc` and `last_doc` and the offset index, and decompresses
that frame alone.

The dictionary is trained on the serialized ids of at most `sample_rows`
documents of at most `SAMPLE_TEXT` bytes, chosen by the hash of their id.

Ids take two bytes each if the vocabulary allows, else four.  NULL text is
empty: its document holds the end id alone.  Rows with the same id are all
written, side by side; NULL ids come last."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_stored, id_and_text, sample, store, with_null_ids

SHARD_BYTES = 12 * 2**20
BLOCK_BYTES = 2**20
#: Characters whose units are held at a time; few stay in the processor's cache.
CHUNK = 2**19
SAMPLE_TEXT = 64 * 2**10
DICTIONARY_BYTES = 64 * 2**10
LEVEL = 3
#: Bytes of units with their ids that a Python worker remembers: those used
#: since half of it was last filled, and those used while it was.
REMEMBERED = 256 * 2**20
#: What a unit and its ids take beside their characters.
ENTRY_BYTES = 200
BLOCKS = ("shard int, block int, dictionary_sha256 string, first_doc long, last_doc long, n_tokens long, "
          "doc_ids array<long>, counts array<int>, offsets array<long>, payload binary")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-&(-/:-@\[-`{-~"  # ASCII punctuation without the apostrophe
# Units of a text that the tokenizer's pattern never reaches across: a word of Latin letters with the blank in front,
# punctuation behind it, a single line end before a word, and else all up to the next blank in front of something.
_UNITS = re.compile(rf" ?[{_LETTERS}]+(?=[\s{_MARKS}]|\Z)|[{_MARKS}]+(?=[ \n][{_LETTERS}]|\Z)|\n(?=[{_LETTERS}])|(?s:.)[^ ]*(?: (?!\S)[^ ]*)*")

# Byte-level BPE writes each byte as a character: printable ones as they are, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: b for b in _PRINTABLE} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)).difference(_PRINTABLE)))}
#: Words that tell whether the model alone gives the library's ids.
_PROBE = [" a", " Zebra", " ordinary", " über", " façade", " ÿÿ"]


class Encoder:
    """Byte-level BPE by the tokenizers library.  A text is the sequence of its
    units (`_UNITS`), each distinct one is encoded once and remembered."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        size = self.library.get_vocab_size()
        self.code, self.width = ("H", 2) if size <= 2**16 else ("I", 4)  # machines are little-endian
        names = self.library.get_vocab(with_added_tokens=True)
        self.blank = np.zeros(max(names.values()) + 1, bool)
        self.blank[[i for t, i in names.items() if t[0] == "\u0120"]] = True  # the byte-level sign of a blank
        # If nothing but byte-level pieces precedes the model, words go to the model itself.
        parts = [self.library.normalizer, type(self.library.pre_tokenizer).__name__]
        self.plain = parts == [None, "ByteLevel"] and self._model(_PROBE) == self._library(_PROBE)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in found]

    def _model(self, words: list[str]) -> list[bytes]:
        """Ids of words, each with a blank in front, from the model alone."""
        model, code = self.library.model.tokenize, self.code
        spelt = ("\u0120" + w[1:] if w.isascii() else w.encode().decode("latin-1").translate(_BYTES) for w in words)
        return [array(code, [t.id for t in model(s)]).tobytes() for s in spelt]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words, each with a blank in front, encoded as one text: each
        begins at the only token in it that starts with a blank."""
        ids = np.array(self.library.encode("".join(words), add_special_tokens=False).ids, np.int64)
        starts = np.flatnonzero(self.blank[ids])
        if len(starts) != len(words):
            return self._library(words)
        data, cuts = array(self.code, ids.tolist()).tobytes(), (self.width * np.append(starts, len(ids))).tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _remember(self, words: list[str], ids: list[bytes]) -> None:
        self.known.update(zip(words, ids))
        self.size += sum(map(len, words)) + sum(map(len, ids)) + ENTRY_BYTES * len(words)

    def _learn(self, new: set[str]) -> None:
        """Encodes and remembers units that are not known."""
        again = [u for u in new if u in self.older]
        self._remember(again, [self.older[u] for u in again])
        new.difference_update(again)
        words = [u for u in new if u[0] == " " and u[1:].isalpha()]
        new.difference_update(words)
        if self.plain:  # letters of this range are letters to any version of the pattern
            latin = [u for u in words if u.isascii() or max(u) <= "\xff"]
            self._remember(latin, self._model(latin))
            words = [u for u in words if not (u.isascii() or max(u) <= "\xff")]
        for at in range(0, len(words), 1000):
            some = words[at:at + 1000]
            self._remember(some, self._joined(some))
        rest = list(new)
        self._remember(rest, self._library(rest))

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """Serialized ids of whole texts, each with the end id."""
        tail = array(self.code, [end]).tobytes()
        whole = [any(s in t for s in self.special) for t in texts]
        units = [[] if w else _UNITS.findall(t) for t, w in zip(texts, whole)]
        if self.size > REMEMBERED // 2:
            self.known, self.older, self.size = {}, self.known, 0
        self._learn(set().union(*units).difference(self.known))
        get = self.known.__getitem__
        out = [b"".join(map(get, x)) + tail for x in units]
        for k in (k for k, w in enumerate(whole) if w):
            out[k] = self._library([texts[k]])[0] + tail
        return out


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)


def _chunks(texts: list[str], size: int):
    """Slices of `texts` with about `size` characters each."""
    at = total = 0
    for k, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield at, k + 1
            at, total = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def train(texts: DataFrame, tokenizer: str, end: int, sample_rows: int) -> bytes:
    """A dictionary for the serialized ids; empty if the sample is too small."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(load(tokenizer).encode(batch.column(0).to_pylist(), end), pa.binary())],
                                             names=["ids"])

    chosen = sample(texts, sample_rows, SAMPLE_TEXT)
    samples = [bytes(r["ids"]) for r in chosen.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write(docs: DataFrame, path: str, tokenizer: str, end: int = 0, sample_rows: int = 400) -> None:
    """Writes `docs` (doc_id, text) as a file set at `path`.  Texts are encoded
    and compressed where they are read; what is put in order is frames.  Rows
    with the same id, however many, are ordered by their frames and spread over
    shards like any others."""
    spark = docs.sparkSession
    texts = id_and_text(docs)
    data = train(texts, tokenizer, end, sample_rows)
    digest = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(digest, bytearray(data))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def compress(batches):
        encoder, compressor = load(tokenizer), zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _chunks(texts, CHUNK):
                encoded = encoder.encode(texts[a:b], end)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array([len(x) // encoder.width for x in encoded], pa.int32()),
                     pa.array([compressor.compress(x) for x in encoded], pa.binary())], names=["doc_id", "n", "frame"])

    frames, stored = store(texts.mapInArrow(compress, "doc_id long, n int, frame binary"), "frames")
    size = frames.agg(F.sum(F.octet_length("frame").cast("long")).alias("b")).first()["b"] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    order = ["doc_id", "hash", "number"]
    ordered = (frames.withColumns({"hash": F.xxhash64("frame"), "number": F.monotonically_increasing_id()})
               .repartitionByRange(max(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), *order)
               .sortWithinPartitions(*order).select(F.spark_partition_id().alias("shard"), "doc_id", "n", "frame"))

    def blocks(batches):
        shard, block, ids, counts, frames, size = 0, 0, [], [], [], 0

        def flush():
            ends = np.cumsum([0, *map(len, frames)])
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t.type) for x, t in zip(
                    (shard, block, digest, ids[0], ids[-1], sum(counts), ids, counts, ends.tolist(), b"".join(frames)), _block_schema())],
                names=[f.name for f in _block_schema()])

        for batch in batches:
            for shard, doc, n, frame in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(doc)
                counts.append(n)
                frames.append(frame)
                size += len(frame)
                if size >= BLOCK_BYTES:
                    yield flush()
                    block, ids, counts, frames, size = block + 1, [], [], [], 0
        if ids:
            yield flush()

    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    drop_stored(spark, stored)


def _block_schema() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("dictionary_sha256", pa.string()), ("first_doc", pa.int64()),
                      ("last_doc", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("counts", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())])


def _read_dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(row["dictionary"])
    if hashlib.sha256(data).hexdigest() != row["sha256"]:
        raise ValueError(f"the dictionary of {path} does not have its recorded hash")
    return row["sha256"], data


def _frames(blocks: DataFrame, digest: str, data: bytes, wanted: int | None = None) -> DataFrame:
    """The documents of `blocks` (with a column `start`): doc_id, start,
    n_tokens and `ids`, little-endian 4-byte integers."""

    def run(batches):
        decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_sha256"] != digest:
                    raise ValueError("a block was written with another dictionary")
                out, at = [], row["start"]
                for doc, n, a, b in zip(row["doc_ids"], row["counts"], row["offsets"], row["offsets"][1:]):
                    if wanted is None or doc == wanted:
                        raw = decompressor.decompress(row["payload"][a:b])
                        ids = np.frombuffer(raw, np.dtype(f"<u{len(raw) // n}")).astype("<u4").tobytes()
                        out.append((doc, at, n, ids))
                    at += n
                for k in range(0, len(out), 500):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out[k:k + 500]), [pa.int64()] * 3 + [pa.binary()])],
                        names=["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read(spark: SparkSession, path: str, doc_id: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) per document; `start` counts the ids of
    all documents before it.  With `doc_id`, only the blocks that may hold it
    are read and only its frames are decompressed."""
    digest, data = _read_dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # Ids before each shard: one row per shard; inside a shard, by block.
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    inside = (blocks.select("shard", "block", "n_tokens")
              .withColumn("at", F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_tokens"))
              .join(before, "shard").select("shard", "block", (F.col("base") + F.col("at")).alias("start")))
    if doc_id is not None:
        blocks = blocks.filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    placed = blocks.join(inside, ["shard", "block"]).select(
        "dictionary_sha256", "start", "doc_ids", "counts", "offsets", "payload")
    return with_null_ids(_frames(placed, digest, data, doc_id))

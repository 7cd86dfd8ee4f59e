"""Operator 10: token ids as binary output.

Method: ids are ranked by their frequency over the corpus, and the ranks are
written in a byte-aligned variable-length code whose control bytes are kept
apart from the data bytes: two control bits an id give its 1 to 4 data bytes,
little-endian.  Decoding looks each control byte up in a numpy table.

1. The documents are range-partitioned and sorted by doc_id, and every whole
   text is encoded; the ids go to a scratch table (two bytes an id while the
   vocabulary allows it), with their partition and place in it.
2. Ids are counted; the ranking has one entry an id of the vocabulary.
3. The ranks are written as blocks, a row each: ``part`` and ``seq`` (place of
   the first document, ascending with doc_id), doc_ids, the ids of each
   document, control bytes and data bytes.  The files are Parquet, so that
   Spark commits them whole even if an executor is lost.
4. ``read_back`` reads the files and decodes them.

Encoding cuts texts at spaces that stand alone and encodes each distinct piece
once a chunk, with a bounded cache: byte-level BPE cuts there by itself (its
pattern never joins a space to what stands before it), so the ids are those of
the whole text.  New pieces are encoded many at a time.  Texts with other runs of space at a cut are encoded whole.

Defined cases: NULL text is empty and has the end id only; rows without a
doc_id come first; rows that repeat a doc_id follow each other, ordered by
their text; other columns are ignored.
"""
from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path
from .common import stage, text_chunks

BLOCK_IDS = 1 << 16
#: Distinct pieces whose ids a Python worker keeps between chunks.
CACHE_PIECES = 800_000
#: New words encoded as one text.
WORDS_A_TEXT = 100
_PUNCTUATION = frozenset(".,!?;:")
#: How a byte-level vocabulary writes a space.
_SPACE = "\u0120"
_ENCODERS: dict[tuple, Encoder] = {}


class Encoder:
    """Ids of texts as bytes, with a bounded cache by piece of text."""

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.kind, self.item = kind, np.dtype(kind).itemsize
        #: ids of words by what stands before them, a space or nothing
        self.cache: dict[str, dict[str, bytes]] = {" ": {}, "": {}}
        tokens = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(tokens.values(), default=0) + 1, bool)
        self.opens[[k for t, k in tokens.items() if t.startswith(_SPACE)]] = True

    @classmethod
    def of(cls, path: str, kind: str) -> Encoder:
        """The worker's own encoder: its cache outlives the task."""
        if (path, kind) not in _ENCODERS:
            _ENCODERS[path, kind] = cls(path, kind)
        return _ENCODERS[path, kind]

    def _plain(self, texts: list[str]) -> list[bytes]:
        out = []
        for lo in range(0, len(texts), 20_000):
            got = self.tokenizer.encode_batch_fast(texts[lo:lo + 20_000], add_special_tokens=False)
            out += [np.array(e.ids, self.kind).tobytes() for e in got]
        return out

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it, many words a text.

        A word holds no space, so a token that begins with one begins a word.  Where
        not every word has its own such token, its text's words are encoded one by one.
        """
        out = []
        for lo in range(0, len(words), 20_000):
            parts = [words[k:k + WORDS_A_TEXT] for k in range(lo, min(lo + 20_000, len(words)), WORDS_A_TEXT)]
            got = self.tokenizer.encode_batch_fast([" " + " ".join(x) for x in parts], add_special_tokens=False)
            for part, e in zip(parts, got, strict=True):
                ids = np.array(e.ids, np.int64)
                starts = np.flatnonzero(self.opens[ids])
                if len(starts) == len(part) and starts[0] == 0:
                    raw, at = ids.astype(self.kind).tobytes(), (np.r_[starts, len(ids)] * self.item).tolist()
                    out += [raw[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
                else:
                    out += self._plain([" " + x for x in part])
        return out

    def pieces(self, words: np.ndarray, space: str) -> list[bytes]:
        """Ids of ``space`` and each word; none for a word that is empty or has space
        at an end.  Letters and a mark after them are encoded apart, as the pattern of
        the tokenizer has them."""
        cache = self.cache[space]
        out = list(map(cache.get, words))
        missing = [k for k, x in enumerate(out) if x is None]
        wanted = words[missing].tolist()
        stems = [x[:-1] if x[-1:] in _PUNCTUATION and x[:-1].isalpha() else x for x in wanted]
        new = set(stems).difference(cache)
        odd = [x for x in new if not x or x.strip() != x]
        new = list(new.difference(odd))
        got = dict(zip(new, self._spaced(new) if space else self._plain(new), strict=True))
        marks = dict(zip(_PUNCTUATION, self._plain(list(_PUNCTUATION)), strict=True))
        none = dict.fromkeys(odd, b"")
        for k, word, stem in zip(missing, wanted, stems, strict=True):
            ids = got.get(stem) or cache.get(stem) or none[stem]
            out[k] = ids if stem is word else ids + marks[word[-1]]
        room = CACHE_PIECES - sum(map(len, self.cache.values()))
        if room >= len(got):
            cache.update(got)
        elif room > 0:
            cache.update(islice(got.items(), room))
        return out

    def encode(self, texts: pa.Array, end_id: int) -> pa.Array:
        """Ids of each whole text and the end id, as bytes."""
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        words = lists.flatten().dictionary_encode()
        # as objects in one step: ``to_pylist`` takes a microsecond or two a word
        codes, known = words.indices.to_numpy(zero_copy_only=False), words.dictionary.to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        # codes of first pieces (no space before them) come after the others, the end id last
        opening, at = np.unique(codes[ends - sizes], return_inverse=True)
        codes = codes.astype(np.int64)
        codes[ends - sizes] = len(known) + at
        ids = pa.array(self.pieces(known, " ") + self.pieces(known[opening], "") +
                       [np.array([end_id], self.kind).tobytes()], pa.binary())
        odd = pc.equal(pc.binary_length(ids), 0).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(np.logical_or.reduceat(odd[codes], ends - sizes))
        # the pieces of all texts in one buffer, cut after each end id
        flat = ids.take(pa.array(np.insert(codes, ends, len(ids) - 1)))
        cuts = np.frombuffer(flat.buffers()[1], np.int32)[np.r_[0, ends + 1 + np.arange(len(ends))]]
        out = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cuts), flat.buffers()[2]])
        if len(whole):
            again = self._plain(texts.take(pa.array(whole)).to_pylist())
            out = out.to_pylist()
            for k, x in zip(whole, again, strict=True):
                out[k] = x + ids[-1].as_py()
            out = pa.array(out, pa.binary())
        return out


def id_kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 0, vocabulary: int = 1 << 16) -> DataFrame:
    """(part, seq, doc_id, ids) in the order of doc_id: ids as little-endian
    integers of 2 or 4 bytes."""
    kind = id_kind(vocabulary)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = Encoder.of(tokenizer, kind), TaskContext.get().partitionId(), 0
        for chunk in text_chunks(batches, "text"):
            n = chunk.num_rows
            yield pa.record_batch([np.full(n, part, np.int32), np.arange(seq, seq + n), chunk.column("doc_id"),
                                   encoder.encode(chunk.column("text"), end_id)], ["part", "seq", "doc_id", "ids"])
            seq += n

    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .repartitionByRange(parts, order[0]).sortWithinPartitions(*order) \
        .mapInArrow(run, f"part int, seq long, doc_id {id_type}, ids binary")


def frequency_ranks(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """Ids by falling count over the corpus (ties by id): rank -> id, an entry
    an id of the vocabulary whatever the corpus holds."""
    kind = id_kind(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                joined = b"".join(b.column(0).slice(lo, 500).to_pylist())
                total += np.bincount(np.frombuffer(joined, kind), minlength=vocabulary)
        at = np.flatnonzero(total)
        yield pa.record_batch([at, total[at]], ["id", "n"])

    got = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(vocabulary, np.int64)
    counts[got["id"].to_numpy()] = got["n"].to_numpy()
    return np.lexsort((np.arange(vocabulary), -counts)).astype(np.uint32)


def pack_ids(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    quads = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    quads[:len(ranks)] = extra
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


#: Lengths of the four ids of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def unpack_ids(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    at = np.cumsum(size) - size
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = size > k
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, vocabulary: int = 1 << 16) -> np.ndarray:
    """Write the corpus to ``path``; returns the ranking that reads it."""
    kind = id_kind(vocabulary)
    tokens = stage(token_table(docs, tokenizer, end_id, vocabulary), "tokens", "zstd")
    by_rank = frequency_ranks(tokens, vocabulary)
    rank_of = np.empty(vocabulary, np.uint32)
    rank_of[by_rank] = np.arange(vocabulary, dtype=np.uint32)
    ranks = docs.sparkSession.sparkContext.broadcast(rank_of)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, seq = b.column("part").to_numpy(), b.column("seq").to_numpy()
            sizes = pc.binary_length(b.column("ids")).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize
            # a new block where the partition changes and every BLOCK_IDS ids
            fill = (np.cumsum(sizes) - sizes) // BLOCK_IDS
            cuts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (fill[1:] != fill[:-1]) | (seq[1:] != seq[:-1] + 1)])
            for lo, hi in zip(cuts, np.r_[cuts[1:], len(part)], strict=True):
                ids = np.frombuffer(b"".join(b.column("ids").slice(lo, hi - lo).to_pylist()), kind)
                control, data = pack_ids(ranks.value[ids])
                doc_ids = b.column("doc_id").slice(lo, hi - lo)
                yield pa.record_batch(
                    [part[lo:lo + 1], seq[lo:lo + 1], pa.array([doc_ids.to_pylist()], pa.list_(doc_ids.type)),
                     pa.array([sizes[lo:hi].tolist()], pa.list_(pa.int64())), pa.array([control], pa.binary()),
                     pa.array([data], pa.binary())], ["part", "seq", "doc_ids", "sizes", "control", "data"])

    tokens.mapInArrow(blocks, f"part int, seq long, doc_ids array<{id_type}>, sizes array<long>, control binary, data binary") \
        .write.option("compression", "zstd").parquet(path)
    return by_rank


def read_back(spark, path: str, by_rank: np.ndarray) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.parquet(path)
    id_type = files.schema["doc_ids"].dataType.elementType.simpleString()
    ids = spark.sparkContext.broadcast(by_rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                docs, sizes = b.column("doc_ids")[k].values, b.column("sizes")[k].values.to_numpy()
                ends = np.cumsum(sizes)
                x = ids.value[unpack_ids(b.column("control")[k].as_py(), b.column("data")[k].as_py(), int(ends[-1]))]
                raw = memoryview(x.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                m = len(docs)
                yield pa.record_batch([docs, ends - sizes, sizes, np.array(crc, np.int64),
                                       pa.array([b.column("part")[k].as_py()] * m, pa.int32()),
                                       pa.array([b.column("seq")[k].as_py()] * m, pa.int64())],
                                      ["doc_id", "inside", "n_tokens", "ids_crc32", "part", "seq"])

    rows = files.mapInArrow(run, f"doc_id {id_type}, inside long, n_tokens long, ids_crc32 long, part int, seq long")
    # one row a block; the second window runs over one row a partition
    per_block = files.select("part", "seq", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part_start = per_block.groupBy("part").agg(F.sum("n").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(per_block.withColumn("block_start", F.coalesce(F.sum("n").over(before), F.lit(0)))
                   .drop("n").join(part_start, "part"), "starts")
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("part_start") + F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 0, vocabulary: int = 1 << 16, path: str | None = None) -> DataFrame:
    """Encode, write and read back (see the module)."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "llm", f"token-files-{uuid.uuid4().hex}")
    return read_back(spark, path, write_tokens(docs, path, tokenizer, end_id, vocabulary))

"""Token ids in compressed files: a wavelet matrix per shard.

A shard holds the ids of consecutive documents as one bit-plane per bit of the largest id, highest first. Each plane
lists the ids stably parted by the bits above it, so rank and select on the planes give the id at a place, the
number of occurrences of an id in a range, and the place of its k-th occurrence, all from the one file.

File: magic, length of the header; the header (JSON: sizes, zeros of each plane, compressed size of each block); the rank
directory (ones before each block of each plane); the keys and lengths of the documents (Arrow, zstd); and the planes in blocks, each
compressed alone. Access, count and occurrence lookup read the head and then a block or two for each plane, a few KB each.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagefold.llm.bpe import byte_symbols
from pagefold.llm.common import BATCH_ROWS, Memo, arrow_rows, fresh_path, only, slices

MAGIC = b"WAVEMAT2"
MEMO_WORDS = 250_000
#: Ids in a shard, give or take a document's.
SHARD_IDS = 1 << 20
BLOCK_BYTES = 8192  # of a plane between two entries of its rank directory, compressed alone
#: No match of the tokenizer's own splitting crosses ASCII white space, which it drops.
WORDS = re.compile(r"[^ \t\n\r\f\v]+")
#: White space besides ASCII's, and separators that Python's patterns may count as such, within Latin-1.
ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
ODD_LATIN_SPACE = ("\x85", "\xa0")
#: Runs of Latin-1 letters, and of what is neither letter nor white space: pieces that encode on their own, but for
#: an apostrophe, which the library's splitting may join with letters after it.
PIECES = re.compile(r"[a-zªµºß-öø-ÿ]+|[^a-zªµºß-öø-ÿ \t\n\r\f\v]+")
LETTERS = re.compile(r"[a-zªµºß-öø-ÿ]+")


class WaveletMatrix:
    """Bit-planes with rank and select over a sequence of unsigned ids.

    zeros: zero bits of each plane; ranks: ones before each block of each plane; piece(level, block): the bytes of a block.
    """

    def __init__(self, n: int, zeros: list[int], ranks: np.ndarray, piece: Callable[[int, int], np.ndarray]):
        self.n, self.zeros, self.ranks, self.piece, self.depth = n, zeros, ranks, piece, len(zeros)

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        zeros, planes, ranks = [], [], []
        for b in range(depth - 1, -1, -1):
            bit = (now >> b) & 1 == 1
            plane = np.packbits(bit)
            whole = np.pad(plane, (0, -len(plane) % BLOCK_BYTES)).reshape(-1, BLOCK_BYTES)
            ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(whole.view(np.uint64)).sum(1, dtype=np.int64))]))
            planes.append(plane)
            low = np.compress(~bit, now)
            zeros.append(len(low))
            now = np.concatenate([low, np.compress(bit, now)])
        return cls(len(ids), zeros, np.array(ranks, np.int64).reshape(depth, -1), lambda level, k: planes[level][k * BLOCK_BYTES : (k + 1) * BLOCK_BYTES])

    @property
    def blocks(self) -> int:
        return -(-self.n // (8 * BLOCK_BYTES))

    def _bits(self, level: int) -> np.ndarray:
        parts = [self.piece(level, k) for k in range(self.blocks)]
        return np.unpackbits(np.concatenate(parts) if parts else np.empty(0, np.uint8), count=self.n).view(bool)

    def all(self) -> np.ndarray:
        """Every id in order, from the lowest plane up."""
        now = np.zeros(self.n, np.uint16 if self.depth <= 16 else np.uint32)
        for level in range(self.depth - 1, -1, -1):
            bit, z, up = self._bits(level), self.zeros[level], np.empty_like(now)
            up[np.flatnonzero(~bit)] = now[:z]
            up[np.flatnonzero(bit)] = now[z:] | now.dtype.type(1 << (self.depth - 1 - level))
            now = up
        return now.astype(np.uint32)

    def _rank(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block, rest = divmod(i, 8 * BLOCK_BYTES)
        ones = int(self.ranks[level][block])
        if rest:
            part = self.piece(level, block)[: (rest + 7) // 8]
            ones += int(np.bitwise_count(part).sum())
            if rest % 8:
                ones -= (int(part[-1]) & (0xFF >> (rest % 8))).bit_count()
        return ones

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit of a plane: its block from the directory, then its place in the block."""
        before = self.ranks[level] if bit else np.arange(self.blocks + 1) * (8 * BLOCK_BYTES) - self.ranks[level]
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.piece(level, block))
        return block * 8 * BLOCK_BYTES + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(self.depth):
            ones = self._rank(level, i)
            bit = self._rank(level, i + 1) - ones
            out = out << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.depth:
            return 0, 0
        for level in range(self.depth):
            a, b = self._rank(level, lo), self._rank(level, hi)
            if token >> (self.depth - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in [lo, hi)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def occurrence(self, token: int, k: int) -> int | None:
        """Place of the k-th (from 0) occurrence of an id; None where there are fewer."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            return None
        at = lo + k
        for level in range(self.depth - 1, -1, -1):
            bit = token >> (self.depth - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at


def dump(wavelet: WaveletMatrix, keys: pa.Array, lengths: list[int]) -> bytes:
    zstd = pa.Codec("zstd", compression_level=1)
    blocks = [zstd.compress(wavelet.piece(level, k).tobytes(), asbytes=True) for level in range(wavelet.depth) for k in range(wavelet.blocks)]
    sink = pa.BufferOutputStream()
    documents = pa.RecordBatch.from_arrays([keys, pa.array(lengths, pa.int64())], ["key", "length"])
    with pa.ipc.new_stream(sink, documents.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(documents)
    told, ranks = sink.getvalue().to_pybytes(), wavelet.ranks.astype("<i8").tobytes()
    head = json.dumps({"n": wavelet.n, "zeros": wavelet.zeros, "documents": len(told), "ranks": len(ranks), "blocks": [len(b) for b in blocks]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(8, "little"), head, ranks, told, *blocks])


class Shard:
    """A shard's file, of which only what is asked for is read. at(start, size): bytes of the file."""

    def __init__(self, at: Callable[[int, int], bytes]):
        if at(0, 8) != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size = int.from_bytes(at(8, 8), "little")
        head = json.loads(at(16, size))
        depth, start = len(head["zeros"]), 16 + size
        ranks = np.frombuffer(at(start, head["ranks"]), "<i8").reshape(depth, -1)
        self._documents = (start + head["ranks"], head["documents"])
        starts = np.cumsum([sum(self._documents), *head["blocks"]])
        per_plane, zstd, n = len(head["blocks"]) // depth, pa.Codec("zstd"), head["n"]

        @lru_cache(4 * depth)
        def piece(level: int, k: int) -> np.ndarray:
            i = level * per_plane + k
            size = min(BLOCK_BYTES, (n + 7) // 8 - k * BLOCK_BYTES)
            return np.frombuffer(zstd.decompress(at(int(starts[i]), head["blocks"][i]), size, asbytes=True), np.uint8)

        self.at, self.wavelet = at, WaveletMatrix(n, head["zeros"], ranks, piece)

    def documents(self) -> pa.Table:
        """key and length of the shard's documents, in order."""
        return pa.ipc.open_stream(self.at(*self._documents)).read_all()


def in_memory(data: bytes) -> Shard:
    return Shard(lambda start, size: data[start : start + size])


def opened(where: str, path: str) -> Shard:
    """A shard of a store, read by ranges."""
    fs, _ = pyarrow.fs.FileSystem.from_uri(where)
    f = fs.open_input_file(path)
    return Shard(lambda start, size: f.read_at(size, start))


def in_pieces(text: str) -> bool:
    """Whether a text can be lower-cased and cut into pieces here: not with characters beyond Latin-1, what may be a special
    token, apostrophes, or white space of other kinds. Each test is one pass over memory."""
    if "'" in text or "<|" in text or any(c in text for c in ODD_SPACE):
        return False
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not any(c in text for c in ODD_LATIN_SPACE)


class WordCoder:
    """The library's encoder, asked once for each distinct word.

    Runs of non-space characters encode on their own. Most texts are cut further, into runs of letters and other runs;
    words of letters are asked for straight from the library's model, as each is one piece of its splitting.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: Memo = Memo(MEMO_WORDS)
        # only a file that lower-cases, drops white space and splits off runs of letters may be asked in bare words
        probe = self.tokenizer.encode_batch(["Ab ,ab", "ab , ab"], add_special_tokens=False)
        self.bare = probe[0].ids == probe[1].ids and probe[0].word_ids == [0, 1, 2]
        self.byte_level = {chr(c): "".join(byte_symbols()[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self.byte_level = str.maketrans(self.byte_level)

    def words(self, text: str) -> list[str]:
        if self.bare and in_pieces(text):
            return PIECES.findall(text.lower())
        return WORDS.findall(text)

    def ask(self, new: list[str]) -> None:
        """Puts new runs into the memo."""
        memo, tokenize, rest = self.memo, self.tokenizer.model.tokenize, []
        for w in new:
            if self.bare and LETTERS.fullmatch(w):
                memo[w] = array("I", [t.id for t in tokenize(w if w.isascii() else w.translate(self.byte_level))]).tobytes()
            else:
                rest.append(w)
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ()):
            memo[w] = np.array(e.ids, "<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        words = [self.words(t) for t in texts]
        self.ask(self.memo.missing(set().union(*words)))
        of = self.memo.__getitem__
        return [b"".join(map(of, ws)) for ws in words]


@lru_cache(2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def write(docs: DataFrame, vocab_path: str, end_id: int, where: str | None = None, text: str = "text", key: str = "doc_id", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes every whole text, ends each with `end_id`, and writes the ids in ascending order of the key as shards.

    Returns the manifest, one row per shard in order of (part, seq): part, seq, path, n_docs, n_ids, start (ids in
    all shards before). It is stored beside the shards. A null text counts as empty and gives the end id alone; null
    keys come first; rows with the same key are ordered by text. Further columns are left out.

    The table is dealt out by ranges of the key, then each task encodes and writes its own shards; only the
    manifest leaves it. A task that is run again writes files of new names, and the manifest names one set.
    """
    spark = docs.sparkSession
    where = where or fresh_path(spark, "tokens")
    rows = only(docs, key, text).toDF("k", "t").withColumn("t", F.coalesce("t", F.lit(""))).withColumn("h", F.xxhash64("t"))
    rows = rows.repartitionByRange(F.col("k"), F.col("h")).sortWithinPartitions("k", "t").select("k", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), coder(vocab_path).encode_batch
        fs, base = pyarrow.fs.FileSystem.from_uri(where)
        fs.create_dir(base, recursive=True)
        end = np.array([end_id], "<u4").tobytes()
        held, keys, lengths, n, seq, kind = [], [], [], 0, 0, None

        def close() -> pa.RecordBatch:
            name = f"{base}/{part:06d}-{seq:06d}-{uuid.uuid4().hex[:8]}.wm"
            with fs.open_output_stream(name) as f:
                f.write(dump(WaveletMatrix.build(np.frombuffer(b"".join(held), "<u4")), pa.array(keys, kind), lengths))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "seq": pa.array([seq], pa.int64()), "path": [name], "n_docs": pa.array([len(keys)], pa.int64()), "n_ids": pa.array([n], pa.int64())})

        for batch in slices(batches, 1):
            kind = batch.schema.field(0).type
            for k, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                held += [ids, end]
                keys.append(k)
                lengths.append(len(ids) // 4 + 1)
                n += lengths[-1]
                if n >= shard_ids:
                    yield close()
                    held, keys, lengths, n, seq = [], [], [], 0, seq + 1
                    pa.default_memory_pool().release_unused()
        if keys:
            yield close()

    listed = f"{where}/manifest"
    with arrow_rows(spark, BATCH_ROWS):
        rows.mapInArrow(run, "part bigint, seq bigint, path string, n_docs bigint, n_ids bigint").write.parquet(listed)
    return manifest(spark, where)


def manifest(spark: SparkSession, where: str) -> DataFrame:
    """The shards of a store; sums of whole parts come first, so that no window spans all shards."""
    shards = spark.read.parquet(f"{where}/manifest")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = parts.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("before"))
    within = Window.partitionBy("part").orderBy("seq")
    return shards.join(before, "part").withColumn("start", F.col("before") + F.sum("n_ids").over(within) - F.col("n_ids")).drop("before").withColumn("where", F.lit(where))


def read(shards: DataFrame, key: str = "doc_id", kind: str = "bigint", with_ids: bool = False) -> DataFrame:
    """Documents of the shards' files: key (of the type `kind`), start (ids of all documents before), n_tokens, ids_crc32 (CRC-32 of the
    ids as little-endian unsigned 32-bit integers), and with `with_ids` also ids. A shard is read as a whole, plane by plane."""
    schema = f"`{key}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, path, start in zip(*(c.to_pylist() for c in batch.columns)):
                fs, _ = pyarrow.fs.FileSystem.from_uri(where)
                with fs.open_input_stream(path) as f:
                    shard = in_memory(f.read())
                documents, ids = shard.documents().combine_chunks(), shard.wavelet.all().astype("<u4")
                lengths = documents.column("length").to_numpy()
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends - lengths, ends)]
                columns = [documents.column("key").chunk(0), pa.array(ends - lengths + start), pa.array(lengths), pa.array(crcs, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [key, "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    # shards are large and the manifest is small: a given number of partitions keeps Spark from putting it into one
    tasks = max(1, min(shards.count(), 20_000))
    return shards.select("where", "path", "start").repartition(tasks, F.col("path")).mapInArrow(run, schema)

"""Token-id files: independent zstandard frames with a trailing seek table.

A file is a row of zstandard frames, one for each document, each with its own content checksum.
The last frame is a skippable one, the seek table: for every document its id, offset, compressed
size, number of ids and crc32 of its ids. A reader takes the table and decompresses only the frames
it wants. Any zstandard decoder reads the whole file.

Spark's own writer puts the frames down: each frame is one row of a text file, and the line
separator is an empty skippable frame, so commit, retry and every Hadoop file system are Spark's.

    file  := (frame gap)* table gap
    gap   := magic 0x184D2A50, length 0                                       8 bytes
    table := magic 0x184D2A5E, length, entry*, footer
    entry := doc_id i64, offset u64, compressed u32, ids u64, crc32 u32       32 bytes
    footer:= shard u64, entries u32, width u8, version u8, magic 0x53454B54   18 bytes

Ids are little-endian, of 2 bytes where the vocabulary has 65,536 ids at most, else of 4. The crc32
is over 4-byte ids in either case. A null document id is written as the smallest i64.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm.words import kept

ENTRY, FOOTER, HEAD = "<qQIQI", "<QIBBI", "<II"
ENTRY_SIZE, FOOTER_SIZE = struct.calcsize(ENTRY), struct.calcsize(FOOTER)
GAP_MAGIC, TABLE_MAGIC, FOOTER_MAGIC, VERSION = 0x184D2A50, 0x184D2A5E, 0x53454B54, 1
GAP = struct.pack(HEAD, GAP_MAGIC, 0)
NO_ID = -(2**63)
#: Distinct words that each of a worker's two generations of remembered ids holds.
REMEMBERED = 120_000
#: Bytes of the texts whose words are looked for together.
TOGETHER = 30_000


#: Marks that are a piece of their own behind a word, and a run of them between an ASCII letter and white space.
MARKS = ".,;:!?#$%&"
END_MARKS = re.compile(rb"([%(m)s](?<=[A-Za-z].)[%(m)s]*+)(?=\s)" % {b"m": MARKS.encode()})


#: Words of these letters are in composed form, and are one piece before merging.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def byte_names() -> list[str]:
    """Byte-level models write each byte as a printable character: itself, or the next one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class WordIds:
    """Ids of a text from those of its words, as the tokenizer has them.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its
    words in a row; a run of MARKS at a word's end is encoded on its own. Only words not seen
    lately are given to the tokenizer: of two generations of remembered words the older is dropped
    when the younger is full. Tokenizers that keep white space encode whole texts instead.
    """

    def __init__(self, definition: str, by_word: bool = True, plain: bool = False):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_str(definition), by_word
        self.model, self.plain = self.tokenizer.model, plain
        self.byte_names = byte_names()
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.few = [struct.Struct(f"<{n}{'H' if self.dtype == '<u2' else 'I'}").pack for n in range(32)]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def packed(self, texts: list[str]) -> list[bytes]:
        simple = [bool(LETTERS.fullmatch(t)) for t in texts] if self.plain else [False] * len(texts)
        rest = [t for t, s in zip(texts, simple) if not s]
        encoded = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else [])
        return [self.pack(self.by_model(t) if s else next(encoded).ids) for t, s in zip(texts, simple)]

    def pack(self, ids: list[int]) -> bytes:
        return self.few[len(ids)](*ids) if len(ids) < len(self.few) else np.array(ids, self.dtype).tobytes()

    def by_model(self, word: str) -> list[int]:
        """Ids of a word of letters that normalising only lower-cases: straight from the tokenizer's model."""
        low = word.lower()
        return [t.id for t in self.model.tokenize(low if low.isascii() else "".join([self.byte_names[b] for b in low.encode()]))]

    def encode(self, text: bytes) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        """`encode` of each text; a word that several of them have is looked for once."""
        if not self.by_word:
            return [self.packed([t.decode("utf-8", "replace")])[0] for t in texts]
        words = [END_MARKS.sub(rb" \1", t).split() for t in texts]
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, flat = self.known, list(chain.from_iterable(words))
        ids = list(map(known.get, flat))
        if unseen := [k for k, own in enumerate(ids) if own is None]:
            met = {flat[k] for k in unseen}
            new = met.difference(self.older)
            again = met - new
            known.update(zip(again, map(self.older.__getitem__, again)))
            new = list(new)
            for i in range(0, len(new), 4096):
                known.update(zip(new[i : i + 4096], self.packed([w.decode("utf-8", "replace") for w in new[i : i + 4096]])))
            for k in unseen:
                ids[k] = known[flat[k]]
        ends = list(accumulate(map(len, words)))
        return [b"".join(ids[lo:hi]) for lo, hi in zip([0, *ends[:-1]], ends)]


def _together(texts: Iterable[pa.Scalar]) -> Iterator[list[bytes]]:
    """The texts in a row, null ones empty, in lists of TOGETHER bytes or one text more."""
    own, held = [], 0
    for t in texts:
        own.append(t.as_py() or b"")
        held += len(own[-1])
        if held > TOGETHER:
            yield own
            own, held = [], 0
    if own:
        yield own


def shortcuts(definition: str) -> tuple[bool, bool]:
    """Whether words can be encoded on their own, and words of letters by the model alone: tried on a sample."""
    one, whole = WordIds(definition), WordIds(definition, by_word=False)
    marked = f"{' '.join(f'x{a} y{a}{b} Z{b}{a}{a}{b}' for a in MARKS for b in MARKS)} it's... we'll! x2% 3;; é?! -&".encode()
    tried = (b"a b", b" Ab  cd\n\te ", b"it's  12 x. y, z.", "é ́ ß".encode(), marked)
    added = "".join(t.content for t in one.tokenizer.get_added_tokens_decoder().values())
    by_word = not set(MARKS).intersection(added) and all(one.encode(t) == whole.encode(t) for t in tried)
    words = ["a", "Alpha", "internationalisation", "ÀÿÖ", "straße", "ciónñasÉ", "Éé"]
    return by_word, by_word and all(one.by_model(w) == one.tokenizer.encode(w, add_special_tokens=False).ids for w in words)


def write_token_files(docs: DataFrame, path: str, definition: str, end_id: int, doc_id: str = "doc_id", text: str = "text", shards: int | None = None) -> None:
    """Encode every text of `docs`, append `end_id`, and write files of frames in ascending document id.

    Null texts are empty: the end id alone. Null document ids come first. Rows with equal ids are
    ordered by text. An empty table makes a file without entries or none. shards: number of files,
    else Spark's number of partitions. Other columns are not looked at.
    """
    by_word, plain = shortcuts(definition)
    key = hashlib.sha256(f"{by_word} {plain} {definition}".encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept(f"words {key}", lambda: WordIds(shared.value, by_word, plain))
        end = np.array([end_id], words.dtype).tobytes()
        packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        entries, at = [], 0
        for batch in batches:
            frames, size = [], 0
            encoded = chain.from_iterable(map(words.encode_many, _together(batch.column(1))))
            for i, own in zip(batch.column(0).to_pylist(), encoded):
                raw = own + end
                ids = np.frombuffer(raw, words.dtype)
                frame = packer.compress(raw)
                entries.append(struct.pack(ENTRY, NO_ID if i is None else i, at, len(frame), len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                at += len(frame) + len(GAP)
                frames.append(frame)
                size += len(frame)
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])
                    frames, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])
        footer = struct.pack(FOOTER, TaskContext.get().partitionId(), len(entries), np.dtype(words.dtype).itemsize, VERSION, FOOTER_MAGIC)
        table = b"".join(entries) + footer
        yield pa.RecordBatch.from_arrays([pa.array([struct.pack(HEAD, TABLE_MAGIC, len(table)) + table], pa.binary())], names=["frame"])

    source = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("binary").alias("text"))
    ranged = source.repartitionByRange(shards, "doc_id") if shards else source.repartitionByRange("doc_id")
    frames = ranged.sortWithinPartitions("doc_id", "text").mapInArrow(run, "frame binary")
    gap = GAP.decode("ascii")
    frames.select(F.col("frame").cast("string").alias("value")).write.options(lineSep=gap, compression="none", maxRecordsPerFile=0).text(path)


def seek_table(tail: bytes) -> tuple[int, int, list[tuple]]:
    """(shard, width, entries) from a file's last bytes, which must hold its whole table."""
    end = len(tail) - len(GAP)
    shard, n, width, version, magic = struct.unpack_from(FOOTER, tail, end - FOOTER_SIZE)
    if tail[end:] != GAP or magic != FOOTER_MAGIC or version != VERSION:
        raise ValueError("no seek table")
    first = end - FOOTER_SIZE - n * ENTRY_SIZE
    return shard, width, [struct.unpack_from(ENTRY, tail, first + i * ENTRY_SIZE) for i in range(n)]


def decode_frame(frame: bytes, width: int, n: int, crc: int) -> np.ndarray:
    """Ids of a frame; a damaged one is an error."""
    raw = zstandard.ZstdDecompressor().decompress(frame, max_output_size=n * width)
    ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
    if len(ids) != n or zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("checksum of a frame")
    return ids


def _tables(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where(F.col("length") > 0)


def read_token_files(spark: SparkSession, path: str, doc_ids: DataFrame | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids array<long>]) from the files, each frame checked.

    start counts the ids of all documents before it; only the shards' totals, one row a file, are
    summed in a row. doc_ids: a table with the ids wanted; then only their frames are decompressed.
    """

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard, _, entries = seek_table(content.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([sum(e[3] for e in entries)], pa.int64())], names=["shard", "total"])

    def documents(batches: Iterator[pa.RecordBatch], wanted: set | None = None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_buffer()
                shard, width, entries = seek_table(data.slice(max(0, data.size - _table_size(data))).to_pybytes())
                rows, start, held = [], 0, 0
                for doc, at, size, n, crc in entries:
                    ids = decode_frame(data.slice(at, size).to_pybytes(), width, n, crc)
                    rows.append((None if doc == NO_ID else doc, shard, start, n, zlib.crc32(ids.tobytes()), ids if with_ids else None))
                    start += n
                    held += n * with_ids
                    if held > 1 << 20:
                        yield _batch(rows, with_ids)
                        rows, held = [], 0
                yield _batch(rows, with_ids)

    if doc_ids is not None:
        return _picked(spark, path, doc_ids)
    content = _tables(spark, path).select("content")
    sums = content.mapInArrow(totals, "shard long, total long")
    before = F.coalesce(F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("shard", before.alias("before"))
    ids = ", ids array<long>" if with_ids else ""
    docs = content.mapInArrow(documents, f"doc_id long, shard long, start long, n_tokens long, ids_crc32 long{ids}")
    return docs.join(starts, "shard").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def _table_size(data: pa.Buffer) -> int:
    """Bytes from the first entry to the end of the file."""
    end = data.size - len(GAP)
    n = struct.unpack(FOOTER, data.slice(end - FOOTER_SIZE, FOOTER_SIZE).to_pybytes())[1]
    return n * ENTRY_SIZE + FOOTER_SIZE + len(GAP)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "shard", "start", "n_tokens", "ids_crc32"]
    arrays = [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]
    if with_ids:
        arrays.append(pa.array([r[5].astype(np.int64) for r in rows], pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays(arrays, names=[*names, "ids"][: len(arrays)])


def _picked(spark: SparkSession, path: str, doc_ids: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, ids) of the wanted ids, by ranges of bytes.

    A first pass lists where each document lies; the wanted places are joined out of it, and a task
    opens a file once for the ranges it needs.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with _opened(p) as f:
                    tail = _read(f, max(0, n - FOOTER_SIZE - len(GAP)), n)
                    size = int(struct.unpack_from(FOOTER, tail, 0)[1]) * ENTRY_SIZE + FOOTER_SIZE + len(GAP)
                    _, width, entries = seek_table(_read(f, n - size, n))
                cols = list(zip(*entries)) or [[]] * 5
                arrays = [pa.array([p] * len(entries), pa.string()), pa.array([width] * len(entries), pa.int32()), pa.array([None if d == NO_ID else d for d in cols[0]], pa.int64()), *(pa.array(c, pa.int64()) for c in cols[1:])]
                yield pa.RecordBatch.from_arrays(arrays, names=["path", "width", "doc_id", "at", "size", "n", "crc"])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_path, f = None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["path"] != open_path:
                    if f is not None:
                        f.close()
                    open_path, f = r["path"], _opened(r["path"])
                ids = decode_frame(_read(f, r["at"], r["at"] + r["size"]), r["width"], r["n"], r["crc"])
                rows.append((r["doc_id"], r["n"], r["crc"], ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)), pa.array([r[3] for r in rows], pa.list_(pa.int64()))], names=["doc_id", "n_tokens", "ids_crc32", "ids"])
        if f is not None:
            f.close()

    index = _tables(spark, path).select("path", "length").mapInArrow(places, "path string, width int, doc_id long, at long, size long, n long, crc long")
    wanted = index.join(doc_ids.select(F.col(doc_ids.columns[0]).cast("long").alias("doc_id")).distinct(), "doc_id")
    wanted = wanted.select("path", "width", "doc_id", "at", "size", "n", "crc").repartition("path").sortWithinPartitions("path", "at")
    return wanted.mapInArrow(ranges, "doc_id long, n_tokens long, ids_crc32 long, ids array<long>")


def _opened(path: str):
    from pyarrow import fs

    if urlparse(path).scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/*", "/", path))
    files, place = fs.FileSystem.from_uri(path)
    return files.open_input_file(place)


def _read(f, lo: int, hi: int) -> bytes:
    f.seek(lo)
    return f.read(hi - lo)

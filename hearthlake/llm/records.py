"""Token ids in length-delimited binary record files, with an offset index for shuffled reads.

A record is framed as

    length of the payload      unsigned 64 bit, little endian
    masked crc32 of the length unsigned 32 bit
    payload                    id (signed 64 bit), id present (8 bit), token width (8 bit), tokens
    masked crc32 of the payload

The mask rotates the checksum right by 15 bits and adds 0xA282EAD8, so that a checksum stored
inside checked data does not check itself. Tokens take two bytes where the vocabulary allows it.

Texts are dealt by ranges of the document id (Spark samples the bounds) and sorted; the task of a
range encodes them and writes one file, numbered like the range, under a temporary name and renamed
when whole, so a task that runs again replaces its file by the same bytes. The index (a Parquet table) has file, offset,
length, token count and the number of tokens before each record. Readers take any subset or order
of index rows, seek, and check both checksums.

Defined cases: a null text counts as empty and has the end id only; null ids come first; rows that
repeat are separate records, ordered by a hash of their text; an id that holds very many rows is
spread over several files (their order stays ascending), also where the rows are equal; a very long
text is one record; an empty table writes no file; only id and text are read, so other columns
cannot clash.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.llm.common import shared_path, stage

CACHE_WORDS = 700_000  # words of one of the two generations a worker remembers
FILE_DOCS = 20_000  # documents of a file, where that makes more files than there are partitions
BLOCK_FILES = 4096  # files whose token counts are summed together
_PLAIN = re.compile(r"[^\W\d_]+[!-/:-@\[-`{-~]*")  # letters, then ASCII punctuation
META = "<qBB"  # id, id present, bytes of a token
INDEX = ("part long, file string, doc_id long, offset long, length long, n_tokens long, token_start long")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked_crc(head)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(record: bytes) -> bytes:
    """The payload of a framed record; raises ValueError where a length or checksum is wrong."""
    if len(record) < 16 or struct.unpack_from("<I", record, 8)[0] != masked_crc(record[:8]):
        raise ValueError("record length is damaged")
    size = struct.unpack_from("<Q", record)[0]
    payload = record[12:12 + size]
    if len(record) != size + 16 or struct.unpack_from("<I", record, 12 + size)[0] != masked_crc(payload):
        raise ValueError("record is damaged")
    return payload


class WordEncoder:
    """Packed ids of texts from a tokenizer whose normaliser and word split never look across
    white space, and whose last token of a piece ends in ``</w>``. A batch is cut into words and
    its distinct words are looked up at once; the library encodes each word that is new."""

    def __init__(self, path: str, width: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of words. Letters with ASCII punctuation after them are one or two pieces,
        so many such words can be encoded as one text and told apart by their last tokens."""
        out: list[bytes | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if _PLAIN.fullmatch(w)]
        for at in range(0, len(plain), 1000):
            some = plain[at:at + 1000]
            ids = np.array(self.tokenizer.encode("\n".join([words[i] for i in some]), add_special_tokens=False).ids)
            pieces = np.cumsum([1 if words[i].isalpha() else 2 for i in some])
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != pieces[-1]:  # a letter whose lower case is no letter: one by one below
                continue
            packed, size = ids.astype(self.kind).tobytes(), self.kind.itemsize
            stops = ends[pieces - 1] * size
            for i, a, b in zip(some, [0, *stops[:-1].tolist()], stops.tolist(), strict=True):
                out[i] = packed[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        if rest:
            got = self.tokenizer.encode_batch([words[i] for i in rest], add_special_tokens=False)
            for i, e in zip(rest, got, strict=True):
                out[i] = self.pack(e.ids)
        return out

    def look_up(self, words: list[str]) -> list[bytes]:
        """Packed ids of distinct words. When the younger generation is full it becomes the older
        one, and words that are met again move back."""
        out = list(map(self.words.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        if missing:
            known = self.older.get
            for i in missing:
                out[i] = known(words[i])
            fresh = [i for i in missing if out[i] is None]
            for i, packed in zip(fresh, self.encode_words([words[i] for i in fresh]), strict=True):
                out[i] = packed
            for i in missing:
                self.words[words[i]] = out[i]
            if len(self.words) >= CACHE_WORDS:
                self.older, self.words = self.words, {}
        return out

    def encode(self, texts: pa.Array, end: bytes) -> list[bytes]:
        """Packed ids of each text, with ``end`` after them."""
        cut = pc.ascii_split_whitespace(texts.fill_null(""))
        found = cut.flatten().dictionary_encode()
        packed = self.look_up(found.dictionary.to_pylist())
        # gather the ids by number: a batch's distinct words fit the processor's cache
        size = self.kind.itemsize
        pool = np.frombuffer(b"".join(packed), self.kind)
        sizes = np.fromiter(map(len, packed), np.int32, len(packed)) // size
        begin = np.cumsum(sizes, dtype=np.int32) - sizes
        word = found.indices.to_numpy()
        n = sizes[word]
        ends = np.cumsum(n)
        at = np.repeat(begin[word] - (ends - n), n)
        at += np.arange(len(at), dtype=at.dtype)
        tokens = pool[at].tobytes()
        bounds = np.r_[0, ends][cut.offsets.to_numpy() - cut.offsets[0].as_py()] * size
        return [tokens[a:b] + end for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def word_encoder(path: str, width: int) -> WordEncoder:
    """The encoder of a file, loaded once for each Python worker."""
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = WordEncoder(path, width)
    return _ENCODERS[path, width]


def put_in_place(fs: pafs.FileSystem, made: str, name: str) -> None:
    """Rename a whole file to its name, where an earlier attempt of its task may have left the same
    file. Where the file system does not replace files by renaming, the old one goes first."""
    try:
        fs.move(made, name)
    except OSError:
        if fs.get_file_info(name).type == pafs.FileType.NotFound:
            raise
        fs.delete_file(name)
        fs.move(made, name)


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, vocabulary: int = 49_408,
                  files: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, write the records under ``folder`` in ascending
    order of the id, and return the offset index (staged). ``folder`` is a place that all
    executors share, as a path or URI that pyarrow can open."""
    spark = docs.sparkSession
    if files is None:
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // FILE_DOCS))
    width = 2 if vocabulary <= 1 << 16 else 4
    text = F.col(text_col).cast("string")
    # the row number deals rows that agree in id and text
    keys = F.col("doc_id").asc_nulls_first(), "tie", "row"
    dealt = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("tie"),
        F.monotonically_increasing_id().alias("row"), text.alias("text")).repartitionByRange(files, *keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        name, sink, offset, tokens = f"part-{part:06d}.rec", None, 0, 0
        fs, root = pafs.FileSystem.from_uri(folder)
        made = f"{root}/.{name}-{attempt}"
        encoder = word_encoder(tokenizer_path, width)
        end = encoder.pack([end_id])
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                rows = []
                if sink is None:
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(made)
                for doc_id, ids in zip(b.column("doc_id").to_pylist(), encoder.encode(b.column("text"), end), strict=True):
                    record = frame(struct.pack(META, doc_id or 0, doc_id is not None, width) + ids)
                    sink.write(record)
                    rows.append((part, name, doc_id, offset, len(record), len(ids) // width, tokens))
                    offset, tokens = offset + len(record), tokens + len(ids) // width
                kinds = (pa.int64(), pa.string(), *[pa.int64()] * 5)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["part", "file", "doc_id", "offset", "length", "n_tokens", "token_start"])
        if sink is not None:
            sink.close()
            put_in_place(fs, made, f"{root}/{name}")
    index = stage(dealt.sortWithinPartitions(*keys).select("doc_id", "text").mapInArrow(write, INDEX), "records-index")
    # tokens in the files before: sums within blocks of files, and over the blocks
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("block", F.expr(f"part div {BLOCK_FILES}"))
    blocks = sizes.groupBy("block").agg(F.sum("n").alias("m"))
    blocks = blocks.select("block", (F.sum("m").over(Window.orderBy("block")) - F.col("m")).alias("above"))
    inside = F.sum("n").over(Window.partitionBy("block").orderBy("part")) - F.col("n")
    before = sizes.withColumn("inside", inside).join(blocks, "block").select("part", (F.col("above") + F.col("inside")).alias("before"))
    return index.join(before, "part").withColumn("start", F.col("before") + F.col("token_start")).drop("before", "token_start")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Read the records of index rows, in whatever order they come, and check them. Returns the
    index's id, start and token count, and from the files ``tokens``: the ids as little-endian
    unsigned 32-bit numbers."""
    source = index.select("file", "offset", "length", "doc_id", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        name, file = None, None
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                b = batch.slice(first, 512)
                ids, tokens, counts = [], [], []
                for n, at, size in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                    if n != name:
                        if file is not None:
                            file.close()
                        name, file = n, fs.open_input_file(f"{root}/{n}")
                    payload = unframe(file.read_at(size, at))
                    doc_id, known, width = struct.unpack_from(META, payload)
                    words = np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=struct.calcsize(META))
                    ids.append(doc_id if known else None)
                    tokens.append(words.astype("<u4").tobytes())
                    counts.append(len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), b.column("start"), pa.array(counts, pa.int64()), pa.array(tokens, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "tokens"])
    return source.mapInArrow(read, "doc_id long, start long, n_tokens long, tokens binary")


def records_folder(docs: DataFrame) -> str:
    """A fresh folder for record files next to the shared checkpoints."""
    return shared_path(docs.sparkSession, "records")

"""Token-ID files: every document's ids as one zstandard frame, all frames of a corpus under one shared dictionary.

File format (little endian). A file holds the documents of one range of doc_ids in ascending order:

    header   4s magic b"TOKZ", u16 version, u16 bytes per id (2 or 4), 32s sha256 of the dictionary
    frames   one zstandard frame for each document, made with the shared dictionary
    index    for each document: i64 doc_id, u8 whether it has one, u64 offset of its frame, u32 bytes of its frame, u64 ids before it in the file, u64 ids
    footer   u64 offset of the index, u64 documents, u64 ids, 4s magic

`read_document` needs the footer, one index entry and one frame, so a short document is read without its neighbours. The
dictionary lies beside the files as `dictionary-<sha256>.zdict`; a reader refuses files whose header names another one.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Recent, few, in_arrow, scratch, with_sums_before, write_atomically, written

MAGIC, VERSION = b"TOKZ", 2
HEADER, FOOTER = struct.Struct("<4sHH32s"), struct.Struct("<QQQ4s")
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("size", "<u4"), ("before", "<u8"), ("n", "<u8")])
#: Documents in a range, and bytes after which a range goes on in a further file.
DOCS_A_RANGE, FILE_BYTES = 8_192, 16 << 20
#: The dictionary is trained on at most so many documents, of each at most so many characters; it only affects the files' size.
SAMPLE_DOCS, SAMPLE_CHARS = 2_000, 16_384
#: The largest dictionary, what part of its sample it has in size otherwise, and zstandard's level.
DICTIONARY_BYTES, DICTIONARY_SHARE, LEVEL = 65_536, 8, 3
#: Bytes of pre-tokens and their ids that a worker remembers.
REMEMBERED = 160 << 20


#: While a text is split at spaces, parts that stand for a mark, or a full stop and a line feed, after a word; and what a part begins with that no space goes before.
STOP, COMMA, LINE, BARE = "\x01", "\x02", "\x03", "\x04"
MARKS = {STOP: ".", COMMA: ",", LINE: ".\n"}


class _Parts(Recent):
    """Parts of a text that a space goes before: words are remembered, words with marks are put together from their pre-tokens."""

    def __init__(self, encoder: Encoder, most: int):
        super().__init__(encoder.word, most)
        self.odd, self.cut = encoder.odd, encoder.cut

    def __missing__(self, part: str) -> bytes:
        bare = part[:1] == BARE
        text = part[1:] if bare else part
        if text.isalpha():
            return super().__missing__(part)
        if part in MARKS:
            self[part] = b"".join(map(self.odd.__getitem__, MARKS[part]))
            return self[part]
        if text[-1:] in (".", ",") and text[:-1].isalpha():
            return self[part[:-1]] + self.odd[text[-1]]
        first, *rest = self.cut(text if bare else " " + text)
        word = first[1:] if first[:1] == " " else BARE + first
        return (self[word] if word.lstrip(BARE).isalpha() else self.odd[first]) + b"".join(map(self.odd.__getitem__, rest))


class Encoder:
    """Encodes whole texts with a byte-level BPE of the tokenizers library, each distinct pre-token once.

    The pre-tokenizer of such a vocabulary always cuts before a single space between two characters that are not white
    space. So a text is split there, a part that isn't one word is cut into pre-tokens, and the library's model encodes each
    of these. Texts in which a space stands beside other white space, or with white space other than spaces and line feeds,
    and those that hold the literal of an added token, are encoded whole by the library.
    """

    _other = re.compile("[\x01-\x04\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
    #: After a letter or digit a mark is a pre-token by itself where white space follows, and so is a line feed between it and a letter.
    _stops, _commas, _lines = (re.compile(x).sub for x in (r"\.(?<=[^\W_]\.) ", r",(?<=[^\W_],) ", r"\.(?<=[^\W_]\.)\n(?=[^\W\d_])"))
    #: Fixed value: the pattern of the byte-level pre-tokenizer.
    _pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.type.itemsize == 2 else "I"
        self.tokenize, self.cut = self.tokenizer.model.tokenize, regex.compile(self._pattern).findall
        visible = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = str.maketrans({chr(b): c for c_ in range(0, 0x800) for b, c in zip(chr(c_).encode(), visible(chr(c_))[0][0], strict=True)})
        self.space = " ".translate(self.letters)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = Recent(self.pretoken, remembered // 8)
        self.later = _Parts(self, remembered * 3 // 8)

    def pretoken(self, text: str) -> bytes:
        return array(self.code, [t.id for t in self.tokenize(text.encode().decode("latin-1").translate(self.letters))]).tobytes()

    def word(self, text: str) -> bytes:
        """A word that a space goes before, unless it begins with BARE. ASCII letters stand for themselves in the vocabulary."""
        lead, text = ("", text[1:]) if text[0] == BARE else (self.space, text)
        seen = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.tokenize(lead + seen)]).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if "  " in text or "\n " in text or " \n" in text or text[0] == " " or text[-1] == " " or self._other(text) or any(t in text for t in self.added):
            return self.whole(text)
        first, *rest = self._lines(f" {LINE} {BARE}", self._commas(f" {COMMA} ", self._stops(f" {STOP} ", text))).split(" ")
        return b"".join([*map(self.odd.__getitem__, self.cut(first)), *map(self.later.__getitem__, rest)])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process, so that later tasks find the words of earlier ones."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int) -> bytes:
    """A zstandard dictionary from the serialized ids of a bounded sample: the SAMPLE_DOCS documents of least hash of doc_id.

    Of a text of more than SAMPLE_CHARS characters a window of as many is taken, whose place the hash of doc_id gives. The
    dictionary has a DICTIONARY_SHARE-th of the sample's bytes, at most DICTIONARY_BYTES. Samples from which zstandard can't
    make a dictionary (a few tiny texts) give an empty one: frames are then made without.
    """
    picked = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    window = F.substr("text", (F.pmod(F.xxhash64("doc_id"), room + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    texts = docs.filter("text is not null").join(F.broadcast(picked.distinct()), "doc_id", "left_semi").select(window.alias("text")).limit(SAMPLE_DOCS).toPandas()["text"]
    encode = encoder(vocabulary)
    end = np.array([end_id], encode.type).tobytes()
    samples = sorted(encode(t) + end for t in texts)
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(512, sum(map(len, samples)) // DICTIONARY_SHARE)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def assemble(width: int, digest: bytes, entries: list[tuple], frames: list[bytes], size: int, ids: int) -> bytes:
    """A file of these frames, which have `size` bytes and `ids` ids."""
    head = HEADER.pack(MAGIC, VERSION, width, digest)
    return b"".join([head, *frames, np.array(entries, INDEX).tobytes(), FOOTER.pack(len(head) + size, len(entries), ids, MAGIC)])


MANIFEST = "file string, path string, range long, part int, docs long, ids long, bytes long"


def write_token_files(spark: SparkSession, docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, docs_a_range: int = DOCS_A_RANGE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the documents (doc_id, text) as token files in `folder`; returns the manifest: a row for each file.

    A null text counts as empty, a document then has the end id alone. Rows without a doc_id come first; rows of one doc_id
    lie side by side, in the order of their texts' hashes. Other columns are ignored. Without documents there is a dictionary,
    but no file. Rows are range-partitioned by doc_id, hash and place, so neither a large corpus nor a doc_id that very many
    rows share makes a range large; a file is closed after `file_bytes`. A task that is run again writes the same files.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dictionary = train_dictionary(docs, vocabulary, end_id)
    digest = hashlib.sha256(dictionary).digest()
    write_atomically(folder, f"dictionary-{digest.hex()}.zdict", dictionary)
    order = [F.col("doc_id").asc_nulls_first(), "hash", "place"]
    dealt = docs.withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()}).repartitionByRange(max(1, -(-docs.count() // docs_a_range)), *order)
    head_bytes = HEADER.size
    schema = pa.schema([("file", pa.string()), ("path", pa.string()), ("range", pa.int64()), ("part", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(vocabulary), TaskContext.get().partitionId()
        width, end = encode.type.itemsize, np.array([end_id], encode.type).tobytes()
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary)).compress
        part, entries, frames, size, before = 0, [], [], 0, 0

        def close() -> pa.RecordBatch:
            body = assemble(width, digest, entries, frames, size, before)
            path = write_atomically(folder, name := f"ids-{task:06d}-{part:04d}.tok", body)
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, (name, path, task, part, len(entries), before, len(body)), strict=True))], schema)

        for b in batches:
            for doc, ids in zip(b.column("doc_id").to_pylist(), map(encode, b.column("text").to_pylist()), strict=True):
                ids += end
                frame = compress(ids)
                entries.append((doc or 0, doc is not None, head_bytes + size, len(frame), before, n := len(ids) // width))
                frames.append(frame)
                size, before = size + len(frame), before + n
                if size >= file_bytes:
                    yield close()
                    part, entries, frames, size, before = part + 1, [], [], 0, 0
        if entries:
            yield close()

    return written(spark, in_arrow(dealt.sortWithinPartitions(*order).select("doc_id", "text"), work, MANIFEST), "token-manifest")


def _opened(content: bytes, dictionary: bytes) -> tuple[int, np.ndarray, Callable[[bytes], bytes]]:
    """Bytes of an id, the index, and what decompresses a frame of a file, whose dictionary must be this one."""
    magic, version, width, digest = HEADER.unpack_from(content)
    index_at, docs, _, tail = FOOTER.unpack_from(content, len(content) - FOOTER.size)
    if magic != MAGIC or tail != MAGIC or version != VERSION:
        raise ValueError("not a token file")
    if digest != hashlib.sha256(dictionary).digest():
        raise ValueError(f"the file was made with the dictionary {digest.hex()}")
    return width, np.frombuffer(content, INDEX, docs, index_at), zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress


def parse(content: bytes, dictionary: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """doc_id, ids before it in this file, and ids of each document of a file."""
    width, index, decompress = _opened(content, dictionary)
    for doc, known, offset, size, before, n in index.tolist():
        ids = np.frombuffer(decompress(content[offset : offset + size]), f"<u{width}")
        if len(ids) != n:
            raise ValueError(f"document {doc} has {len(ids)} ids, its index says {n}")
        yield doc if known else None, before, ids


def read_document(content: bytes, dictionary: bytes, doc_id: int) -> np.ndarray | None:
    """Ids of one document by a search of the offset index; of repeated doc_ids the first; None if the file hasn't it."""
    width, index, decompress = _opened(content, dictionary)
    ids = index["doc_id"][int((index["known"] == 0).sum()) :]
    at = len(index) - len(ids) + int(np.searchsorted(ids, doc_id))
    if at == len(index) or index["doc_id"][at] != doc_id:
        return None
    offset, size = int(index["offset"][at]), int(index["size"][at])
    return np.frombuffer(decompress(content[offset : offset + size]), f"<u{width}")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, file (and ids) of every document, from the files that the manifest names.

    `start` counts the ids of all documents before it: those of earlier ranges, of earlier files of its range, and those
    before it in its own file.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, file string" + ", ids array<long>" * with_ids
    if manifest.isEmpty():
        return spark.createDataFrame([], schema)
    ranges = with_sums_before(manifest.groupBy("range").agg(F.sum("ids").alias("ids"), F.array_sort(F.collect_list(F.struct("part", "file", "ids"))).alias("files")), "range", "ids", "before")
    inside = F.aggregate(F.slice("files", 1, F.col("at")), F.lit(0).cast("long"), lambda a, f: a + f["ids"])
    base = ranges.select("before", "files", F.posexplode("files").alias("at", "f")).select("f.file", (F.col("before") + inside).alias("base"))
    dictionaries = [bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.zdict").load(folder).select("content").collect()]
    dictionary = dictionaries[0] if dictionaries else b""  # an empty file isn't listed
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.list_(pa.int64())] if with_ids else [])]
    arrow = pa.schema(list(zip((c.split()[0] for c in schema.split(", ")), kinds, strict=True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                rows, held = [], 0
                for doc, before, ids in parse(content.as_buffer().to_pybytes(), dictionary):
                    rows.append((doc, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), path.rsplit("/", 1)[1], *([ids.astype("i8")] if with_ids else [])))
                    held += len(ids) if with_ids else 1
                    if held >= 100_000:
                        yield _batch(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select("path", "content")
    return in_arrow(files, work, schema).join(few(base), "file").withColumn("start", F.col("start") + F.col("base")).drop("base")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written, read back and digested."""
    import public_tokenizers

    folder = scratch(spark, "token-files")
    manifest = write_token_files(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, folder, manifest).select("doc_id", "start", "n_tokens", "ids_crc32", "file")

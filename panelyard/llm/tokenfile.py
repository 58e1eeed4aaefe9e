"""Token-ID files: one zstandard frame per document, a document index and a trailing seek table.

A file is (all integers little-endian)
- a frame with a content checksum for each document, in ascending doc_id order: its ids as 16- or 32-bit integers;
- a skippable frame (magic 0x184D2A50): width of an id in bytes, then a frame with the doc_ids as 64-bit integers and
  a byte each that is 1 for a null id;
- a skippable frame (magic 0x184D2A5E), the seek table of the zstandard seekable format: compressed size, size and
  checksum (low 32 bits of XXH64 of the content) of each document's frame, then the number of
  frames, a descriptor byte with the checksum bit and the magic 0x8F92EAB1.
A plain zstandard reader reads such a file as one stream; `TokenFile` reads only the frames that are asked for.

Ids and text lengths alone are sorted first; where FILE_CHARS have run up, a file ends, so the driver holds one id per file.
Tasks then encode and compress where the texts are and look the file's number up, and only compressed frames are
shuffled, neighbouring files to one of at most TASKS tasks. A file is named for its attempt, and the manifest of the tasks that ended names
the files that count, so a lost executor leaves at most files that nobody reads.

Defined cases: null texts are encoded as empty (one end id). Null doc_ids come first. Repeated rows stay; those of an id (or of no
id) that would fill several files are dealt over them by their checksums, so ids still ascend through all files. Strings of
added tokens (`<|endoftext|>`) are encoded as the library does by default, as their token. An empty table gives no
file. Extra columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_dir, table, written

END_ID = 2
SKIP_INDEX, SKIP_SEEK, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: Bytes of text per file, about; most tasks that write or read files, of which each has a run of neighbouring ones.
FILE_CHARS, TASKS = 1 << 26, 20_000
#: Chunks that a worker remembers, of so many characters at most (about 200 MB at worst), in two halves; the older half goes when the newer is full.
CACHE, REMEMBERED = 600_000, 48
_SPACE = re.compile(r"\s")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: A chunk of a line end or space, letters (of blocks that hold only letters) and ASCII signs other than apostrophes: the pre-tokenizer cuts it before the signs.
_SIMPLE = re.compile(r"(\n?)( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: printable ones stay, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Chunks(dict):
    """Ids of chunks, made when first asked for; chunks that are not asked for while CACHE // 2 others come are dropped."""

    def __init__(self, make: Callable[[str], bytes | None]):
        super().__init__()
        self.make, self.old = make, {}
        self.parts: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes | None:
        ids = self.old[chunk] if chunk in self.old else self.make(chunk)
        if len(chunk) <= REMEMBERED:
            self[chunk] = ids
        return ids

    def part(self, text: str, make: Callable[[str], bytes]) -> bytes:
        """Ids of a line end or of signs that follow a word."""
        ids = self.parts.get(text)
        if ids is None:
            ids = make(text)
            if len(self.parts) > CACHE // 2:
                self.parts.clear()
            if len(text) <= REMEMBERED:
                self.parts[text] = ids
        return ids

    def age(self) -> None:
        if len(self) > CACHE // 2:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Ids of whole texts by the tokenizers library. A text whose white space is single spaces and line ends falls
    into chunks that the byte-level pre-tokenizer never joins; a worker remembers chunks from one task to the next."""

    _made: dict[tuple[str, int], Encoder] = {}

    @classmethod
    def of(cls, path: str, end_id: int = END_ID) -> Encoder:
        """This worker's encoder."""
        if (path, end_id) not in cls._made:
            cls._made[path, end_id] = cls(path, end_id)
        return cls._made[path, end_id]

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: Texts that hold one of these strings are encoded as a whole.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if not isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        self.width = 2 if max(self.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        self.type = "H" if self.width == 2 else "I"
        self.end = array(self.type, [end_id]).tobytes()
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        self.known = Chunks(self.ids_of)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array(self.type, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """Ids of one pre-token; the library's model alone, without its pre-tokenizer."""
        if word.isascii() and word[1:].isalpha():  # letters are written as themselves, and a space before them as its own sign
            shown = self.letters[32] + word[1:] if word[0] == " " else word
        else:
            shown = word.encode().decode("latin-1").translate(self.letters)
        return array(self.type, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def ids_of(self, chunk: str) -> bytes | None:
        """A chunk stands for a space and itself; one that starts with a line end, or with the mark of a text's first chunk (a space, left off), has no
        space before it. None: the chunk's white space may join its neighbour's, so its text is encoded as a whole."""
        text = chunk[1:] if chunk[:1] == " " else chunk if chunk[:1] == "\n" else " " + chunk
        if m := _SIMPLE.fullmatch(text):
            line, word, signs = m.groups()
            if not line and not signs:
                return self._word(word)
            ids = self.known[word[1:] if word[0] == " " else " " + word]
            if line:
                ids = self.known.part(line, self._word) + ids
            return ids + self.known.part(signs, self._word) if signs else ids
        if text in ("", " ", "\n") or _SPACE.search(text[1:] if text[0] in " \n" else text):
            return None
        return self._whole([text])[0]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids and the end id, as bytes."""
        self.known.age()
        get, out, whole = self.known.__getitem__, [], []
        for i, t in enumerate(texts):
            if t and any(map(t.__contains__, self.added)):
                out.append(b"")
                whole.append(i)
                continue
            x = (" " + (t or "")).replace("\n", " \n").split(" ")[1:]
            x[0] = " " + x[0]
            try:
                out.append(b"".join(map(get, x)) + self.end)
            except TypeError:  # a None
                out.append(b"")
                whole.append(i)
        for i, ids in zip(whole, self._whole([texts[i] or "" for i in whole])):
            out[i] = ids + self.end
        return out


_FRAMES = "number int, doc_id bigint, n_tokens bigint, frame binary, size bigint, checksum bigint"
#: Stands for a null id among the ends of files, below every other id.
NO_ID = -(2**63)


def file_ends(docs: DataFrame, file_chars: int = FILE_CHARS) -> list[int]:
    """Ascending doc_ids (NO_ID for null) at which files end: wherever file_chars bytes of text have run up in a range of sorted ids."""
    sizes = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("i"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"), F.monotonically_increasing_id().alias("tie"))
    ranged = sizes.repartitionByRange("i", "tie").sortWithinPartitions("i").select("i", "n")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, last = 0, None
        for b in batches:
            upto = have + np.cumsum(b.column(1).to_numpy())
            if len(upto):
                cut = np.flatnonzero(np.diff(upto // file_chars, prepend=have // file_chars))
                have, last = int(upto[-1]), b.column(0)[-1]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cut))], ["i"])
        if last is not None and have % file_chars > file_chars // 4:  # a small rest goes on in the next range
            yield pa.RecordBatch.from_arrays([pa.array([last.as_py()], pa.int64())], ["i"])

    return sorted(r[0] for r in ranged.mapInArrow(ends, "i bigint").collect())  # an id per file


def file_numbers(ids: pa.Array, checksums: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The file of each document: that of the first end which is not below its id; an id that ends r files is dealt over all r by the checksums."""
    known = np.asarray(pc.fill_null(ids, NO_ID))
    low, high = np.searchsorted(ends, known, "left"), np.searchsorted(ends, known, "right")
    share = checksums / 2.0**32
    null = known == NO_ID  # nulls come before an id of that value
    share[null] = (share[null] + np.where(np.asarray(ids.is_null())[null], 0, 1)) / 2
    return (low + np.floor(share * (high - low))).astype(np.int32)


def frames(docs: DataFrame, ends: list[int], tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, text) -> (number of the file, doc_id, n_tokens, frame, size, checksum)."""
    path = tokenizer or default_tokenizer()
    cuts = np.array(ends, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        encoder = Encoder.of(path, end_id)
        zstd = zstandard.ZstdCompressor(level=3, write_checksum=True)
        for b in batches:
            for first in range(0, b.num_rows, 512):
                ids = b.column(0).slice(first, 512)
                raw = encoder.encode(b.column(1).slice(first, 512).to_pylist())
                sums = np.array([xxhash.xxh64_intdigest(x) & 0xFFFFFFFF for x in raw], np.int64)
                cols = [
                    pa.array(file_numbers(ids, sums, cuts)), ids, pa.array([len(x) // encoder.width for x in raw], pa.int64()),
                    pa.array([zstd.compress(x) for x in raw], pa.binary()), pa.array([len(x) for x in raw], pa.int64()), pa.array(sums),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["number", "doc_id", "n_tokens", "frame", "size", "checksum"])

    return docs.mapInArrow(run, _FRAMES)


class FileWriter:
    """Writes one file, frame by frame."""

    def __init__(self, fs: pafs.FileSystem, path: str, width: int):
        self.path, self.width = path, width
        self.out = fs.open_output_stream(path, compression=None)
        self.table: list[bytes] = []
        self.ids: list[int | None] = []
        self.tokens = self.bytes = 0

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes, size: int, checksum: int) -> None:
        self.out.write(frame)
        self.table.append(struct.pack("<III", len(frame), size, checksum))
        self.ids.append(doc_id)
        self.tokens += n_tokens
        self.bytes += len(frame)

    def close(self) -> dict:
        import zstandard

        ids = np.array([x or 0 for x in self.ids], "<i8").tobytes() + bytes(x is None for x in self.ids)
        index = struct.pack("<B", self.width) + zstandard.ZstdCompressor(write_checksum=True).compress(ids)
        body = b"".join(self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEK_MAGIC)
        tail = struct.pack("<II", SKIP_INDEX, len(index)) + index + struct.pack("<II", SKIP_SEEK, len(body)) + body
        self.out.write(tail)
        self.out.close()
        return {"path": self.path, "n_docs": len(self.ids), "n_tokens": self.tokens, "bytes": self.bytes + len(tail)}


class TokenFile:
    """Random access to a file's documents: reads the tail, then only the frames asked for."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        import zstandard

        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, bits, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or bits != 0x80:
            raise ValueError(f"{path}: no seek table")
        table_at = size - 9 - 12 * n
        self.table = np.frombuffer(self._at(table_at, 12 * n), "<u4").reshape(n, 3)
        self.begin = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        index_at = int(self.begin[-1])
        skip, length = struct.unpack("<II", self._at(index_at, 8))
        if skip != SKIP_INDEX or index_at + 16 + length != table_at:
            raise ValueError(f"{path}: no document index")
        index = self._at(index_at + 8, length)
        self.width = index[0]
        self._zstd = zstandard.ZstdDecompressor()
        ids = self._zstd.decompress(index[1:])
        self.doc_ids = [None if null else int(x) for x, null in zip(np.frombuffer(ids, "<i8", n), ids[8 * n :])]

    def _at(self, begin: int, n: int) -> bytes:
        self.file.seek(begin)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.table)

    def read(self, i: int) -> np.ndarray:
        """Ids of document i; raises if a checksum fails."""
        import xxhash

        raw = self._zstd.decompress(self._at(int(self.begin[i]), int(self.table[i, 0])), max_output_size=int(self.table[i, 1]))
        if len(raw) != self.table[i, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"document {i}: checksum")
        return np.frombuffer(raw, f"<u{self.width}")


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, file_chars: int = FILE_CHARS) -> DataFrame:
    """Writes (doc_id, text) rows to files in folder (a URI that all executors share); the manifest: number, path, n_docs, n_tokens, bytes.

    Files follow doc_id: number k holds smaller ids than number k + 1. file_chars: text per file, about.
    """
    from tokenizers import Tokenizer

    path = tokenizer or default_tokenizer()
    width = 2 if max(Tokenizer.from_file(path).get_vocab_size() - 1, end_id) < 1 << 16 else 4
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ends = file_ends(docs, file_chars)
    base_fs, base = _place(folder)
    base_fs.create_dir(base, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _place(folder)
        out, number = None, None

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"number": number} | out.close()], pa.schema([("number", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("bytes", pa.int64())]))

        for b in batches:
            for k, doc_id, n, frame, size, checksum in zip(*(b.column(c).to_pylist() for c in ("number", "doc_id", "n_tokens", "frame", "size", "checksum"))):
                if k != number:
                    if out:
                        yield closed()
                    number, out = k, FileWriter(fs, f"{root}/part-{k:06d}-{uuid.uuid4().hex}.zst", width)
                out.add(doc_id, n, frame, size, checksum)
        if out:
            yield closed()

    # neighbouring files share a task where there are many
    tasks = min(TASKS, len(ends) + 1)
    dealt = frames(docs, ends, path, end_id).repartitionById(tasks, F.expr(f"CAST(CAST(number AS BIGINT) * {tasks} div {len(ends) + 1} AS INT)"))
    ready = dealt.sortWithinPartitions("number", F.col("doc_id").asc_nulls_first(), "checksum")
    return written(ready.mapInArrow(write, "number bigint, path string, n_docs bigint, n_tokens bigint, bytes bigint"), "manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document, read from the files of a manifest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _place(folder)
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                file = TokenFile(fs, path)
                for first in range(0, len(file), 4096):
                    some = range(first, min(first + 4096, len(file)))
                    n, crc = [], []
                    for i in some:
                        ids = file.read(i)
                        n.append(len(ids))
                        crc.append(zlib.crc32(ids.astype("<u4")))
                    starts = start + np.cumsum([0, *n])
                    start = int(starts[-1])
                    cols = [pa.array([file.doc_ids[i] for i in some], pa.int64()), pa.array(starts[:-1]), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a row per file, so one window over all of them is small
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")
    last = manifest.agg(F.max("number")).first()[0] or 0
    tasks = min(TASKS, last + 1)
    spread = manifest.select("path", "number", before).repartitionById(tasks, F.expr(f"CAST(number * {tasks} div {last + 1} AS INT)")).sortWithinPartitions("number").select("path", "start")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    return read_tokens(write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), folder), folder)

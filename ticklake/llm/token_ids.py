"""Token ids as binary files: one concatenated id array with Elias-Fano
encoded document boundaries.

Documents lie in ascending id order over the files.  A file holds a header, the
end of each of its documents in its id array and their ids (both sequences
never fall, so both are Elias-Fano encoded: about 2 + log2(u / n) bits a value
instead of 64), and then the ids, 2 bytes each if the vocabulary allows it,
else 4.  Select structures (the place of every SAMPLE-th one in the upper
bits) give the offset of any document without decoding the others.

    header   big-endian: magic, ordinal (part * 2**32 + number in the part),
             documents, of these with null ids, token ids, smallest id, width
    ends     Elias-Fano: ids up to and with each document
    doc ids  Elias-Fano: id less the smallest, of documents whose id isn't null
    ids      little-endian, `width` bytes each
    newline  the end of the record that the file is to Spark's writer

Parts are ranges of document ids of about equal numbers of rows; Spark's text
writer writes each file (bytes pass through it as they are), so a store that
only Spark reaches will do, and a lost task leaves no half-written file.  Files
are bounded; a small index gives the ids before each file.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticklake.llm.common import broadcast_if_small

MAGIC = b"TLTOKENS"
HEADER = struct.Struct(">8sQQQQqQ")
#: Ids and documents in a file, at most (a longer document has a file of its own).
FILE_IDS, FILE_DOCS = 1 << 22, 1 << 18
#: Bytes that remembered chunks take in a worker, about.
REMEMBERED_BYTES = 60 << 20
#: Characters whose chunks are looked up together.
WINDOW = 1 << 23
#: Files (under 100 bytes each in the index) whose starts may be broadcast.
BROADCAST_FILES = 500_000


class EliasFano:
    """A sequence of non-negative integers that never falls: of each value the
    lower bits as they are, of the upper bits the gaps in unary."""

    SAMPLE = 256
    _HEAD = struct.Struct("<IBII")

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.bits, self.low, self.high = n, bits, low, high
        self.samples = np.empty(0, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.zeros((n, bits), np.uint8)
        for j in range(bits):
            low[:, j] = (values >> np.uint64(j)) & np.uint64(1)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((top >> bits) + n + 1, np.uint8)  # under 3 * n + 2 bits
        high[ones] = 1
        out = cls(n, bits, np.packbits(low, bitorder="little"), np.packbits(high, bitorder="little"))
        out.samples = ones[:: cls.SAMPLE].astype("<u4")
        return out

    def to_bytes(self) -> bytes:
        head = self._HEAD.pack(self.n, self.bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        """The sequence that begins at `at`, and where it ends."""
        n, bits, n_low, n_high = cls._HEAD.unpack_from(data, at)
        at += cls._HEAD.size
        out = cls(n, bits, np.frombuffer(data, np.uint8, n_low, at), np.frombuffer(data, np.uint8, n_high, at + n_low))
        at += n_low + n_high
        out.samples = np.frombuffer(data, "<u4", -(-n // cls.SAMPLE), at)
        return out, at + 4 * len(out.samples)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Value i: its one is looked for from the sampled one before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        sample = i // self.SAMPLE
        begin = int(self.samples[sample])
        end = int(self.samples[sample + 1]) if sample + 1 < len(self.samples) else 8 * len(self.high)
        ones = np.unpackbits(self.high[begin >> 3 : (end >> 3) + 1], bitorder="little")[begin & 7 :]
        upper = begin + int(np.flatnonzero(ones)[i % self.SAMPLE]) - i
        first = i * self.bits
        window = int.from_bytes(self.low[first >> 3 : (first + self.bits + 7) >> 3].tobytes(), "little")
        return upper << self.bits | (window >> (first & 7)) & ((1 << self.bits) - 1)

    def below(self, value: int) -> int:
        """How many values are smaller than `value`."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self.select(middle) < value else (low, middle)
        return low

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)
        low = np.unpackbits(self.low, count=self.n * self.bits, bitorder="little").reshape(self.n, self.bits)
        for j in range(self.bits):
            out |= low[:, j].astype(np.uint64) << np.uint64(j)
        return out


class TokenFile:
    """One file: documents by number or by id."""

    def __init__(self, data: bytes):
        magic, self.ordinal, self.n_docs, self.n_null, self.n_ids, self.base, width = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError(f"no token id file: {magic!r}")
        view = memoryview(data)
        self.ends, at = EliasFano.read(view, HEADER.size)
        self.doc_ids, at = EliasFano.read(view, at)
        self.ids = np.frombuffer(view, f"<u{width}", self.n_ids, at)
        if len(data) != at + self.n_ids * width + 1:
            raise ValueError("a token id file doesn't end where its header says")

    def document(self, i: int) -> np.ndarray:
        """The ids of document i of the file: two selects and a slice."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of the first document with this id, None if there is none."""
        i = self.doc_ids.below(doc_id - self.base) if doc_id > self.base else 0
        if i == len(self.doc_ids) or self.doc_ids.select(i) + self.base != doc_id:
            return None
        return self.document(self.n_null + i)

    def document_ids(self) -> list[int | None]:
        return [None] * self.n_null + [int(x) + self.base for x in self.doc_ids.values()]


def packed(ordinal: int, doc_ids: list[int | None], documents: list[bytes], width: int) -> bytes:
    """A file of documents (ids of `width` bytes each) in ascending id order, nulls first."""
    known = [x for x in doc_ids if x is not None]
    base = known[0] if known else 0
    ends = EliasFano.of(np.cumsum([len(x) // width for x in documents]))
    ids = EliasFano.of(np.array([x - base for x in known], np.uint64))
    n = sum(map(len, documents)) // width
    header = HEADER.pack(MAGIC, ordinal, len(documents), len(documents) - len(known), n, base, width)
    return b"".join([header, ends.to_bytes(), ids.to_bytes(), *documents])


def _windows(text: str, size: int) -> Iterator[str]:
    """The text in parts of about `size` characters, cut behind blanks."""
    at = 0
    while len(text) - at > size and (cut := text.find(" ", at + size)) >= 0:
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


class ChunkEncoder:
    """Ids of texts by the tokenizers library, each different chunk between
    blanks once.  For a tokenizer whose pieces never hold white space, a text's
    ids are those of its chunks one after the other; `safe` says whether the
    tokenizer is known to be such, else whole texts are encoded.  A task
    remembers the ids of chunks that occur several times in a window; when they
    take REMEMBERED_BYTES it starts anew.

    Chunks are made alike where the tokenizer would make them alike anyway: a
    full stop or the like behind a letter and before a blank is cut off, and
    A to Z are lowered, if `cuts_marks` and `lowers` hold (`plain` says of which
    texts: those without added tokens and without marks to compose with).
    """

    def __init__(self, tokenizer_file: str, width: int):
        self.tokenizer, self.type = Tokenizer.from_str(tokenizer_file), np.dtype(f"<u{width}")
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.safe = not _whole_differs(self.tokenizer, lambda text: text.replace("\n", " ").split(" "))
        self.cuts_marks = not _whole_differs(self.tokenizer, lambda text: [re.sub(_MARK, r"\1 \2 ", text)])
        self.lowers = not _whole_differs(self.tokenizer, lambda text: [text if "<|" in text else text.translate(_LOWER)])
        # what texts must hold for an added token to be in them, whatever the case of its letters
        starts = [re.match(r"[^A-Za-z]*", x).group() for x in added]
        self.lowers &= all(starts)
        self.cuts_marks &= not any(c in x for x in added for c in ".,;:!?")
        self.not_plain = "|".join([*map(re.escape, starts), "[A-Z][\u0300-\u036f]"])
        self._start()

    def _start(self) -> None:
        self.places: dict[str, int] = {}
        self.ends, self.ids, self.held = np.zeros(1, np.int64), np.empty(0, self.type), 0

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, WINDOW characters or a longer text at a time."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= WINDOW):
                size += len(texts[end])
                end += 1
            if not self.safe:
                yield from (x.tobytes() for x in self._encoded(texts[at:end]))
            elif size > WINDOW:
                yield b"".join(x for part in _windows(texts[at], WINDOW) for x in self._by_chunk([part]))
            else:
                yield from self._by_chunk(texts[at:end])
            at = end

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.type) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_chunk(self, texts: list[str]) -> list[bytes]:
        data = pc.replace_substring(pa.array(texts, pa.string()), "\n", " ")
        if self.cuts_marks:
            data = pc.replace_substring_regex(data, _MARK, r"\1 \2 ")
        if self.lowers and not pc.any(pc.match_substring_regex(data, self.not_plain)).as_py():
            data = pc.ascii_lower(data)
        cut = pc.split_pattern(data, " ")
        coded = cut.flatten().dictionary_encode()
        indices = coded.indices.to_numpy()
        ids_of, ends_of, places = self._places(coded.dictionary.to_pylist(), np.bincount(indices, minlength=len(coded.dictionary)))
        places = places[indices]
        first, last = ends_of[places], ends_of[places + 1]
        ends = np.r_[0, np.cumsum(last - first)]
        ids = ids_of[np.arange(ends[-1]) + np.repeat(first - ends[:-1], last - first)]
        bounds = ends[cut.offsets.to_numpy()]
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]

    def _places(self, chunks: list[str], times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ends, places) of different chunks that occur so many times:
        place i has ids[ends[i] : ends[i + 1]].  Those that occur once, most of
        the different ones, aren't remembered."""
        if self.held > REMEMBERED_BYTES:
            self._start()
        known = self.places
        places = np.fromiter((known.get(chunk, -1) for chunk in chunks), np.int64, len(chunks))
        new = np.flatnonzero(places < 0)
        if not len(new):
            return self.ids, self.ends, places
        new = new[np.argsort(times[new] < 2, kind="stable")]  # what is remembered first
        places[new] = np.arange(len(known), len(known) + len(new))
        ids, sizes = [self.ids], []
        for at in range(0, len(new), 10_000):
            part = [chunks[i] for i in new[at : at + 10_000].tolist()]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), self.type, sizes[-1].sum()))
        all_ids = np.concatenate(ids)
        ends = np.r_[self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))]
        kept = [chunks[i] for i in new[times[new] > 1].tolist()]
        known.update(zip(kept, range(len(known), len(known) + len(kept))))
        self.ends = ends[: len(known) + 1].copy()
        self.ids = all_ids[: self.ends[-1]].copy()
        self.held += sum(map(len, kept)) + 190 * len(kept)
        return all_ids, ends, places


_MARK = r"([A-Za-z])([.,;:!?]) "
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_PROBES = [
    "a b", "a  b", " a", "a ", "a\nb", "a \n b", "1 2", ". .", "a .", "\u00e9 e", " \u0301a", "a \u0301", "don 't", "x\t y",
    "Yes. No, we; so: it! is? X", "a., b.. c .d 'a, b' 1. 2, \u00e9. e", "It'S I'LL \u00c9A A\u0301 ABC xYz 1A-B", "<|startoftext|> a <|x|> B",
]


def _whole_differs(tokenizer: Tokenizer, parts) -> bool:
    """Whether some probe has other ids than its `parts` one after the other, or
    an added token holds or takes in white space."""
    added = tokenizer.get_added_tokens_decoder().values()
    if any(token.lstrip or token.rstrip or any(c.isspace() for c in token.content) for token in added):
        return True
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    return any(ids(p) != [i for part in parts(p) for i in ids(part)] for p in _PROBES)


@lru_cache(maxsize=1)
def _encoder(tokenizer_file: str, width: int) -> ChunkEncoder:
    """One for each worker process; it lives on over tasks.  Spark keeps the
    cores busy: the library's own threads would cost time and memory."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ChunkEncoder(tokenizer_file, width)


def _unsigned(hashes: np.ndarray) -> np.ndarray:
    """31 bits of a hash, as they order its rows."""
    return (hashes.astype(np.int64) >> 32) & 0x7FFFFFFF


def write_token_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> None:
    """Encode every whole text (null: empty) without special tokens, append
    `end_id`, and write the files under path/ids and their index (ordinal,
    n_docs, n_ids, start) under path/index.

    Documents lie in ascending id order, null ids first.  Rows that repeat an
    id each are a document, in the order of a hash of their texts; if an id has
    more rows than a part, in that of a hash of their places in the input.  Ids
    take 2 bytes if the vocabulary has at most 65,536 and `end_id` fits, else
    4.  An empty table gives no files.  Other columns are ignored.  `parts`
    (default: spark.sql.shuffle.partitions) is the number of ranges, as tasks.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_file = f.read()
    width = 2 if max(Tokenizer.from_str(tokenizer_file).get_vocab_size() - 1, end_id) < 1 << 16 else 4
    held = spark.sparkContext.broadcast(tokenizer_file)  # the vocabulary: a few MB
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(f"`{id_col}`").cast("long")
    shares = [i / parts for i in range(1, parts)]
    quantiles = F.percentile_approx(key, shares, max(10_000, 20 * parts)) if shares else F.lit(None)
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("known"), quantiles.alias("cuts")).first()
    cuts = np.array(row["cuts"] or [], np.int64)  # parts - 1 of them
    nulls = row["n"] - row["known"]
    null_parts = -(-nulls * parts // row["n"]) if nulls else 0
    end = np.array([end_id], f"<u{width}").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value, width)
        for batch in batches:
            texts = [x or "" for x in batch["text"].to_pylist()]
            ids, null = batch["id"], np.array(batch["id"].is_null())
            known = ids.fill_null(0).to_numpy()
            left, right = np.searchsorted(cuts, known, "left"), np.searchsorted(cuts, known, "right")
            hashes = np.where(null | (right > left), _unsigned(batch["place"].to_numpy()), _unsigned(batch["hash"].to_numpy()))
            # an id on several cuts has the parts between them, by its hashes
            part = null_parts + left + (hashes * (right - left + 1) >> 31)
            part = np.where(null, hashes * null_parts >> 31, part).astype(np.int32)
            done = [x + end for x in encoder.encode(texts)]
            columns = [pa.array(part), ids, pa.array(hashes), pa.array(done, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "id", "hash", "ids"])
            pa.default_memory_pool().release_unused()  # else it keeps what the largest window took

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids: list = []
        documents: list = []
        size, part, number = 0, None, 0

        def file() -> pa.RecordBatch:
            data = packed((part << 32) + number, doc_ids, documents, width)
            return pa.RecordBatch.from_pydict({"data": [data]}, pa.schema([("data", pa.binary())]))

        for batch in batches:
            for p, key, ids in zip(*(batch[c].to_pylist() for c in ("part", "id", "ids"))):
                if documents and (p != part or size + len(ids) > FILE_IDS * width or len(documents) == FILE_DOCS):
                    yield file()
                    number = number + 1 if p == part else 0
                    doc_ids, documents, size = [], [], 0
                part = p
                doc_ids.append(key)
                documents.append(ids)
                size += len(ids)
        if documents:
            yield file()

    text = F.col(f"`{text_col}`")
    rows = docs.select(key.alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"), F.xxhash64(F.monotonically_increasing_id()).alias("place"))
    ids = rows.mapInArrow(encode, "part int, id long, hash long, ids binary")
    dealt = ids.repartitionById(parts + null_parts, F.col("part")).sortWithinPartitions("part", F.col("id").asc_nulls_first(), "hash")
    files = dealt.mapInArrow(pack, "data binary").select(F.col("data").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).text(f"{path}/ids")
    _index(spark, path).write.parquet(f"{path}/index")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids").where("length > 0")


def _index(spark: SparkSession, path: str) -> DataFrame:
    """One row (ordinal, n_docs, n_ids, start) per file, from the headers."""
    number = lambda at: F.conv(F.hex(F.substring("content", at, 8)), 16, 10).cast("long")
    files = _files(spark, path).select(number(9).alias("ordinal"), number(17).alias("n_docs"), number(33).alias("n_ids"))
    files = files.withColumn("part", F.shiftright("ordinal", 32))
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))  # a row for each part: as many as tasks
    parts = parts.select("part", before(Window.orderBy("part")).alias("first"))
    files = files.withColumn("inside", before(Window.partitionBy("part").orderBy("ordinal"))).join(parts, "part")
    return files.select("ordinal", "n_docs", "n_ids", (F.col("first") + F.col("inside")).alias("start"))


def read_token_ids(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """The documents of the files under `path`: doc_id, start (ids of all
    documents before), n_tokens, ids_crc32 (of the ids as unsigned 32-bit
    little-endian numbers) and, if asked for, token_ids (array<long>)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["content"]:
                file = TokenFile(data.as_py())
                ends = file.ends.values().astype(np.int64)
                starts = np.r_[0, ends[:-1]]
                doc_ids = file.document_ids()
                for at in range(0, file.n_docs, 1000):
                    cut = slice(at, at + 1000)
                    spans = list(zip(starts[cut], ends[cut]))
                    columns = {
                        "doc_id": pa.array(doc_ids[cut], pa.int64()),
                        "ordinal": pa.array([file.ordinal] * len(spans), pa.int64()),
                        "inside": pa.array(starts[cut]),
                        "n_tokens": pa.array((ends - starts)[cut]),
                        "ids_crc32": pa.array([zlib.crc32(file.ids[a:b].astype("<u4").tobytes()) for a, b in spans], pa.int64()),
                    }
                    if ids:
                        columns["token_ids"] = pa.array([file.ids[a:b].astype(np.int64) for a, b in spans], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, ordinal long, inside long, n_tokens long, ids_crc32 long" + ", token_ids array<long>" * ids
    rows = _files(spark, path).select("content").mapInArrow(parse, schema)
    index = spark.read.schema("ordinal long, n_docs long, n_ids long, start long").parquet(f"{path}/index").select("ordinal", "start")
    out = rows.join(broadcast_if_small(index, BROADCAST_FILES), "ordinal")
    return out.select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["token_ids"] * ids)


__all__ = ["ChunkEncoder", "EliasFano", "TokenFile", "packed", "read_token_ids", "write_token_ids"]

"""Token ids in binary shards with a shared zstandard dictionary.

A shard holds documents in ascending order of id. Each document's ids, little-endian unsigned 16-bit
numbers (32-bit where the vocabulary needs them), are one zstandard frame of their own, made with a
dictionary that all shards share and that is trained on serialized ids; so a short document compresses
well and can be read alone, by one range read of its frame.

Layout of a shard: the magic ``PLTOKEN1``, the header length (unsigned 32-bit), a JSON header (dictionary
hash, dictionary length, id width), the dictionary, the frames, the index, the index length in
documents (unsigned 64-bit) and the magic again. The index has an array of ids (signed 64-bit), one of
null flags (8-bit), one of frame offsets (unsigned 64-bit, one more than documents) and one of token
counts (unsigned 32-bit).

A task writes its shard under a name of its own and hands its name on only when it is whole. Shards of
attempts that were lost are named nowhere and never read.

Defined cases: a null or empty text has the end id alone; rows with a null id come first; rows with equal
ids stand side by side, by length, hash and bytes of the frame (in one shard or in neighbouring ones); ids
must be numbers or text of numbers: others end the job with Spark's cast error; an empty table gives no shard; columns other than id and text are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_of_words, materialize, portions, scratch_dir

MAGIC = b"PLTOKEN1"
#: Documents whose ids train the dictionary, bytes of it, words that a Python worker remembers.
SAMPLE_DOCUMENTS, DICTIONARY_BYTES, CACHE_WORDS = 1_000, 65_536, 900_000
#: Bytes of a shard's frames, below which there are two shards for each core; a frame's cost in the index.
SHARD_BYTES, LEAST_BYTES, FRAME_COST = 64_000_000, 1_000_000, 21
#: White space, or near it, that only some libraries split at.
_ODD_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\r\x0b\x0c"] + ["\u180e", "\u200b", "\u2060", "\ufeff"]
_ODD_ASCII = [c for c in _ODD_SPACES if c.isascii()]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of whole texts by the ``tokenizers`` library, which is asked once for each distinct word.

    A tokenizer whose normalizer turns white space into spaces and whose pre-tokenizer drops it never
    joins what white space parts, so a text's ids are its words' ids in a row. Words of Latin letters
    alone, which normalizing only makes lower case and which are one pre-token, go to the library's
    model directly. Other tokenizers, and texts with white space that Python and the library may see
    differently, are encoded in one go. With ``added_tokens`` a text that holds the content of an added
    token, such as a mark for the end of a text, gets that token's id there, as the library does unless
    told otherwise; without it the content is plain text.
    """

    def __init__(self, path: str, added_tokens: bool = False, width: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.whole = Tokenizer.from_file(path) if added_tokens else self.tokenizer
        with open(path, encoding="utf-8") as f:
            raw = json.load(f)
        parts = (raw.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = [p for p in parts if p["type"] == "Split"]
        self.by_word = bool(split) and split[0]["behavior"] == "Removed" and split[0]["invert"] and r"\s" in split[0]["pattern"].get("Regex", "") and '"\\\\s+"' in json.dumps(raw.get("normalizer"))
        steps = [n["type"] for n in (raw.get("normalizer") or {}).get("normalizers", [])]
        self.plain = self.by_word and steps == ["NFC", "Replace", "Lowercase"] and r"[\p{L}]+" in split[0]["pattern"]["Regex"] and [p["type"] for p in parts] == ["Split", "ByteLevel"] and not parts[1]["add_prefix_space"]
        added = raw.get("added_tokens") or [] if added_tokens else []
        self.added = [t["content"] for t in added]
        self.by_word = self.by_word and not any(t.get("normalized") for t in added)
        self.width = width or (2 if self.tokenizer.get_vocab_size() <= 65_536 else 4)
        self.packed = [i.to_bytes(self.width, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.cache: dict[str, bytes] = {}
        # byte-level models write each byte as a printable character; those that print stand for themselves
        printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in printing]
        self.letters = {b: chr(b) for b in printing} | {b: chr(256 + n) for n, b in enumerate(rest)}

    def _pack(self, ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(self.width, "little") for i in ids])

    def _known(self, word: str) -> bytes | None:
        """Ids of a plain word, from the cache where its lower case is there already."""
        if word.isalpha() and word.isascii() and self.plain:
            low = word.lower()
            ids = self.cache.get(low)
            if ids is None:
                packed = self.packed
                ids = self.cache[low] = b"".join([packed[t.id] for t in self.tokenizer.model.tokenize(low)])
            return ids
        return self._word(word)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian numbers of ``width`` bytes."""
        whole = {i for i, t in enumerate(texts) if t and (not self.by_word or any(c in t for c in (_ODD_ASCII if t.isascii() else _ODD_SPACES)) or any(c in t for c in self.added))}
        words = [self._split(t) if t and i not in whole else [] for i, t in enumerate(texts)]
        out = ids_of_words(words, self.cache, self._learn, CACHE_WORDS)
        for i in whole:
            out[i] = self._pack(self.whole.encode(texts[i], add_special_tokens=False).ids)
        return out

    def _split(self, text: str) -> list[str]:
        """Words of a text. Commas and full stops among letters and digits are words of their own: each is a pre-token there."""
        if self.plain and "\u0130" not in text and text.replace(" ", "").replace("\n", "").replace(",", "").replace(".", "").isalnum() and not any(run in text for run in ("..", ".,", ",.", ",,")):
            text = text.replace(",", " , ").replace(".", " . ")
        return text.split()

    def _word(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters below U+0250; NULL for others."""
        if not (self.plain and word.isalpha() and max(word) < "\u0250" and "\u0130" not in word):
            return None
        low = word.lower()
        if not low.isascii():
            low = "".join([self.letters[b] for b in low.encode()])
        return self._pack([t.id for t in self.tokenizer.model.tokenize(low)])

    def _learn(self, new: set[str]) -> None:
        hard: dict[str, None] = {}
        rest: list[tuple[str, str, str]] = []
        for w in new:
            if (ids := self._known(w)) is not None:
                self.cache[w] = ids
            # a comma or full stop behind an ASCII letter is a token of its own in any context
            elif len(w) > 1 and w[-1] in ",." and w[-2].isascii() and w[-2].isalpha():
                rest.append((w, w[:-1], w[-1]))
                for part in (w[:-1], w[-1]):
                    if part not in self.cache:
                        ids = self._known(part)
                        if ids is None:
                            hard[part] = None
                        else:
                            self.cache[part] = ids
            else:
                hard[w] = None
        ask = [s for s in hard if s not in self.cache]
        for k in range(0, len(ask), 5000):
            part = ask[k : k + 5000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.cache[w] = self._pack(e.ids)
        for w, stem, end in rest:
            self.cache[w] = self.cache[stem] + self.cache[end]


_tokenizers: dict[tuple[str, bool], WordTokenizer] = {}


def tokenizer_of(path: str, added_tokens: bool = False) -> WordTokenizer:
    if (path, added_tokens) not in _tokenizers:
        _tokenizers[path, added_tokens] = WordTokenizer(path, added_tokens)
    return _tokenizers[path, added_tokens]


def train_dictionary(arrays: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Dictionary from serialized arrays; empty where they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes() if sum(map(len, arrays)) > 8 * 1024 else b""
    except zstandard.ZstdError:
        return b""


def dictionary_hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def _codec(dictionary: bytes, cls, **options):
    return cls(dict_data=zstandard.ZstdCompressionDict(dictionary), **options) if dictionary else cls(**options)


class ShardReader:
    """Random access to a shard: the dictionary and the index are read once, a document by one range read."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        head = self.file.read_at(len(MAGIC) + 4, 0)
        tail = self.file.read_at(8 + len(MAGIC), size - 8 - len(MAGIC))
        if head[:8] != MAGIC or tail[8:] != MAGIC:
            raise ValueError(f"{uri} is no whole shard")
        n = int.from_bytes(head[8:12], "little")
        self.header = json.loads(self.file.read_at(n, 12))
        dictionary = self.file.read_at(self.header["dictionary_bytes"], 12 + n)
        if dictionary_hash(dictionary) != self.header["dictionary_sha256"]:
            raise ValueError(f"{uri} was written with another dictionary")
        self.codec = _codec(dictionary, zstandard.ZstdDecompressor)
        self.count = k = int.from_bytes(tail[:8], "little")
        index = self.file.read_at(k * 9 + (k + 1) * 8 + k * 4, size - 16 - (k * 9 + (k + 1) * 8 + k * 4))
        self.ids = np.frombuffer(index, "<i8", k)
        self.nulls = np.frombuffer(index, np.uint8, k, 8 * k)
        self.offsets = np.frombuffer(index, "<u8", k + 1, 9 * k)
        self.n_tokens = np.frombuffer(index, "<u4", k, 9 * k + 8 * (k + 1))
        self.dtype = f"<u{self.header['id_bytes']}"

    def frames(self, begin: int, end: int) -> list[np.ndarray]:
        """Ids of the documents at places ``begin`` to ``end``, by one range read."""
        at = int(self.offsets[begin])
        raw = memoryview(self.file.read_at(int(self.offsets[end]) - at, at))
        return [np.frombuffer(self.codec.decompress(raw[int(self.offsets[i]) - at : int(self.offsets[i + 1]) - at]), self.dtype) for i in range(begin, end)]

    def find(self, doc_id: int) -> np.ndarray | None:
        """Ids of one document (of equal ones, the first)."""
        known = int(self.nulls.sum())
        at = bisect.bisect_left(self.ids, doc_id, known)
        return self.frames(at, at + 1)[0] if at < self.count and self.ids[at] == doc_id else None


def _write_shard(uri: str, dictionary: bytes, id_bytes: int, rows) -> tuple[int, int]:
    """Write the (id, n_tokens, frame) rows, which come in order; returns documents and tokens."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    header = json.dumps({"dictionary_sha256": dictionary_hash(dictionary), "dictionary_bytes": len(dictionary), "id_bytes": id_bytes}).encode()
    ids, nulls, counts, offsets = array("q"), bytearray(), array("L"), array("Q")
    with fs.open_output_stream(path) as out:
        at = out.write(MAGIC + len(header).to_bytes(4, "little") + header + dictionary)
        at = 12 + len(header) + len(dictionary)
        for doc_id, n, frame in rows:
            ids.append(doc_id or 0)
            nulls.append(doc_id is None)
            counts.append(n)
            offsets.append(at)
            out.write(frame)
            at += len(frame)
        offsets.append(at)
        out.write(np.array(ids, "<i8").tobytes() + bytes(nulls) + np.array(offsets, "<u8").tobytes() + np.array(counts, "<u4").tobytes() + len(ids).to_bytes(8, "little") + MAGIC)
    return len(ids), sum(counts)


def write_shards(docs: DataFrame, path: str | None = None, id: str = "doc_id", text: str = "text", end_id: int = 1, shards: int | None = None, level: int = 2, added_tokens: bool = False) -> DataFrame:
    """Encode, append ``end_id`` and write shards; one row per shard: shard, uri, n_docs, n_tokens, start.

    ``start`` counts the ids of all shards before. The rows are as many as shards, so the driver adds
    them up. Texts are not shuffled: only the compressed frames are dealt out, by ranges of the id and,
    among rows of one id, of the frame. Unless ``shards`` says otherwise, a shard holds some ``SHARD_BYTES``.
    """
    spark = docs.sparkSession
    path = path or default_tokenizer()
    narrow = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    share = min(1.0, 1.5 * SAMPLE_DOCUMENTS / max(1, docs.count()))
    bounded = narrow.sample(share, 7).where(F.length("text") <= 100_000).limit(2 * SAMPLE_DOCUMENTS)
    tokenizer = tokenizer_of(path, added_tokens)
    id_bytes, end = tokenizer.width, tokenizer._pack([end_id])
    arrays = tokenizer.encode([r["text"] for r in bounded.collect()])
    dictionary = train_dictionary([a for a in arrays if a])
    tokenizer.cache.clear()
    shared = spark.sparkContext.broadcast(dictionary)

    def compress(batches):
        codec = _codec(shared.value, zstandard.ZstdCompressor, level=level)
        own = tokenizer_of(path, added_tokens)
        for batch in portions(batches, "text", 4_000_000):
            found = own.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(f) // id_bytes + 1 for f in found], pa.int64()), pa.array([codec.compress(f + end) for f in found], pa.binary())], names=["id", "n_tokens", "frame"])

    frames = materialize(narrow.mapInArrow(compress, "id long, n_tokens long, frame binary"), "token-frames")
    if shards is None:
        total = frames.agg(F.sum(F.length("frame") + F.lit(FRAME_COST))).first()[0] or 0
        shards = max(1, -(-total // SHARD_BYTES), min(2 * spark.sparkContext.defaultParallelism, total // LEAST_BYTES))
    target = scratch_dir(spark, "token-shards")

    def write(batches):
        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        shard = first.column(0)[0].as_py()

        def rows():
            batch = first
            while batch is not None:
                yield from zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
                batch = next(batches, None)

        uri = f"{target}/{shard:06d}-{uuid.uuid4().hex}.tok"
        n_docs, n_tokens = _write_shard(uri, shared.value, id_bytes, rows())
        yield pa.RecordBatch.from_pydict({"shard": [shard], "uri": [uri], "n_docs": [n_docs], "n_tokens": [n_tokens]}, schema=pa.schema([("shard", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    # rows of one id may be many (all without one, say), so that length and hash part them further
    order = [F.col("id").asc_nulls_first(), F.col("n_tokens"), F.xxhash64("frame")]
    dealt = frames.repartitionByRange(int(shards), *order).sortWithinPartitions(*order, "frame")
    written = dealt.select(F.spark_partition_id().alias("shard"), "id", "n_tokens", "frame").mapInArrow(write, "shard int, uri string, n_docs long, n_tokens long")
    manifest = sorted(written.collect(), key=lambda r: r["shard"])  # a row for each shard
    start, rows = 0, []
    for r in manifest:
        rows.append((r["shard"], r["uri"], r["n_docs"], r["n_tokens"], start))
        start += r["n_tokens"]
    return spark.createDataFrame(rows, "shard int, uri string, n_docs long, n_tokens long, start long")


def read_shards(manifest: DataFrame, id: str = "doc_id", block: int = 4_000_000) -> DataFrame:
    """One row per document of the shards: id, start, n_tokens and the CRC-32 of its ids (32 bits each)."""

    def run(batches):
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = ShardReader(uri)
                begin = 0
                while begin < reader.count:
                    end = max(begin + 1, int(np.searchsorted(reader.offsets, reader.offsets[begin] + np.uint64(block), "right")) - 1)
                    found = reader.frames(begin, min(end, reader.count))
                    end = begin + len(found)
                    n = np.array([len(f) for f in found], np.int64)
                    if (n != reader.n_tokens[begin:end]).any():
                        raise ValueError(f"{uri}: index and frames differ")
                    starts = start + np.cumsum(n) - n
                    start += int(n.sum())
                    crc = [zlib.crc32(f.astype("<u4").tobytes()) for f in found]
                    ids = pa.array(reader.ids[begin:end], mask=reader.nulls[begin:end].astype(bool))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(n), pa.array(crc, pa.int64())], names=[id, "start", "n_tokens", "ids_crc32"])
                    begin = end

    n = max(1, min(manifest.count(), 8 * manifest.sparkSession.sparkContext.defaultParallelism))
    return manifest.select("uri", "start", "shard").repartitionById(n, (F.col("shard") % n).cast("int")).select("uri", "start").mapInArrow(run, f"`{id}` long, start long, n_tokens long, ids_crc32 long")


def read_document(spark: SparkSession, manifest: DataFrame, doc_id: int) -> list[int] | None:
    """Ids of one document, found by the shards' indexes and one range read."""
    for r in manifest.orderBy("shard").collect():
        found = ShardReader(r["uri"]).find(doc_id)
        if found is not None:
            return found.tolist()
    return None

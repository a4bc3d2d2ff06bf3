"""Token ids in binary shards, with a minimal perfect hash index from document keys to places in them.

Files below one folder:

- `ids/PPPPPP-SSSSS.ids`: a shard: the raw little-endian ids of its documents one after another, each
  with the end id; then where each document begins (64 bits, one more than documents), then a fixed
  trailer. Shards in the order of their names hold the documents in ascending order of their keys.
- `index/PPPPPPPP.mph`: the keys whose digest falls into that part: a minimal perfect hash (levels of bits; a key
  that meets another one in a level goes on to the next), and in its order a 32-bit fingerprint and the
  first and last place (shard and number in it) of each key. A lookup reads one bit a level, two on average.
- `shards`: one row for each shard; `format.json`, written last: widths and counts. Without it there is no store.

Writing is one shuffle of the texts into ranges of keys, sorted within. A task encodes as it writes and holds
one slice of texts and the begins of one shard. Rows that share a key, a third of all rows too, are told
apart by their place in the input, so that ranges can cut through them. A second, narrow shuffle builds the
index, one bounded part at a time. Shards and index files are written aside and moved to names that depend
on the input only, so an attempt that runs again replaces a file by its equal.

Ids have two bytes if the vocabulary allows it, else four. Null texts count as empty: the end id only. A null key
is a key of its own and comes first; documents that share a key keep the order of the input and are all found
under it. An empty table gives a store without shards. Keys that are not in the store are not found, but for one
in 2^32 whose fingerprint agrees. The folder must be one that pyarrow's file systems reach (file, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.common import Texts, cut, map_arrow, slices
from sluiceway.sinks.storage import remove, small_frame

#: Bytes of text in a range of keys on average, and most ranges.
RANGE_BYTES = 32 << 20
MOST_RANGES = 50_000
#: Ids and documents after which a shard is closed.
SHARD_IDS = 1 << 23
SHARD_DOCS = 1 << 20
#: Keys in a part of the index on average.
INDEX_KEYS = 1 << 18
#: Documents that a reading task takes from a shard in one go, and bytes it reads at once.
BLOCK_DOCS = 1024
READ_BYTES = 8 << 20
#: Chunks of text whose ids a process keeps in a generation, longest chunk that is kept, chunks given to the library at once.
CACHE_CHUNKS = 500_000
CACHE_LENGTH = 64
JOINED_CHUNKS = 4096

#: A place is (range << SEQ_BITS | shard of the range) << DOC_BITS | document of the shard.
SEQ_BITS = 16
DOC_BITS = 24

_TRAILER = struct.Struct("<4sHHQQQ")
_MAGIC = b"SWID"
_HEADER = struct.Struct("<4sHHQ")
_INDEX_MAGIC = b"SWMP"


#: A space before white space or the end, what of it a word cannot start with, and marks that end a word.
_ODD_SPACE = re.compile(r" (?=[\s\u180e]|$)")
_ODD_START = re.compile(r"[\s\u180e]")
_MARKS = ".,;:!?"


class ChunkEncoder:
    """The tokenizers library over texts, as little-endian ids with the end id.

    Byte-level pre-tokenizers never join characters over a space that a non-space follows, so texts are cut
    there and the ids of words are kept; with any other tokenizer file whole texts are encoded. New words go to the
    library many at once: words of letters in one text, others with a special token between them, which
    parts texts before they are pre-tokenized.
    """

    def __init__(self, vocabulary: str, end_id: int) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self.width = id_width(self._tokenizer.get_vocab_size(), end_id)
        with open(vocabulary, encoding="utf-8") as f:
            made = json.load(f)
        kind = made["pre_tokenizer"] or {}
        added = [t for t in made["added_tokens"] if not any(t[k] for k in ("single_word", "lstrip", "rstrip")) and " " not in t["content"]]
        plain = made["normalizer"] is None and made["post_processor"] is None and len(added) == len(made["added_tokens"])
        self._cuts = plain and kind.get("type") == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"]
        self._border = next(((t["content"], t["id"]) for t in added if t["special"]), None)
        self._added = [t["content"] for t in added]
        self._end = end_id.to_bytes(self.width, "little")
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._marks = dict(zip(_MARKS, self._encode(list(_MARKS)), strict=True))

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=f"<u{self.width}").tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """What the library gives for each chunk."""
        if not chunks:
            return []
        if self._border is None:
            return self._encode(chunks)
        content, border = self._border
        apart = {k: ids for k, c in enumerate(chunks) if any(a in c for a in self._added) for ids in self._encode([c])}
        joined = content.join(["" if k in apart else c for k, c in enumerate(chunks)] if apart else chunks)
        data = self._encode([joined])[0]
        at = np.flatnonzero(np.frombuffer(data, f"<u{self.width}") == border) * self.width
        out = [data[low:high] for low, high in zip([0, *(at + self.width).tolist()], [*at.tolist(), len(data)], strict=True)]
        for k, ids in apart.items():
            out[k] = ids
        return out

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """What the library gives for each word after a space. Words of letters go to it as one text if each is one pre-token there."""
        plain = [w for w in words if w.isalpha()]
        out: dict[str, bytes] = {}
        if plain:
            encoded = self._tokenizer.encode(" " + " ".join(plain), add_special_tokens=False)
            owners = np.array(encoded.word_ids)
            if owners[-1] + 1 == len(plain):
                data = np.array(encoded.ids, dtype=f"<u{self.width}").tobytes()
                at = (np.flatnonzero(np.append(True, owners[1:] != owners[:-1])) * self.width).tolist()
                out = {w: data[low:high] for w, low, high in zip(plain, at, [*at[1:], len(data)], strict=True)}
        other = [w for w in words if w not in out]
        out.update(zip(other, self._encode_chunks([" " + w for w in other]), strict=True))
        return [out[w] for w in words]

    def _words(self, text: str) -> list[str]:
        """Parts of a text that a space parts; the library never joins two of them."""
        words = text.split(" ")
        if _ODD_SPACE.search(text):
            out = words[:1]
            for word in words[1:]:
                if not word or _ODD_START.match(word):
                    out[-1] += " " + word
                else:
                    out.append(word)
            return out
        return words

    def _learn(self, new: list[str]) -> None:
        """Ids of words that follow a space. A word and the mark after it are two pre-tokens."""
        whole = [w if len(w) < 2 or w[-1] not in _MARKS or not ("A" <= w[-2] < "\u0250" and w[-2].isalpha()) else w[:-1] for w in new]
        found: dict[str, bytes] = {}
        unknown = []
        for w in set(whole):
            ids = self._young.get(w) or self._old.get(w)
            if ids is None:
                unknown.append(w)
            else:
                found[w] = ids
        for low in range(0, len(unknown), JOINED_CHUNKS):
            part = unknown[low : low + JOINED_CHUNKS]
            found.update(zip(part, self._encode_words(part), strict=True))
        self._young.update(found)
        self._young.update((w, found[stem] + self._marks[w[-1]]) for w, stem in zip(new, whole, strict=True) if len(w) != len(stem))

    def __call__(self, texts: Texts) -> list[bytes]:
        if not self._cuts:
            return [ids + self._end for ids in self._encode([t or "" for t in texts])]
        words = [self._words(t or "") for t in texts]
        firsts = self._encode_chunks([of[0] for of in words]) if words else []
        for of in words:
            of[0] = ""  # its place; words that follow a space are not empty
        used = set().union(*words)
        missing = used.difference(self._young)
        missing.discard("")
        again = {w: self._old[w] for w in missing if w in self._old}
        self._young.update(again)
        self._learn(list(missing.difference(again)))
        known = self._young
        known[""] = b""
        out = [first + b"".join(map(known.__getitem__, of)) + self._end for first, of in zip(firsts, words, strict=True)]
        for w in [w for w in missing if len(w) > CACHE_LENGTH]:
            del known[w]
        if len(known) > CACHE_CHUNKS:  # words that come again move on to the next generation
            self._young, self._old = {}, known
        return out


@lru_cache(maxsize=1)
def encoder_of(vocabulary: str, end_id: int) -> ChunkEncoder:
    """One encoder for each Python process, so that tasks share what it keeps."""
    return ChunkEncoder(vocabulary, end_id)


def id_width(vocabulary_size: int, end_id: int) -> int:
    """Bytes of an id."""
    return 2 if max(vocabulary_size - 1, end_id) < 1 << 16 else 4


# --- minimal perfect hash -----------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-byte digests as two numbers each."""
    both = digests.view("<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _slot(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
    return _mix(low ^ _mix(high + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))) % np.uint64(size)


def build_levels(digests: np.ndarray) -> list[np.ndarray]:
    """Bits of each level for distinct 16-byte digests: a bit is set where exactly one key falls."""
    low, high = _halves(digests)
    levels = []
    while len(low):
        size = max(64, 2 * len(low))
        at = _slot(low, high, len(levels), size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        levels.append(alone)
        stay = ~alone[at]
        low, high = low[stay], high[stay]
    return levels


class PerfectHash:
    """Numbers from 0 to n - 1 for n keys; other keys get some number or -1."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self._before = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self._ranks = [np.concatenate(([0], np.cumsum(x, dtype=np.int64))) for x in levels]

    def __call__(self, digests: np.ndarray) -> np.ndarray:
        low, high = _halves(digests)
        out, open_ = np.full(len(low), -1, dtype=np.int64), np.arange(len(low))
        for level, bits in enumerate(self.levels):
            at = _slot(low[open_], high[open_], level, len(bits)).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self._before[level] + self._ranks[level][at[hit]]
            open_ = open_[~hit]
        return out


def _fingerprint(digests: np.ndarray) -> np.ndarray:
    return digests.view("<u4").reshape(-1, 4)[:, 3].copy()


def pack_index(digests: np.ndarray, first: np.ndarray, last: np.ndarray) -> bytes:
    """An index file for distinct keys and their places."""
    levels = build_levels(digests)
    order = np.argsort(PerfectHash(levels)(digests))
    head = _HEADER.pack(_INDEX_MAGIC, 1, len(levels), len(first)) + np.array([len(x) for x in levels], dtype="<u8").tobytes()
    bits = b"".join(np.packbits(x, bitorder="little").tobytes() for x in levels)
    return head + bits + _fingerprint(digests)[order].astype("<u4").tobytes() + first[order].astype("<u8").tobytes() + last[order].astype("<u8").tobytes()


class IndexPart:
    """An index file, for lookups by digest."""

    def __init__(self, data: bytes) -> None:
        magic, version, n_levels, n = _HEADER.unpack_from(data)
        if magic != _INDEX_MAGIC or version != 1:
            raise ValueError("not an index of token shards")
        at = _HEADER.size + 8 * n_levels
        levels = []
        for size in np.frombuffer(data, "<u8", n_levels, _HEADER.size).tolist():
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size, bitorder="little").astype(bool))
            at += -(-size // 8)
        self._hash = PerfectHash(levels)
        self._prints, self._first, self._last = (np.frombuffer(data, t, n, at + n * skip) for t, skip in (("<u4", 0), ("<u8", 4), ("<u8", 12)))

    def __call__(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last places; -1 for keys that are not there."""
        found = self._hash(digests)
        there = found >= 0
        there[there] = self._prints[found[there]] == _fingerprint(digests)[there]
        first, last = np.full(len(found), -1, dtype=np.int64), np.full(len(found), -1, dtype=np.int64)
        first[there], last[there] = self._first[found[there]], self._last[found[there]]
        return first, last


# --- files --------------------------------------------------------------------------------------------


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class _Aside:
    """A file that gets its name when it is complete."""

    def __init__(self, fs: pafs.FileSystem, name: str) -> None:
        self._fs, self._name, self._temp = fs, name, f"{name}.{uuid.uuid4().hex}.tmp"
        self.out = fs.open_output_stream(self._temp)

    def publish(self) -> None:
        self.out.close()
        try:
            self._fs.move(self._temp, self._name)
        except OSError:
            if self._fs.get_file_info(self._name).type != pafs.FileType.File:
                raise
            self._fs.delete_file(self._temp)  # another attempt has written the same


def shard_name(shard: int) -> str:
    return f"{shard >> SEQ_BITS:06d}-{shard & ((1 << SEQ_BITS) - 1):05d}.ids"


class _ShardWriter:
    """Documents of one range of keys, in order, into its shards."""

    def __init__(self, folder: str, part: int, width: int, shard_ids: int, shard_docs: int) -> None:
        self._fs, path = _open(folder)
        self._folder, self._part, self._width, self._most_ids, self._most_docs = f"{path}/ids", part, width, shard_ids, shard_docs
        self._seq, self._before, self._file = 0, 0, None

    def _begin(self) -> None:
        if self._seq >= 1 << SEQ_BITS:
            raise ValueError("too many shards in one range of keys; raise SHARD_IDS")
        self.shard = self._part << SEQ_BITS | self._seq
        self._file, self._begins = _Aside(self._fs, f"{self._folder}/{shard_name(self.shard)}"), [0]

    def add(self, ids: bytes) -> tuple[int, tuple[int, int, int, int] | None]:
        """The document's place, and the finished shard before it if there is one."""
        done = self.close() if self._file and (self._begins[-1] >= self._most_ids or len(self._begins) > self._most_docs) else None
        if self._file is None:
            self._begin()
        self._file.out.write(ids)
        self._begins.append(self._begins[-1] + len(ids) // self._width)
        return self.shard << DOC_BITS | (len(self._begins) - 2), done

    def close(self) -> tuple[int, int, int, int] | None:
        """shard, documents, ids, ids of earlier shards of this range."""
        if self._file is None:
            return None
        docs, ids = len(self._begins) - 1, self._begins[-1]
        self._file.out.write(np.array(self._begins, dtype="<u8").tobytes())
        self._file.out.write(_TRAILER.pack(_MAGIC, 1, self._width, docs, ids, self._before))
        self._file.publish()
        out = (self.shard, docs, ids, self._before)
        self._file, self._before, self._seq = None, self._before + ids, self._seq + 1
        return out


class ShardReader:
    """Documents of one shard by number: where they begin is read from the file's end, ids from their place."""

    def __init__(self, fs: pafs.FileSystem, folder: str, shard: int) -> None:
        self._file = fs.open_input_file(f"{folder}/ids/{shard_name(shard)}")
        magic, version, self.width, self.docs, self.ids, self.before = _TRAILER.unpack(self._file.read_at(_TRAILER.size, self._file.size() - _TRAILER.size))
        if magic != _MAGIC or version != 1:
            raise ValueError("not a shard of token ids")

    def begins(self, low: int, high: int) -> np.ndarray:
        """Where the documents low to high - 1 begin, and where the last one ends."""
        return np.frombuffer(self._file.read_at(8 * (high - low + 1), self.ids * self.width + 8 * low), "<u8").astype(np.int64)

    def read(self, low: int, high: int) -> Iterator[tuple[int, np.ndarray]]:
        """Begin in the shard, and ids, of the documents low to high - 1."""
        begins, at = self.begins(low, high), 0
        while at < high - low:
            room = begins[at] + READ_BYTES // self.width
            end = max(at + 1, int(np.searchsorted(begins, room, side="right")) - 1)
            data = np.frombuffer(self._file.read_at(int(begins[end] - begins[at]) * self.width, int(begins[at]) * self.width), f"<u{self.width}").astype("<u4")
            for k in range(at, end):
                yield int(begins[k]), data[begins[k] - begins[at] : begins[k + 1] - begins[at]]
            at = end

    def close(self) -> None:
        self._file.close()


# --- writing ------------------------------------------------------------------------------------------


def key_digest(key: Column) -> Column:
    """16 bytes that stand for a key; null is a key too."""
    return F.unhex(F.md5(F.when(key.isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), key.cast("string"))).cast("binary")))


def _part_of(bits: int) -> Column:
    """Part of the index that holds a digest: its first bits."""
    return F.shiftrightunsigned(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), 32 - bits)


_ENTRY = "digest binary, place long, shard long, docs long, ids long, before long"
_ENTRY_FIELDS = [("digest", pa.binary()), *((n, pa.int64()) for n in ("place", "shard", "docs", "ids", "before"))]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _range_writer(folder: str, vocabulary: str, end_id: int, shard_ids: int, shard_docs: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer = encoder_of(vocabulary, end_id), None
        for batch in batches:
            for part, texts in slices(batch, 1):
                if writer is None:
                    writer = _ShardWriter(folder, TaskContext.get().partitionId(), encode.width, shard_ids, shard_docs)
                rows: list[tuple] = []
                for digest, ids in zip(part.column(0).to_pylist(), encode(texts), strict=True):
                    place, done = writer.add(ids)
                    rows.append((digest, place, None, None, None, None))
                    if done:
                        rows.append((None, None, *done))
                yield _batch(rows, _ENTRY_FIELDS)
        if writer is not None and (done := writer.close()):
            yield _batch([(None, None, *done)], _ENTRY_FIELDS)

    return run


def _index_builder(folder: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows sorted by part: one part is held at a time."""

    def write(part: int, held: list[pa.RecordBatch]) -> tuple[int, int]:
        table = pa.Table.from_batches(held)
        digests = np.frombuffer(b"".join(table.column("digest").to_pylist()), dtype=np.uint8)
        fs, path = _open(folder)
        file = _Aside(fs, f"{path}/index/{part:08d}.mph")
        file.out.write(pack_index(digests, table.column("first").to_numpy(), table.column("last").to_numpy()))
        file.publish()
        return part, table.num_rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("part", pa.int64()), ("keys", pa.int64())]
        for part, held in _parts(batches):
            yield _batch([write(part, held)], fields)

    return run


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows sorted by their column `part`, as one list of batches for each part."""
    now, held = None, []
    for batch in batches:
        parts = batch.column("part").to_numpy()
        cuts = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(parts) else []
        for begin, end in zip(cuts, np.append(cuts[1:], len(parts)) if len(parts) else [], strict=True):
            if parts[begin] != now and held:
                yield int(now), held
                held = []
            now = parts[begin]
            held.append(batch.slice(begin, end - begin))
    if held:
        yield int(now), held


def write_store(
    df: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
    range_bytes: int = RANGE_BYTES, shard_ids: int = SHARD_IDS, shard_docs: int = SHARD_DOCS, index_keys: int = INDEX_KEYS,
) -> None:
    """Write all rows of `df` as a store in a new folder."""
    spark = df.sparkSession
    fs, path = _open(folder)
    for name in ("ids", "index"):
        fs.create_dir(f"{path}/{name}", recursive=True)
    picked = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        picked = cut(picked)  # the order of its rows may change when a task runs again
    size, docs = picked.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    ranges = max(1, min(MOST_RANGES, -(-(size or 0) // range_bytes)))
    placed = picked.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(ranges, F.col("key").asc_nulls_first(), "at").sortWithinPartitions(F.col("key").asc_nulls_first(), "at")
    entries = map_arrow(placed.select(key_digest(F.col("key")).alias("digest"), "text"), _range_writer(folder, vocabulary, end_id, shard_ids, shard_docs), _ENTRY)
    entries.write.parquet(f"{folder}/entries")
    entries = spark.read.parquet(f"{folder}/entries")
    shards = entries.where("digest is null").select((F.col("shard") / (1 << SEQ_BITS)).cast("long").alias("part"), "shard", "docs", "ids", "before")
    shards.write.parquet(f"{folder}/shards")
    bits = max(0, -(-docs // index_keys) - 1).bit_length()
    keys = entries.where("digest is not null").groupBy("digest").agg(F.min("place").alias("first"), F.max("place").alias("last")).withColumn("part", _part_of(bits))
    built = map_arrow(keys.repartition("part").sortWithinPartitions("part"), _index_builder(folder), "part long, keys long")
    n_keys = built.agg(F.sum("keys")).first()[0] or 0
    remove(spark, f"{folder}/entries")
    file = _Aside(fs, f"{path}/format.json")
    file.out.write(json.dumps({"version": 1, "end_id": end_id, "documents": docs, "keys": n_keys, "index_bits": bits}).encode())
    file.publish()


# --- reading ------------------------------------------------------------------------------------------


def _read_index(fs: pafs.FileSystem, path: str, part: int) -> IndexPart | None:
    name = f"{path}/index/{part:08d}.mph"
    if fs.get_file_info(name).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(name) as f:
        return IndexPart(f.read())


class TokenStore:
    """Access to one store by key, without Spark."""

    def __init__(self, folder: str) -> None:
        self._fs, self._path = _open(folder)
        with self._fs.open_input_stream(f"{self._path}/format.json") as f:
            self.about = json.loads(f.read())
        self._parts: dict[int, IndexPart | None] = {}

    def places(self, key: Any) -> tuple[int, int] | None:
        digest = hashlib.md5(b"n" if key is None else b"k" + str(key).encode()).digest()
        part = int.from_bytes(digest[:4], "big") >> (32 - self.about["index_bits"])
        if part not in self._parts:
            self._parts[part] = _read_index(self._fs, self._path, part)
        if self._parts[part] is None:
            return None
        first, last = self._parts[part](np.frombuffer(digest, dtype=np.uint8))
        return None if first[0] < 0 else (int(first[0]), int(last[0]))

    def get(self, key: Any) -> Iterator[np.ndarray]:
        """Ids of every document with this key, end ids included."""
        found = self.places(key)
        if found is None:
            return
        (low, begin), (high, end) = (divmod(p, 1 << DOC_BITS) for p in found)
        shards = [low]
        if high > low:
            names = sorted(f.base_name for f in self._fs.get_file_info(pafs.FileSelector(f"{self._path}/ids")) if f.extension == "ids")
            shards = [s for s in (int(a) << SEQ_BITS | int(b) for a, b in (n.removesuffix(".ids").split("-") for n in names)) if low <= s <= high]
        for shard in shards:
            reader = ShardReader(self._fs, self._path, shard)
            for _, ids in reader.read(begin if shard == low else 0, end + 1 if shard == high else reader.docs):
                yield ids
            reader.close()


def _looker(folder: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over keys sorted by part of the index: one part is held at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        for part, held in _parts(batches):
            index = _read_index(fs, path, part)
            for batch in held if index else []:
                first, last = index(np.frombuffer(b"".join(batch.column("digest").to_pylist()), dtype=np.uint8))
                there = pa.array(first >= 0)
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(first), pa.array(last)], names=["key", "first", "last"]).filter(there)

    return run


def _block_reader(folder: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over pieces (key, shard, low, high) sorted by shard and low: one shard is open at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        reader, now = None, None
        for batch in batches:
            shards, lows, highs = (batch.column(n).to_pylist() for n in ("shard", "low", "high"))
            at = 0
            while at < len(shards):
                if shards[at] != now:
                    if reader:
                        reader.close()
                    now, reader = shards[at], ShardReader(fs, path, shards[at])
                end = at + 1  # pieces that follow one another without a gap are read together
                while end < len(shards) and shards[end] == now and lows[end] == highs[end - 1] and highs[end] - lows[at] <= BLOCK_DOCS:
                    end += 1
                owner = np.repeat(np.arange(at, end), [highs[k] - lows[k] for k in range(at, end)])
                rows: list[tuple[int, int, bytes]] = []
                held = 0
                for k, (begin, ids) in zip(owner.tolist(), reader.read(lows[at], highs[end - 1]), strict=True):
                    rows.append((k, begin + reader.before, ids.tobytes()))
                    held += ids.nbytes
                    if held >= READ_BYTES:
                        yield _documents(batch, rows)
                        rows, held = [], 0
                if rows:
                    yield _documents(batch, rows)
                at = end
        if reader:
            reader.close()

    return run


def _documents(batch: pa.RecordBatch, rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    owner, begin, ids = zip(*rows, strict=True)
    taken = batch.take(pa.array(owner, pa.int64()))
    return pa.RecordBatch.from_arrays([taken.column("key"), taken.column("part"), pa.array(begin, pa.int64()), pa.array(ids, pa.binary())], names=["key", "part", "begin", "ids"])


def read_documents(keys: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """key, start (ids of all documents before it), ids (32-bit little-endian, end id included) of every stored document
    with a key of `keys`, found through the index; repeated keys in `keys` count once, unknown ones give no row."""
    spark = keys.sparkSession
    fs, path = _open(folder)
    with fs.open_input_stream(f"{path}/format.json") as f:
        about = json.loads(f.read())
    kind = keys.schema[key].dataType.simpleString()
    wanted = keys.select(F.col(f"`{key}`").alias("key")).distinct().withColumn("digest", key_digest(F.col("key"))).withColumn("part", _part_of(about["index_bits"]))
    found = map_arrow(wanted.repartition("part").sortWithinPartitions("part"), _looker(folder), f"key {kind}, first long, last long")
    shard_of, doc_of = lambda c: F.shiftright(c, DOC_BITS), lambda c: F.col(c).bitwiseAND((1 << DOC_BITS) - 1)
    found = found.select("key", shard_of("first").alias("shard"), doc_of("first").alias("low"), shard_of("last").alias("last_shard"), (doc_of("last") + 1).alias("high"))
    shards = spark.read.parquet(f"{folder}/shards")
    one = found.where("shard = last_shard").select("key", "shard", "low", "high")
    # A key whose documents go over several shards: its ranges, then their shards.
    several = found.where("shard <> last_shard").withColumnsRenamed({"shard": "first_shard", "high": "end", "low": "begin"})
    spread = several.withColumn("part", F.explode(F.sequence(F.shiftright("first_shard", SEQ_BITS), F.shiftright("last_shard", SEQ_BITS))))
    many = spread.join(shards, "part").where("shard between first_shard and last_shard").select(
        "key", "shard", F.expr("if(shard = first_shard, begin, 0L)").alias("low"), F.expr("if(shard = last_shard, end, docs)").alias("high")
    )
    blocks = F.explode(F.sequence(F.expr(f"low div {BLOCK_DOCS}"), F.expr(f"(high - 1) div {BLOCK_DOCS}")))
    pieces = one.unionByName(many).withColumn("block", blocks).select(
        "key", F.shiftright("shard", SEQ_BITS).alias("part"), "shard", "block",
        F.greatest("low", F.col("block") * BLOCK_DOCS).alias("low"), F.least("high", (F.col("block") + 1) * BLOCK_DOCS).alias("high"),
    )
    dealt = pieces.repartition("shard", "block").sortWithinPartitions("shard", "low")
    read = map_arrow(dealt.drop("block"), _block_reader(folder), f"key {kind}, part long, begin long, ids binary")
    starts, before = [], 0
    for part, ids in sorted(map(tuple, shards.groupBy("part").agg(F.sum("ids")).collect())):  # MOST_RANGES rows at most
        starts.append((part, before))
        before += ids
    start = F.broadcast(small_frame(spark, starts, "part long, offset long"))
    return read.join(start, "part").select(F.col("key").alias(key), (F.col("begin") + F.col("offset")).alias("start"), "ids")


def token_digests(df: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """key, start, n_tokens, ids_crc32 of every document, read back from a store written to `folder`."""
    write_store(df, folder, vocabulary, key, text, end_id)
    read = read_documents(df, folder, key)
    return read.select(key, "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def new_folder(spark: SparkSession, shared: str) -> str:
    """A folder for one store below the shared one."""
    return f"{shared.rstrip('/')}/token-store-{uuid.uuid4().hex}"

"""Exact Jaccard join of documents on word shingles, by vertical partitioning of the global shingle order.

Shingles are 64-bit hashes of `WIDTH` words, and their numeric order is the global order. It is cut into
fragments (ranges); each document's set falls into one segment a fragment.

1. A document's class is its set: equal sets share one id, and only one of them is joined.
2. Fragments find shared shingles: each map task packs its segments by fragment, shingles that only one of its
   sets holds with that set, others once without sets. In a fragment a shingle counts as shared if two sets
   or two tasks hold it. A shingle in a third of all documents is one entry for each map task.
   That is done for the low part of the order first. Linked sets lack a quarter of either at most, also there, so
   only sets that share enough of their low part have the rest of it packed, from their texts read again.
3. Two sets link only if three quarters of either are shared, so all other sets leave. Among those that
   stay, shingles are ordered from rare to frequent, and a pair must meet in the sets' first ones (prefixes).
   A pair's overlap lies within the shared part of either set, from the first shingle in which they meet on;
   pairs for which that is too little leave too.
   A signature of each set, a bit for each shared shingle by its hash, bounds the overlap from above: a bit
   that one set has and the other lacks stands for a shingle at least that they do not share.
4. Large groups are joined without their pairs: for every prefix shingle, its sets are compared with one
   centre only, and linked sets become components; turns with other centres follow while the pairs that are
   still open outnumber the prefix entries and each turn at least halves them. Then every pair of sets that meet in a prefix,
   lie in different components and can link by the bounds of their signatures is compared: signatures of a
   shingle's sets block by block in memory, the rest in full. No link between components is missed; links within one
   change nothing.
5. To compare a pair, its overlap is counted in each fragment separately and summed.

Result: class and component of every document. Nulls, empty texts and texts without words have no shingle
and link with nothing; a text of fewer than WIDTH words is one shingle. Repeated rows are in one class.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import cut, cut_estimates, map_arrow, slices

#: Words in a shingle. Sets link when 4 * overlap >= 3 * union (similarity 0.75).
WIDTH = 5

#: Shingles that a map task packs together, shingles in a fragment on average, most fragments.
PACKED = 1 << 20
FRAGMENT = 1 << 21
MOST_FRAGMENTS = 1 << 18
#: Bytes of a packed shingle; the fragment's number stands for the bits above them.
PACKED_BYTES = 6
#: Fragments in which the overlap of a pair is counted separately.
COUNT_FRAGMENTS = 4
#: 64-bit words in the signature of a set.
SIGNATURE = 16
#: Edges between components that one task follows at most (16 MB).
EDGES = 1 << 20
#: Sets of a block that are held together where the sets of a shingle are compared, and pairs compared at once.
BLOCK = 4096
COMPARED = 1 << 15
#: 64-bit values of a written frame that one task reads at least (4 MB), so that few rows make few tasks and files.
TASK_VALUES = 1 << 19
#: Shingles below it are the low part of the order, three eighths of all.
LOW = np.uint64(3 << 61)
#: Bytes of text that stand for a shingle where their number is estimated.
SHINGLE_BYTES = 6
#: Bits of the table of keys (4 MB) that says whose texts are read again; keys that share a bit are read in vain.
KEY_BITS = 1 << 25
#: Words whose hash a process keeps; beyond it the table is filled anew.
CACHE_WORDS = 300_000

#: Ids of leaving documents that are broadcast at most (some 16 MB).
BROADCAST_IDS = 1_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_FIRST, _SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finishing steps of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * _FIRST
    x = (x ^ (x >> np.uint64(27))) * _SECOND
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hashes of words, as bytes."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word).to_bytes(8, "little")
        return found


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self) -> None:
        self._hashes = _WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z and ASCII white space only
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(words) < WIDTH:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
        hashes = np.frombuffer(b"".join(map(self._hashes.__getitem__, words)), dtype="<u8").astype(np.uint64, copy=False)
        n = len(words) - WIDTH + 1
        code = hashes[:n]
        for k in range(1, WIDTH):
            code = _mix(code * _ODD) ^ hashes[k : n + k]
        code = np.sort(_mix(code * _ODD))
        return code[np.append(True, code[1:] != code[:-1])]


def set_id(shingles: np.ndarray) -> int | None:
    """Id of a set; null for the empty one."""
    return int(np.array(xxhash.xxh3_64_intdigest(shingles.tobytes()), dtype=np.uint64).view(np.int64)) if len(shingles) else None


def _pack(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PACKED_BYTES].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // PACKED_BYTES, 8), dtype=np.uint8)
    wide[:, :PACKED_BYTES] = np.frombuffer(data, dtype=np.uint8).reshape(-1, PACKED_BYTES)
    return wide.reshape(-1).view("<u8")


#: Packed segments of a fragment (single shingles with their owners, and shingles of several sets), or packed lists
#: of shared shingles (owner, count, shingles) of a bucket of sets.
_LISTS = "bucket int, names binary, counts binary, shared binary"
_SEGMENTS = f"fragment int, alone binary, owners binary, lengths binary, several binary, {_LISTS}"
_LIST_FIELDS = [("bucket", pa.int32()), ("names", pa.binary()), ("counts", pa.binary()), ("shared", pa.binary())]
_SEGMENT_FIELDS = [("fragment", pa.int32()), ("alone", pa.binary()), ("owners", pa.binary()), ("lengths", pa.binary()), ("several", pa.binary()), *_LIST_FIELDS]


#: What is known of a document; its row goes along with the segments.
_DOCUMENT = ["_key", "n_shingles", "n_low", "set_id"]


def _fragment_of(shingles: np.ndarray, bits: int) -> np.ndarray:
    return (shingles >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(shingles), dtype=np.int64)


def _reduced(shingles: np.ndarray, bits: int) -> np.ndarray:
    """What the fragment's number and the packed bytes say about shingles."""
    low = shingles & np.uint64((1 << (8 * PACKED_BYTES)) - 1)
    return (_fragment_of(shingles, bits).astype(np.uint64) << np.uint64(8 * PACKED_BYTES)) | low


def _lists(owners: np.ndarray, shingles: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Shared shingles by owner, packed for each bucket of owners."""
    order = np.argsort(owners.view(np.uint64), kind="stable")
    owners, shingles = owners[order], shingles[order]
    bucket = _fragment_of(_mix(owners.view(np.uint64)), bits)
    by = np.argsort(bucket, kind="stable")
    owners, shingles, bucket = owners[by], shingles[by], bucket[by]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for begin, end in zip(cuts, np.append(cuts[1:], len(owners)), strict=True):
        starts = np.flatnonzero(np.append(True, owners[begin + 1 : end] != owners[begin : end - 1]))
        counts = np.diff(np.append(starts, end - begin)).astype(np.int32)
        yield int(bucket[begin]), owners[begin:end][starts].tobytes(), counts.tobytes(), shingles[begin:end].astype("<u8").tobytes()


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _pack_batch(sets: dict[int, np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """A map task's segments: rows to deal out by fragment, and what is already known to be shared."""
    ids = np.fromiter(sets, dtype=np.int64, count=len(sets))
    sizes = np.fromiter(map(len, sets.values()), dtype=np.int64, count=len(sets))
    owners, shingles = np.repeat(ids, sizes), np.concatenate(list(sets.values()))
    order = np.argsort(shingles, kind="stable")
    owners, shingles = owners[order], shingles[order]
    same = shingles[1:] == shingles[:-1]
    shared = np.zeros(len(shingles), dtype=bool)
    shared[1:] |= same
    shared[:-1] |= same
    fragment = _fragment_of(shingles, bits)
    cuts = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1]))
    rows = []
    for begin, end in zip(cuts, np.append(cuts[1:], len(shingles)), strict=True):
        here, own, many = shingles[begin:end], owners[begin:end], shared[begin:end]
        single, whose = here[~many], own[~many]
        by = np.argsort(whose, kind="stable")
        names, counts = np.unique(whose, return_counts=True)
        rows.append((int(fragment[begin]), _pack(single[by]), names.tobytes(), counts.astype(np.int32).tobytes(), _pack(np.unique(here[many])), None, None, None, None))
    if shared.any():  # these lists go along with the fragments, dealt out evenly
        rows += [(bucket, None, None, None, None, bucket, *packed) for bucket, *packed in _lists(owners[shared], _reduced(shingles[shared], bits), bits)]
    yield _batch(rows, _SEGMENT_FIELDS)


def _after_nulls(batch: pa.RecordBatch, fields: list[pa.Field]) -> pa.RecordBatch:
    """The batch behind further columns without values."""
    return pa.RecordBatch.from_arrays([*(pa.nulls(batch.num_rows, f.type) for f in fields), *batch.columns], names=[*(f.name for f in fields), *batch.schema.names])


def _low_packer(bits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over keys and texts: a row for every document, dealt out evenly, and the segments of the low part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sets, held, passed, fields = Shingler(), {}, 0, 0, []
        for batch in batches:
            fields = [pa.field("_key", batch.schema.field(0).type), *(pa.field(n, pa.int64()) for n in _DOCUMENT[1:])]
            for part, texts in slices(batch, 1):
                found = [shingle(t) for t in texts]
                names, low = [set_id(s) for s in found], [s[: np.searchsorted(s, LOW)] for s in found]
                place = pa.array((np.arange(passed, passed + len(texts)) % (1 << 16)).astype(np.int32))
                passed += len(texts)
                known = [part.column(0), *(pa.array(c, pa.int64()) for c in ([len(s) for s in found], [len(s) for s in low], names))]
                row = {"fragment": place, "bucket": place}
                yield pa.RecordBatch.from_arrays(
                    [*known, *(row[n] if n in row else pa.nulls(len(texts), t) for n, t in _SEGMENT_FIELDS)], names=[*_DOCUMENT, *(n for n, _ in _SEGMENT_FIELDS)]
                )
                for name, s in zip(names, low, strict=True):
                    if len(s) and name not in sets:
                        sets[name] = s
                        held += len(s)
                    if held >= PACKED:
                        yield from (_after_nulls(b, fields) for b in _pack_batch(sets, bits))
                        sets, held = {}, 0
        if sets:
            yield from (_after_nulls(b, fields) for b in _pack_batch(sets, bits))

    return run


def _packer(bits: int, wanted: np.ndarray | None = None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over texts: the segments of all shingles. Over texts and places of their keys: those above the low part, of the wanted ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sets, held = Shingler(), {}, 0
        for batch in batches:
            if wanted is not None:
                place = batch.column(1).to_numpy()
                batch = batch.filter(pa.array((wanted[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))
            for _, texts in slices(batch, 0):
                for text in texts:
                    found = shingle(text)
                    name = set_id(found)
                    if wanted is not None:
                        found = found[np.searchsorted(found, LOW) :]
                    if len(found) and name not in sets:
                        sets[name] = found
                        held += len(found)
                    if held >= PACKED:
                        yield from _pack_batch(sets, bits)
                        sets, held = {}, 0
        if sets:
            yield from _pack_batch(sets, bits)

    return run


def _join_fragment(fragment: int, bits: int, alone: list[tuple[bytes, bytes, bytes]], several: list[bytes]) -> list[tuple]:
    """Shared shingles of one fragment, as packed lists."""
    shingles = np.concatenate([_unpack(a) for a, _, _ in alone])
    owners = np.concatenate([np.repeat(np.frombuffer(o, dtype=np.int64), np.frombuffer(n, dtype=np.int32)) for _, o, n in alone])
    order = np.lexsort((owners, shingles))
    shingles, owners = shingles[order], owners[order]
    if len(shingles):
        fresh = np.append(True, (shingles[1:] != shingles[:-1]) | (owners[1:] != owners[:-1]))  # a set packed by several tasks
        shingles, owners = shingles[fresh], owners[fresh]
        same = shingles[1:] == shingles[:-1]
        shared = np.zeros(len(shingles), dtype=bool)
        shared[1:] |= same
        shared[:-1] |= same
        known = np.unique(_unpack(b"".join(several)))
        if len(known):
            at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
            shared |= known[at] == shingles
        shingles, owners = shingles[shared], owners[shared]
    if not len(shingles):
        return []
    return list(_lists(owners, shingles | (np.uint64(fragment) << np.uint64(8 * PACKED_BYTES)), bits))


def _fragment_joiner(bits: int, more: Sequence[str] = ()) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows sorted by fragment: one fragment is held at a time; packed lists pass, and rows with values in further columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, alone, several, fields = None, [], [], []
        for batch in batches:
            fields = [batch.schema.field(n) for n in more]
            known = batch.filter(batch.column("bucket").is_valid())
            if known.num_rows:
                yield known.select([*more, *(n for n, _ in _LIST_FIELDS)])
            packed = batch.filter(batch.column("bucket").is_null())
            for fragment, a, o, n, s in zip(*(packed.column(c).to_pylist() for c in ("fragment", "alone", "owners", "lengths", "several")), strict=True):
                if fragment != now and alone:
                    yield _after_nulls(_batch(_join_fragment(now, bits, alone, several), _LIST_FIELDS), fields)
                    alone, several = [], []
                now = fragment
                alone.append((a, o, n))
                several.append(s)
        if alone:
            yield _after_nulls(_batch(_join_fragment(now, bits, alone, several), _LIST_FIELDS), fields)

    return run


def _merge_bucket(lists: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
    """One list for each set of a bucket, in order and without repeats."""
    owners = np.concatenate([np.repeat(np.frombuffer(o, dtype=np.int64), np.frombuffer(n, dtype=np.int32)) for o, n, _ in lists])
    shingles = np.concatenate([np.frombuffer(x, dtype="<u8") for _, _, x in lists]).view(np.int64)
    order = np.lexsort((shingles, owners))
    owners, shingles = owners[order], shingles[order]
    fresh = np.append(True, (shingles[1:] != shingles[:-1]) | (owners[1:] != owners[:-1]))  # a set packed by several tasks
    owners, shingles = owners[fresh], shingles[fresh]
    names, starts = np.unique(owners, return_index=True)
    held = pa.ListArray.from_arrays(pa.array(np.append(starts, len(owners)), pa.int32()), pa.array(shingles))
    codes = shingles.view(np.uint64)
    bits = np.zeros(len(names) * SIGNATURE, dtype=np.uint64)
    word = np.repeat(np.arange(len(names)), np.diff(np.append(starts, len(owners)))) * SIGNATURE + ((codes >> np.uint64(6)) % np.uint64(SIGNATURE)).astype(np.int64)
    np.bitwise_or.at(bits, word, np.uint64(1) << (codes & np.uint64(63)))
    signs = pa.ListArray.from_arrays(pa.array(np.arange(len(names) + 1) * SIGNATURE, pa.int32()), pa.array(bits.view(np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(names), held, signs], names=["set_id", "held", "signature"])


def _merge_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by bucket: one bucket is held at a time."""
    now, lists = None, []
    for batch in batches:
        for bucket, *packed in zip(*(batch.column(n).to_pylist() for n, _ in _LIST_FIELDS), strict=True):
            if bucket != now and lists:
                yield _merge_bucket(lists)
                lists = []
            now = bucket
            lists.append(tuple(packed))
    if lists:
        yield _merge_bucket(lists)


def _count_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed lists to (set_id, shared), summed as they come: a set packed by several tasks may count shingles repeatedly."""
    parts, held = [], 0

    def summed() -> pa.RecordBatch:
        names, places = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = np.zeros(len(names), dtype=np.int64)
        np.add.at(sums, places, np.concatenate([p[1] for p in parts]))
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(sums)], names=["set_id", "shared"])

    for batch in batches:
        for names, counts in zip(batch.column("names").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            parts.append((np.frombuffer(names, dtype=np.int64), np.frombuffer(counts, dtype=np.int32)))
            held += len(parts[-1][0])
        if held >= PACKED:
            yield summed()
            parts, held = [], 0
    if parts:
        yield summed()


def _dealt(packed: DataFrame) -> DataFrame:
    return packed.repartition("fragment").sortWithinPartitions("fragment")


def low_part(df: DataFrame, key: str, text: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """Every document (_key, n_shingles, n_low, set_id), and packed lists of the shared shingles of the low part."""
    kind = df.schema[key].dataType.simpleString()
    picked = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text"))
    known = f"_key {kind}, n_shingles long, n_low long, set_id long"
    packed = map_arrow(picked, _low_packer(bits), f"{known}, {_SEGMENTS}")
    found = cut(map_arrow(_dealt(packed), _fragment_joiner(bits, _DOCUMENT), f"{known}, {_LISTS}"))
    return found.where("n_shingles is not null").select(_DOCUMENT), found.where("names is not null").select([n for n, _ in _LIST_FIELDS])


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BITS))


def _key_table(keys: DataFrame) -> np.ndarray:
    """The places of keys as a table of bits, of a fixed size however many they are."""
    place, table = _place(F.col("_key")) + 1, np.zeros(KEY_BITS // 8, dtype=np.uint8)
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    for part in parts.collect():  # 1 024 parts of 4 KB at most
        bits = np.frombuffer(part["bits"], dtype=np.uint8)
        table[(part["part"] - 1) * len(bits) : part["part"] * len(bits)] = bits
    return table


def shared_shingles(df: DataFrame, key: str, text: str, classes: DataFrame, lists: DataFrame, bits: int) -> DataFrame:
    """set_id, n, held, signature of the sets that can link: shingles that another set holds too, as 64-bit codes in order, and their bits.

    A set that lacks more of its low part than it may lack of the whole links with nothing.
    """
    by_bucket = lists.select("bucket", "names", "counts").repartition("bucket")  # a set is counted in one task, however many fragments it has
    shared = map_arrow(by_bucket, _count_lists, "set_id long, shared long").groupBy("set_id").agg(F.sum("shared").alias("shared"))
    able = cut(classes.join(shared, "set_id", "left").where(f"n_low - coalesce(shared, 0) <= n - {_needed('n')}").select("set_id", "n", F.col("first").alias("_key")))
    texts = df.select(F.col(f"`{text}`").cast("string").alias("_text"), _place(F.col(f"`{key}`")).alias("_place"))
    high = map_arrow(_dealt(map_arrow(texts, _packer(bits, _key_table(able)), _SEGMENTS)), _fragment_joiner(bits), _LISTS)
    dealt = lists.union(high).repartition("bucket").sortWithinPartitions("bucket")
    merged = map_arrow(dealt, _merge_buckets, "set_id long, held array<long>, signature array<long>")
    return merged.join(able.select("set_id", "n"), "set_id").where(f"size(held) >= {_needed('n')}").select("set_id", "n", "held", "signature")


def _needed(n: str) -> str:
    """Least overlap of a set of n shingles with any set it links with."""
    return f"({n} * 3 + 3) div 4"


def prefixes(sets: DataFrame) -> DataFrame:
    """shingle, set_id, n, shared (shingles of the set's shared part from this one on) for the prefix of every set that can still link."""
    each = sets.select("set_id", "n", F.explode("held").alias("shingle"))
    frequency = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = each.join(frequency, "shingle").groupBy("set_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("ranked"))
    able = ranked.where(f"size(ranked) >= {_needed('n')}")
    first = F.expr(f"slice(ranked, 1, cast(size(ranked) - {_needed('n')} + 1 as int))")
    entries = able.select("set_id", "n", F.size("ranked").alias("size"), F.posexplode(first).alias("place", "entry")).select(
        F.col("entry.shingle").alias("shingle"), "set_id", "n", F.expr("size - place").alias("shared")
    )
    # Two sets that link do so by their first common shingle: there, all that they share lies from it on. An entry
    # stays if it could be the first one with the smallest set that meets it there.
    smallest = entries.groupBy("shingle").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("sets")).where("sets > 1").drop("sets")
    return entries.join(smallest, "shingle").where("7 * shared >= 3 * (n + least)").drop("least")


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: overlap counted in each fragment, then summed."""
    left = segments.select(F.col("set_id").alias("a"), "fragment", F.col("n").alias("n_a"), F.col("held").alias("held_a"))
    right = segments.select(F.col("set_id").alias("b"), "fragment", F.col("n").alias("n_b"), F.col("held").alias("held_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("held_a", "held_b")).alias("both"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("both").alias("both"))
    return total.where("7 * both >= 3 * (n_a + n_b)").select("a", "b")  # 4 * both >= 3 * (n_a + n_b - both)


def _may_link(a: str, b: str) -> Column:
    """Whether the overlap can suffice if this shingle is the first common one: it is within the shared part of either set from there on."""
    return F.expr(f"7 * least(shared{a}, shared{b}) >= 3 * (n{a} + n{b})")


def _may_overlap(a: str, b: str) -> Column:
    """Whether the overlap can suffice by the signatures: what one set has and the other lacks is taken off all that the signature stands for."""

    def lacks(x: str, y: str) -> str:
        return " + ".join(f"bit_count(signature{x}[{k}] & ~signature{y}[{k}])" for k in range(SIGNATURE))

    return F.expr(f"7 * least(signed{a} - ({lacks(a, b)}), signed{b} - ({lacks(b, a)})) >= 3 * (n{a} + n{b})")


def _compare(group: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of a group that lie in different components, on both sides of it if it has sides, and can link by their bounds.

    Sets are in order of their components, large ones first, so that a set is held against those of later components only.
    """
    _, number, sizes = np.unique(group["label"], return_inverse=True, return_counts=True)
    order = np.lexsort((number, -sizes[number]))
    n, shared, signed, side = (group[c][order] for c in ("n", "shared", "signed", "side"))
    words = group["signature"][order]
    bits, by_word, ordered = np.bitwise_count(words).sum(axis=1, dtype=np.int64), np.ascontiguousarray(words.T), number[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    after = np.repeat(np.append(starts[1:], len(order)), np.diff(np.append(starts, len(order))))
    sided, begin = side.min() != side.max(), 0
    while begin < len(order) and after[begin] < len(order):
        first = after[begin]
        rows, columns = slice(begin, min(len(order), begin + max(1, COMPARED // (len(order) - first)))), slice(first, len(order))
        begin = rows.stop
        least = 3 * (n[rows, None] + n[None, columns])
        able = 7 * np.minimum(shared[rows, None], shared[None, columns]) >= least
        if rows.stop > first:
            able &= after[rows, None] <= np.arange(first, len(order))
        if sided:
            able &= side[rows, None] != side[None, columns]
        if not able.any():
            continue
        common = np.zeros(able.shape, dtype=np.int64)
        for word in by_word:
            common += np.bitwise_count(word[rows, None] & word[None, columns])
        lacking = np.minimum((signed - bits)[rows, None], (signed - bits)[None, columns]) + common
        i, j = np.nonzero(able & (7 * lacking >= least))
        if len(i):
            yield order[rows][i], order[columns][j]


def _group_comparer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by group (shingle, x, y): one group is held at a time; its pairs that can link."""

    def numbers(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        plain = {c: batch.column(c).to_numpy() for c in ("shingle", "x", "y", "set_id", "label", "n", "shared", "signed", "side")}
        return plain | {"signature": batch.column("signature").flatten().to_numpy().view(np.uint64).reshape(-1, SIGNATURE)}

    def compared(parts: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        group = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]} if len(parts) > 1 else parts[0]
        ids = group["set_id"]
        for i, j in _compare(group):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], names=["a", "b"])

    now, held = None, []
    for batch in batches:
        rows = numbers(batch)
        keys = np.stack([rows[c] for c in ("shingle", "x", "y")])
        cuts = np.append(np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))[: batch.num_rows], batch.num_rows)
        for begin, end in itertools.pairwise(cuts):
            if (key := tuple(keys[:, begin])) != now and held:
                yield from compared(held)
                held = []
            now = key
            held.append({c: v[begin:end] for c, v in rows.items()})
    if held:
        yield from compared(held)


def open_pairs(labelled: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs (a, b) that meet in a prefix shingle, lie in different components and can link by the bounds of their signatures.

    The sets of a shingle are compared in blocks; a shingle of many sets has several, and each pair of its blocks is a group of its own.
    """
    mixed = labelled.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).where("low <> high").select("shingle", "blocks")
    rest = labelled.join(mixed, "shingle").join(signatures, "set_id").withColumn("own", F.pmod(F.xxhash64("set_id", "shingle"), "blocks"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rest = rest.select("shingle", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "set_id", "label", *(F.col(c).cast("long").alias(c) for c in ("n", "shared", "signed")), F.col("own").alias("side"), "signature")
    dealt = rest.repartition("shingle", "x", "y").sortWithinPartitions("shingle", "x", "y")
    return map_arrow(dealt, _group_comparer, "a long, b long").distinct()


def _sized(df: DataFrame, width: Column | int) -> tuple[DataFrame, int]:
    """The same rows, written to the shared folder and read in as few tasks as their size (values a row) allows, and that size."""
    written = cut_estimates(df)
    values = int(written.agg(F.sum(F.lit(width) if isinstance(width, int) else width)).first()[0] or 0)
    tasks = values // TASK_VALUES + 1
    return written.coalesce(tasks) if tasks < written.rdd.getNumPartitions() else written, values


def _dense(df: DataFrame, width: Column | int) -> DataFrame:
    return _sized(df, width)[0]


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over all edges (x, y): every node and the smallest node of its component."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    x, y = (np.concatenate(c) for c in zip(*parts, strict=True))
    names, places = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = places[: len(x)], places[len(x) :]
    to = np.arange(len(names))
    while len(x):  # a tree's root takes the smallest root that an edge leads to, then trees become stars
        np.minimum.at(to, np.maximum(x, y), np.minimum(x, y))
        while (further := to[to] != to).any():
            to[further] = to[to[further]]
        x, y = to[x], to[y]
        x, y = x[x != y], y[x != y]
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[to])], names=["node", "to"])


def merge_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (set_id, label) after links (a, b): a component's label is its smallest set id.

    Components shrink to nodes and links to edges between them. Up to `EDGES` edges are followed in one task;
    of more, each node takes the smallest label around it, then the label of that label, until nothing changes.
    """
    of_a, of_b = (labels.select(F.col("set_id").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab")
    edges = links.join(of_a, "a").join(of_b, "b").where("label_a <> label_b").select(F.least("label_a", "label_b").alias("x"), F.greatest("label_a", "label_b").alias("y")).distinct()
    edges, values = _sized(edges, 2)
    if not values:
        return labels
    nodes = map_arrow(edges.coalesce(1), _contract, "node long, to long") if values <= 2 * EDGES else _settled(edges)
    joined = labels.join(nodes.withColumnRenamed("node", "label"), "label", "left")
    return _dense(joined.select("set_id", F.coalesce("to", "label").alias("label")), 2)


def _settled(edges: DataFrame) -> DataFrame:
    """Every node of the edges (x, y) and the smallest node of its component."""
    edges = _dense(edges.union(edges.select("y", "x")), 2)
    nodes = edges.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("to")).withColumnRenamed("x", "node")
    nodes = _dense(nodes, 2)
    while True:
        jumped = nodes.join(nodes.select(F.col("node").alias("to"), F.col("to").alias("further")), "to").select("node", F.col("to").alias("was"), F.col("further").alias("to"))
        around = edges.join(jumped.select(F.col("node").alias("y"), F.col("to").alias("seen")), "y").groupBy(F.col("x").alias("node")).agg(F.min("seen").alias("seen"))
        after = _dense(jumped.join(around, "node").select("node", "was", F.least("to", "seen").alias("to")), 3)
        nodes = after.select("node", "to")
        if after.where("was <> to").isEmpty():
            return nodes


def _open_pairs(labelled: DataFrame) -> int:
    """Pairs of sets that meet in a prefix shingle with different labels, counted without forming them."""
    each = labelled.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("k"))
    square = F.col("k").cast("double") * F.col("k")
    found = each.groupBy("shingle").agg(F.sum("k").cast("double").alias("all"), F.sum(square).alias("same")).agg(F.sum((F.col("all") * F.col("all") - F.col("same")) / 2)).first()[0]
    return int(found or 0)


def link_components(sets: DataFrame) -> DataFrame:
    """set_id, label for every set that some prefix brings together with another; sets are (set_id, n, held, signature)."""
    prefix, values = _sized(prefixes(sets), 4)
    signatures = sets.select("set_id", "signature", F.size("held").alias("signed"))
    of_a, of_b = (signatures.select(F.col("set_id").alias(x), F.col("signature").alias(f"signature_{x}"), F.col("signed").alias(f"signed_{x}")) for x in "ab")
    met = prefix.select("set_id").distinct()
    segments = sets.join(met, "set_id", "left_semi").select("set_id", "n", F.explode(F.sequence(F.lit(0), F.lit(COUNT_FRAGMENTS - 1))).alias("fragment"), "held")
    in_range = F.expr(f"filter(held, x -> pmod(shiftrightunsigned(x, {8 * PACKED_BYTES - 2}), {COUNT_FRAGMENTS}) = fragment)")
    segments = _dense(segments.select("set_id", "n", "fragment", in_range.alias("held")), F.size("held") + 3)
    labels = _dense(prefix.select("set_id", F.col("set_id").alias("label")).distinct(), 2)
    entries, before = values // 4, float("inf")
    for turn in itertools.count():
        labelled = prefix.join(labels, "set_id")
        still_open = _open_pairs(labelled)
        if still_open <= entries or 2 * still_open > before:
            break
        before = still_open
        order = F.xxhash64("set_id", F.lit(turn))  # other centres in each turn; shingles of one group mostly share theirs, so a set meets few
        centre = labelled.groupBy("shingle").agg(
            F.max(F.struct(order.alias("order"), F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("shared_b"), F.col("label").alias("label_b"))).alias("c"),
            F.min("label").alias("low"), F.max("label").alias("high"),
        )
        centre = centre.where("low <> high").select("shingle", "c.b", "c.n_b", "c.shared_b", "c.label_b")
        pairs = labelled.join(centre, "shingle").where(F.expr("label <> label_b") & _may_link("", "_b"))
        pairs = pairs.select(F.col("set_id").alias("a"), "b", F.col("n").alias("n_a"), "n_b").distinct()
        pairs = pairs.join(of_a, "a").join(of_b, "b").where(_may_overlap("_a", "_b")).select("a", "b")
        links, found = _sized(overlaps(pairs, segments), 2)
        if not found:
            break
        labels = merge_components(labels, links)
    labelled = prefix.join(labels, "set_id")
    pairs = _dense(open_pairs(labelled, signatures), 2)
    return merge_components(labels, overlaps(pairs, segments))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id (smallest key linked by a chain of links), set_id for every row."""
    total = (df.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0) // SHINGLE_BYTES
    bits = max(0, min(MOST_FRAGMENTS, -(-total // FRAGMENT)) - 1).bit_length()
    each, lists = low_part(df, key, text, bits)
    classes = each.where("set_id is not null").groupBy("set_id").agg(F.min("_key").alias("first"), F.first("n_shingles").alias("n"), F.first("n_low").alias("n_low"))
    labels = link_components(cut(shared_shingles(df, key, text, classes, lists, bits)))
    grouped = classes.join(labels, "set_id", "left").select("set_id", "first", F.coalesce("label", "set_id").alias("label"))
    lowest = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    known = grouped.join(lowest, "label").select("set_id", "component_id")
    some = each.where("set_id is not null").join(known, "set_id").select(F.col("_key").alias(key), "n_shingles", "component_id", "set_id")
    none = each.where("set_id is null").select(F.col("_key").alias(key), "n_shingles", F.col("_key").alias("component_id"), "set_id")
    return some.unionByName(none)


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of one document of each component, the one with the smallest key, with all their columns.

    Where keys repeat, a document is a key with a text: rows that repeat both leave one row, and no
    text goes because another one has its key. Rows without a key stay once for each text.
    """
    keyed, document = df.where(F.col(f"`{key}`").isNotNull()), "_keep_one_document"
    rows, ids, nulls = df.agg(F.count(f"`{key}`"), F.countDistinct(f"`{key}`"), F.count_if(F.col(f"`{key}`").isNull())).first()
    if rows == ids:
        kept = _firsts(keyed, key, text)
    else:
        digest = F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"))
        named = keyed.withColumn(document, F.struct(F.col(f"`{key}`").alias("key"), digest.alias("text")))
        kept = _firsts(named, document, text).dropDuplicates([document]).drop(document)
    return kept.unionByName(df.where(F.col(f"`{key}`").isNull()).dropDuplicates([text])) if nulls else kept


def _firsts(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows whose key is the smallest of its component."""
    near = cut(near_duplicates(df, key, text).select(F.col(f"`{key}`").alias("_id"), F.col("component_id").alias("_component")))
    gone = near.where("_id <> _component").select(F.col("_id").alias(key)).distinct()
    # Few ids go to every task, so that no text is shuffled; many are joined.
    return df.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, key, "left_anti").select(df.columns)

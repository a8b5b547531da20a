"""Near-duplicate documents: MinHash with banding, verified by signature and by full sets, then connected components.

1. Documents with the same set of shingles are one class; only its smallest id goes on.
2. A class has ``BANDS * ROWS`` minima of universal hashes. Classes that share a band are candidates. At the threshold a
   pair is missed with probability (1 - 0.8**4)**40, below 1e-9.
3. First each class is paired with one hub of its bucket, then with a second one if it is still in another component, so a
   large group costs a few pairs for each member. Pairs are verified by signature, then confirmed on full sets.
4. Members that are then still in different components meet in blocks. A block verifies by longer signatures, confirms on
   full sets, and hands on only links that join what was apart, so its rows never exceed its members.
5. Components are found by alternating large-star and small-star steps.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from trendloom.llm.frames import arrow_map, carried, column, portions, settled

BANDS, ROWS = 40, 4
#: Members of a bucket that are paired with all others before the rest is paired among itself.
HUBS = 2
#: Minima of the longer signatures, and bytes of the sets of a block.
LONG, BLOCK = 1024, 2 << 20
#: Members that are compared with one copy of their hub's set.
SPREAD = 2000
#: Bits for each document that may have a link, in a filter of at most 32 MB.
FILTER_BITS, MOST_BITS = 16, 1 << 28

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordIds(dict):
    """64-bit ids of words; forgotten when full, as they are the same again."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORD_IDS = _WordIds()


def shingles(text: str | None, size: int = 2) -> np.ndarray:
    """Sorted 64-bit ids of the distinct shingles of ``size`` words; with fewer words, of the whole sequence."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_WORD_IDS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(ids) - size + 1)
    mixed = np.full(n, min(size, len(ids)), np.uint64)
    for k in range(min(size, len(ids))):
        mixed = (mixed ^ ids[k : k + n]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


@lru_cache(maxsize=2)
def _family(minima: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift: the upper half of a * x + b is a universal hash."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, minima, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, minima, np.uint64)


def minima(ids: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    a, b = _family(count)
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(ids), 256):  # small enough for the cache
        np.minimum(least, (ids[start : start + 256, None] * a + b).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _signed(rows: Iterator[tuple], size: int) -> Iterable[tuple]:
    for key, text in rows:
        ids = shingles(text, size)
        if not len(ids):
            yield key, 0, b"", b"", []
            continue
        packed = ids.astype("<u8").tobytes()
        signature = minima(ids)
        bands = [xxhash.xxh64_intdigest(signature[i : i + ROWS].tobytes(), seed=i) - (1 << 63) for i in range(0, len(signature), ROWS)]
        yield key, len(ids), xxhash.xxh128_digest(packed), signature.astype(np.uint8).tobytes(), bands


def _marks(mark: Column, bits: int) -> list[Column]:
    """The two bits that the hash of a key sets among so many, a power of two."""
    return [mark.bitwiseAND(F.lit(bits - 1)), F.shiftright(mark, 32).bitwiseAND(F.lit(bits - 1))]


def possible(keys: DataFrame) -> bytes:
    """A filter that every ``key`` of this written table passes, and few others: two bits a key, ``MOST_BITS`` in all at most.

    It comes to the driver in pieces of 4 KB and goes to the tasks. Beyond its greatest size more and more others pass.
    """
    distinct = keys.agg(F.approx_count_distinct("key")).first()[0]
    bits = min(MOST_BITS, max(1 << 15, 1 << (FILTER_BITS * distinct).bit_length()))
    # The functions of Spark count places from 1.
    place = keys.select(F.explode(F.array(*[1 + m for m in _marks(F.xxhash64("key"), bits)])).alias("place"))
    pieces = place.groupBy(F.bitmap_bucket_number("place").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    found = bytearray(bits // 8)
    for row in pieces.toLocalIterator():
        found[4096 * (row["piece"] - 1) : 4096 * row["piece"]] = row["bitmap"]
    return bytes(found)


def _passing(rows: Iterator[tuple], bitmap: bytes) -> Iterable[tuple]:
    """What follows the ``mark`` of rows that pass the filter."""
    last = 8 * len(bitmap) - 1
    for mark, *row in rows:
        x, y = mark & last, mark >> 32 & last
        if bitmap[x >> 3] >> (x & 7) & bitmap[y >> 3] >> (y & 7) & 1:
            yield tuple(row)


def _sets(rows: Iterator[tuple], size: int, bitmap: bytes) -> Iterable[tuple]:
    for key, text in _passing(rows, bitmap):
        yield key, shingles(text, size).astype("<u8").tobytes()


def _lengthened(rows: Iterator[tuple], bitmap: bytes) -> Iterable[tuple]:
    for key, ids in _passing(rows, bitmap):
        yield key, ids, minima(np.frombuffer(ids, "<u8"), LONG).astype(np.uint8).tobytes()


def _agreement(percent: int, count: int) -> float:
    """Least share of equal minima, of a byte each: at the threshold it is below this, by six deviations, in one case of a billion."""
    return percent / 100 - 6 * (percent / 100 * (1 - percent / 100) / count) ** 0.5


def verified(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose signatures (``key, signature``) allow a link."""
    least = _agreement(percent, BANDS * ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for c in ("x", "y"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    both = pairs.join(signatures.select(F.col("key").alias("a"), F.col("signature").alias("x")), "a")
    both = both.join(signatures.select(F.col("key").alias("b"), F.col("signature").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _joining(table: pa.Table, percent: int) -> pa.Table:
    """Links of one block, or between two, that join components: a forest, so fewer than there are members."""
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    key, n, block = (table[c].to_numpy() for c in ("key", "n", "block"))
    names, part = np.unique(table["component"].to_numpy(), return_inverse=True)
    root = np.arange(len(names))
    signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, LONG)
    # Shingles as small numbers; the set of member i is codes[starts[i] : starts[i + 1]].
    words, codes = np.unique(np.frombuffer(b"".join(table["ids"].to_pylist()), "<u8"), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(n)])
    marked = np.zeros(len(words), np.int64)
    links: list[tuple[int, int]] = []
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    for i in left.tolist():
        others = right[right < i] if low == high else right
        near = others[(root[part[others]] != root[part[i]]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
        near = near[(signatures[near] == signatures[i]).mean(axis=1) >= _agreement(percent, LONG)]
        if not len(near):
            continue
        own = codes[starts[i] : starts[i + 1]]
        marked[own] = 1
        for j in near.tolist():
            if root[part[i]] != root[part[j]]:
                both = int(marked[codes[starts[j] : starts[j + 1]]].sum())
                if 100 * both >= percent * (n[i] + n[j] - both):
                    links.append((max(key[i], key[j]), min(key[i], key[j])))
                    root[root == root[part[j]]] = root[part[i]]
        marked[own] = 0
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def joining(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components of ``members`` (``key, n, bucket, component``), on full sets. ``members`` must be a written table.

    Members that reach each other by buckets are a group, and groups are dealt to blocks of bounded size. The largest
    component of a group has blocks of its own, which never meet each other. Two blocks meet in a task of their own, which
    gets the members that share a bucket with the other block, each once, however many buckets that is.
    """
    hubs = members.groupBy("bucket").agg(F.min("key").alias("b"))
    groups = components(members.join(hubs, "bucket").select(F.col("key").alias("a"), "b").distinct())
    grouped = settled(members.join(groups.select("key", F.col("component").alias("group")), "key"), "grouped")
    once = grouped.select("group", "key", "n", "component").distinct()
    parts = once.groupBy("group", "component").agg(F.sum("n").alias("size"))
    large = parts.groupBy("group").agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("size"))
    count = [F.ceil(8 * size / BLOCK).cast("int") for size in (F.col("top.size"), F.col("size") - F.col("top.size"))]
    large = large.select("group", F.col("top.component").alias("main"), count[0].alias("mains"), count[1].alias("others"))
    number = F.when(F.col("component") == F.col("main"), F.pmod(F.xxhash64("key"), F.col("mains"))).otherwise(F.col("mains") + F.pmod(F.xxhash64("key"), F.col("others")))
    dealt = grouped.join(large, "group").select("group", "key", "n", "component", "bucket", "mains", number.cast("int").alias("block"))
    dealt = settled(dealt, "dealt")
    met = dealt.select("bucket", F.col("block").alias("other")).distinct()
    rows = dealt.join(met, "bucket").where("block >= mains OR other >= mains")
    rows = rows.select("group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "key", "n", "component").distinct()
    # Where all of a meeting is of one component there is nothing to join.
    apart = rows.groupBy("group", "low", "high").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").drop("x", "y")
    rows = rows.join(apart, ["group", "low", "high"], "left_semi").join(sets, "key")
    return rows.groupBy("group", "low", "high").applyInArrow(lambda table: _joining(table, percent), "a long, b long")


def _close(a: str, b: str, percent: int) -> Column:
    """Sets of such different size can't be similar."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _linked(rows: Iterator[tuple], percent: int) -> Iterable[tuple]:
    hub = np.zeros(0, np.uint64)
    for a, b, ids in rows:
        found = np.frombuffer(ids, "<u8")
        if a is None:
            hub = found
            continue
        both = len(np.intersect1d(hub, found, assume_unique=True))
        if 100 * both >= percent * (len(hub) + len(found) - both):
            yield a, b


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full sets are similar. ``pairs`` must be a written table.

    ``b`` is a hub: its set goes before those of its members, once for each ``SPREAD`` of them, so that a task holds one set
    at a time and a hub of any number of members is spread.
    """
    spread = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SPREAD).alias("salts"))
    dealt = pairs.join(spread, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"))
    ends = dealt.select("a", "b", "salt", F.col("a").alias("key")).union(dealt.select(F.lit(None).cast("long"), "b", "salt", "b").distinct())
    sent = ends.join(sets, "key").select("a", "b", "salt", "ids").repartition("b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a"))
    return arrow_map(sent.select("a", "b", "ids"), _linked, "a long, b long", percent)


def components(links: DataFrame) -> DataFrame:
    """``key, component`` for every node of ``links`` (``a, b``): the smallest node that it reaches.

    A large-star step ties a node's larger neighbours to its smallest one, a small-star step its smaller ones. Minima are
    aggregated before the shuffle, so no neighbourhood is ever in one place.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        tied = ends.join(least, "u")
        if large:
            tied = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            tied = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(tied.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return tied.where("a <> b").distinct()

    def seen(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = settled(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = seen(edges)
    while before[0]:
        edges = settled(star(star(edges, True), False), "edges")
        now = seen(edges)
        if now == before:
            break
        before = now
    found = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "key")
    return found.union(found.select("component", "component").distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each document, whole texts compared.

    Documents with no word are linked with nothing. Rows without an id are left apart: they get no component and are kept.
    Rows that repeat an id are one document, with the greatest of their texts, and get one row. An empty table gives an
    empty table. Other columns are not read. ``docs`` should be a table, as it is read again for the sets.
    A very long text is one set, compared whole; a block of the last comparison may exceed its bytes by such a set.
    """
    rows = docs.select(column(key).cast("long").alias("key"), column(text).cast("string").alias("text"))
    known = rows.where("key IS NOT NULL")
    signed = settled(arrow_map(rows, _signed, "key long, n long, digest binary, signature binary, bands array<long>", size), "signatures", compression="zstd")
    single = signed.where("key IS NOT NULL")
    repeated = single.groupBy("key").count().where("count > 1").limit(1).count()
    if repeated:
        known = known.groupBy("key").agg(F.max("text").alias("text"))
        single = settled(arrow_map(known, _signed, signed.schema, size), "signatures", compression="zstd")

    # Classes of equal sets.
    classes = single.where("n > 0").groupBy("n", "digest").agg(F.min("key").alias("class"))
    classes = settled(classes, "classes")
    first = single.where("n > 0").groupBy("n", "digest").agg(F.min(F.struct("key", "bands")).alias("least")).select("least.key", "n", "least.bands")

    # Buckets of two classes or more. A window counts them, so that one exchange by bucket is all.
    buckets = first.select("key", "n", F.explode("bands").alias("bucket"))
    counted = buckets.withColumn("members", F.count(F.lit(1)).over(W.partitionBy("bucket")))
    shared = settled(counted.where("members > 1").select("key", "n", "bucket", "members"), "shared")
    # Texts are not shuffled to find those that are in a bucket; the few others that pass meet no member.
    mark, sharing = F.xxhash64("key").alias("mark"), possible(shared)
    sets = settled(arrow_map(known.select(mark, "key", "text"), _sets, "key long, ids binary", size, sharing), "shingle-sets", compression="zstd")

    # In each bucket one member after the other is paired with those still in other components: first the member that meets
    # the most others, which in a group of edited copies is the one they were made from.
    weight = shared.groupBy("key").agg(F.sum("members").alias("met"))
    members = settled(shared.join(weight, "key").select("key", "n", "bucket", F.struct("met", (-F.col("key")).alias("less")).alias("turn")), "members")
    signatures = settled(arrow_map(single.select(mark, "key", "signature"), _passing, "key long, signature binary", sharing), "shared-signatures")
    links = parts = None
    for _ in range(HUBS):
        hubs = members.groupBy("bucket").agg(F.max(F.struct("turn", "key", "n", "component") if parts is not None else F.struct("turn", "key", "n")).alias("hub"))
        pairs = members.join(hubs, "bucket").where(F.col("turn") < F.col("hub.turn"))
        pairs = pairs if parts is None else pairs.where(F.col("component") != F.col("hub.component"))
        pairs = pairs.where(_close("n", "hub.n", percent)).select(F.col("key").alias("a"), F.col("hub.key").alias("b")).distinct()
        pairs = settled(verified(pairs, signatures, percent), "hub-pairs")
        found = settled(confirmed(pairs, sets, percent), "links")
        links = found if links is None else links.union(found)
        parts = settled(components(links), "parts")
        # What stays open: members after the hub, in buckets where they are still in different components.
        rest = members.join(hubs.select("bucket", F.col("hub.turn").alias("hub_turn")), "bucket").where("turn < hub_turn").select("key", "n", "bucket", "turn")
        rest = rest.join(parts, "key", "left").withColumn("component", F.coalesce("component", "key"))
        open_ = rest.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
        members = settled(rest.join(open_, "bucket", "left_semi"), "members")

    # What is left meets in blocks.
    long = arrow_map(sets.select(mark, "key", "ids"), _lengthened, "key long, ids binary, signature binary", possible(members))
    long = settled(long, "long-signatures", compression="zstd")
    more = settled(joining(members, long, percent), "links")
    if more.limit(1).count():
        parts = settled(components(links.union(more)), "parts")

    result = single.join(classes, ["n", "digest"], "left").select("key", "n", F.coalesce("class", "key").alias("class"))
    result = result.join(parts.select(F.col("key").alias("class"), "component"), "class", "left")
    result = result.select(F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "class").alias("component_id"))
    apart = signed.where("key IS NULL").select(F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return result.union(apart).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the smallest id.

    Rows without an id stay. Rows that repeat an id are judged by their texts: each distinct id and text is a document of its
    own, and its rows stay or go together. Columns stay as they are.
    """
    body = column(text).cast("string")
    marked = carried(docs, key=column(key).cast("long"), digest=F.sha2(F.coalesce(body, F.lit("")).cast("binary"), 256))
    if not docs.select(column(key).cast("long").alias("key")).where("key IS NOT NULL").groupBy("key").count().where("count > 1").limit(1).count():
        gone = near_duplicates(docs, key, text, size, percent).where("NOT kept").select(F.col("doc_id").alias("key"))
        return marked.join(gone, "key", "left_anti").select("row.*")
    known = marked.where("key IS NOT NULL").groupBy("key", "digest").agg(F.max(F.col("row").getField(text).cast("string")).alias("body"))
    # Numbers in the order of the ids, so that the smallest number of a group is of its smallest id.
    units = known.repartitionByRange("key", "digest").sortWithinPartitions("key", "digest").withColumn("unit", F.monotonically_increasing_id())
    units = settled(units, "units", compression="zstd")
    lost = near_duplicates(units, "unit", "body", size, percent).where("NOT kept").select(F.col("doc_id").alias("unit"))
    gone = units.select("unit", "key", "digest").join(lost, "unit", "left_semi").select("key", "digest")
    return marked.join(gone, ["key", "digest"], "left_anti").select("row.*")

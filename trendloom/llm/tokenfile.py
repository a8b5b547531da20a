"""Token ids in files: canonical Huffman code of limited length from global counts, decoded by table in independent blocks.

A file holds a run of documents in ascending order of id. Its layout, all numbers little-endian:

    8 bytes   magic
    4 bytes   length of the header, then the header: JSON with the counts below
    zlib      length of the code of each id, one byte each; the canonical code follows from the lengths
    zlib      document ids (8 bytes), whether there is one (1 byte), number of ids (8 bytes), each as one run
    8 bytes   per block: the bit offset where the block starts; a block has up to ``block`` ids of one document
    payload   bits, most significant first; each document starts at a whole byte
    4 bytes   CRC-32 of all before
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from trendloom.llm.chunks import PORTION_TEXT, library_encoder
from trendloom.llm.frames import arrow_map, column, portions, read_file, settled, write_file
from trendloom.session import shared_folder

MAGIC = b"TIDHUF1\n"
#: Longest code in bits, ids in a block, ids after which a file ends.
LIMIT, BLOCK, FILE_IDS = 20, 512, 8_000_000
#: Ids that are coded or decoded at once.
PORTION = 1_000_000


# The code


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal code with no length over ``limit``, by merging packages; 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    packages, kinds = np.empty(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        ranked = np.argsort(both, kind="stable")
        kinds.append(ranked < len(leaves))
        both = both[ranked]
        packages = both[0 : len(both) // 2 * 2 : 2] + both[1::2]
    taken = 2 * len(leaves) - 2
    for is_leaf in reversed(kinds):
        own = int(is_leaf[:taken].sum())
        lengths[order[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint32)
    code, before = 0, 0
    for length in range(1, int(lengths.max(initial=0)) + 1):
        ids = np.flatnonzero(lengths == length)
        code <<= length - before
        before = length
        codes[ids] = code + np.arange(len(ids), dtype=np.uint32)
        code += len(ids)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For each value of the next ``width`` bits: id * 32 + length of its code."""
    width = max(1, int(lengths.max(initial=0)))
    table = np.zeros(1 << width, np.uint32)
    codes = canonical(lengths).astype(np.int64)
    used = np.flatnonzero(lengths)
    spans = np.left_shift(1, width - lengths[used].astype(np.int64))
    order = np.argsort(codes[used] * spans)
    filled = np.repeat(used[order].astype(np.uint32) << 5 | lengths[used][order], spans[order])
    table[: len(filled)] = filled
    return table, width


def pack(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray, block: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bits of several documents, bytes of each, and the bit offsets of their blocks, from the document's first bit."""
    entry = (codes.astype(np.int64) << 6 | lengths)[ids]
    bits = entry & 63
    if len(ids) and bits.min() == 0:
        raise ValueError("an id without a code")
    ends = np.concatenate([[0], np.cumsum(bits)])
    firsts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    in_bytes = (ends[firsts[1:]] - ends[firsts[:-1]] + 7) // 8
    starts = np.concatenate([[0], np.cumsum(in_bytes)])
    place = ends[:-1] + np.repeat(starts[:-1] * 8 - ends[firsts[:-1]], sizes)
    out = np.zeros(int(starts[-1]) // 4 + 3, np.uint32)
    if len(ids):
        # Codes that start within the same 32 bits are joined in 64.
        shift = 64 - bits
        shift -= place & 31
        word = (entry >> 6).view(np.uint64) << shift.view(np.uint64)
        at = place >> 5
        heads = np.flatnonzero(np.diff(at, prepend=-1))
        joined, at = np.bitwise_or.reduceat(word, heads), at[heads]
        out[at] = joined >> np.uint64(32)
        out[at + 1] |= joined.astype(np.uint32)
    blocks = -(-sizes // block)
    inside = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    offsets = place[np.repeat(firsts[:-1], blocks) + block * inside] - np.repeat(starts[:-1] * 8, blocks)
    return out.astype(">u4").tobytes()[: int(starts[-1])], in_bytes, offsets


def unpack(payload: np.ndarray, offsets: np.ndarray, counts: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    """Ids of blocks that start at these bits and hold so many ids: all blocks step by step together."""
    padded = np.concatenate([payload, np.zeros(8, np.uint8)]).astype(np.uint32)
    words = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    order = np.argsort(-counts, kind="stable")
    at, left = offsets[order].astype(np.int64), counts[order]
    target = (np.cumsum(counts) - counts)[order]
    out = np.empty(int(counts.sum()), np.uint32)
    live = np.searchsorted(-left, -np.arange(int(left.max(initial=0))), side="left")
    shift, mask = 32 - width, (1 << width) - 1
    for step, n in enumerate(live.tolist()):
        here = at[:n]
        entry = table[(words[here >> 3] >> (shift - (here & 7)).astype(np.uint32)) & mask]
        out[target[:n] + step] = entry >> 5
        here += entry & 31
    return out


# Files


def file_bytes(docs: list[tuple[int | None, int]], payload: bytes, blocks: np.ndarray, lengths: np.ndarray, block: int) -> bytes:
    """``docs``: id and number of ids of each document."""
    code = zlib.compress(lengths.tobytes())
    index = zlib.compress(
        np.array([d or 0 for d, _ in docs], "<i8").tobytes() + np.array([d is not None for d, _ in docs], "u1").tobytes() + np.array([n for _, n in docs], "<u8").tobytes()
    )
    head = json.dumps({"ids": sum(n for _, n in docs), "docs": len(docs), "blocks": len(blocks), "block": block, "code": len(code), "index": len(index), "payload": len(payload)}).encode()
    body = b"".join([MAGIC, struct.pack("<I", len(head)), head, code, index, blocks.astype("<u8").tobytes(), payload])
    return body + struct.pack("<I", zlib.crc32(body))


def read_documents(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """Id and token ids of each document of a file. Damage is an error."""
    if data[:8] != MAGIC or len(data) < 16 or zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("not a whole token file")
    size = struct.unpack("<I", data[8:12])[0]
    head = json.loads(data[12 : 12 + size])
    at = 12 + size
    lengths = np.frombuffer(zlib.decompress(data[at : at + head["code"]]), np.uint8)
    at += head["code"]
    index, n = zlib.decompress(data[at : at + head["index"]]), head["docs"]
    at += head["index"]
    keys, there, sizes = np.frombuffer(index, "<i8", n), np.frombuffer(index, "u1", n, 8 * n), np.frombuffer(index, "<u8", n, 9 * n).astype(np.int64)
    offsets = np.frombuffer(data, "<u8", head["blocks"], at).astype(np.int64)
    payload = np.frombuffer(data, np.uint8, head["payload"], at + 8 * head["blocks"])
    table, width = decoding_table(lengths)
    per_doc = -(-sizes // head["block"])
    counts = np.full(head["blocks"], head["block"], np.int64)
    last = np.cumsum(per_doc)[per_doc > 0] - 1
    counts[last] = sizes[per_doc > 0] - (per_doc[per_doc > 0] - 1) * head["block"]
    doc, done = 0, 0
    step = max(1, PORTION // head["block"])
    while doc < n:
        stop, blocks = doc, 0
        while stop < n and (stop == doc or blocks + per_doc[stop] <= step):
            blocks += int(per_doc[stop])
            stop += 1
        some = slice(done, done + blocks)
        first = int(offsets[done]) >> 3 if blocks else 0
        end = int(offsets[done + blocks]) >> 3 if done + blocks < len(offsets) else len(payload)
        ids = unpack(payload[first:end], offsets[some] - 8 * first, counts[some], table, width)
        borders = np.concatenate([[0], np.cumsum(sizes[doc:stop])])
        for i in range(stop - doc):
            yield int(keys[doc + i]) if there[doc + i] else None, ids[borders[i] : borders[i + 1]]
        doc, done = stop, done + blocks


# On Spark


def _tokenized(rows: Iterator[tuple], path: str, end: int | None) -> Iterable[tuple]:
    encode, dtype = library_encoder(path)
    tail = b"" if end is None else np.array([end], dtype).tobytes()
    for some in portions(rows, PORTION_TEXT):
        for (key, _), packed in zip(some, encode([text or "" for _, text in some])):
            ids = packed + tail
            # One plane for each byte of the ids: the planes compress better apart.
            yield key, np.frombuffer(ids, np.uint8).reshape(-1, dtype.itemsize).T.tobytes(), len(ids) // dtype.itemsize


def _ids(planes: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint32)
    raw = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(-1, n).T)
    return raw.view(f"<u{raw.shape[1]}").ravel().astype(np.uint32)


def tokenized(docs: DataFrame, path: str, end: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, planes, n`` of every whole text by the tokenizers library, without special tokens, then ``end``.

    Null texts are empty. Other columns are not read. No shuffle.
    """
    return arrow_map(docs.select(column(key).cast("long"), column(text).cast("string")), _tokenized, "doc_id long, planes binary, n long", path, end)


def _counted(rows: Iterator[tuple]) -> Iterable[tuple]:
    total = np.zeros(0, np.int64)
    for some in portions(rows, 2 * PORTION):
        more = np.bincount(np.concatenate([_ids(planes, n) for planes, n in some]))
        if len(more) > len(total):
            total, more = more.astype(np.int64), total
        total[: len(more)] += more
    for i in np.flatnonzero(total).tolist():
        yield i, int(total[i])


def global_counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs. One row for each id of the vocabulary comes to the driver, whatever the input."""
    each = arrow_map(tokens.select("planes", "n"), _counted, "id long, n long")
    found = each.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([0, *(r["id"] for r in found)]) + 1, np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    return counts


def _coded(rows: Iterator[tuple], lengths: bytes, block: int) -> Iterable[tuple]:
    of = np.frombuffer(lengths, np.uint8)
    codes = canonical(of)
    for some in portions(rows, 2 * PORTION):
        ids = [_ids(planes, n) for _, planes, n in some]
        sizes = np.array([len(i) for i in ids], np.int64)
        payload, in_bytes, offsets = pack(np.concatenate(ids), sizes, of, codes, block)
        blocks = -(-sizes // block)
        at, b = 0, 0
        for (key, _, n), size, count in zip(some, in_bytes.tolist(), blocks.tolist()):
            yield key, n, payload[at : at + size], offsets[b : b + count].astype("<u4").tobytes()
            at, b = at + size, b + count


def _written(rows: Iterator[tuple], folder: str, lengths: bytes, block: int, file_ids: int) -> Iterable[tuple]:
    of = np.frombuffer(lengths, np.uint8)
    docs: list[tuple] = []
    parts: list[bytes] = []
    blocks: list[np.ndarray] = []
    ids, size, part, seq = 0, 0, None, 0

    def close() -> tuple:
        name = f"part-{part:06d}-{seq:06d}.tid"
        data = file_bytes(docs, b"".join(parts), np.concatenate(blocks) if blocks else np.zeros(0, np.int64), of, block)
        return part, seq, write_file(folder, name, data), len(docs), ids

    for part, key, n, payload, offsets in rows:
        if docs and ids + n > file_ids:
            yield close()
            docs, parts, blocks, ids, size, seq = [], [], [], 0, 0, seq + 1
        docs.append((key, n))
        parts.append(payload)
        blocks.append(np.frombuffer(offsets, "<u4").astype(np.int64) + 8 * size)
        ids, size = ids + n, size + len(payload)
    if docs:
        yield close()


def _coded_files(rows: Iterator[tuple], folder: str, lengths: bytes, block: int, file_ids: int) -> Iterable[tuple]:
    """Codes and writes the documents of one partition, in their order."""
    rows = iter(rows)
    first = next(rows, None)
    if first is not None:
        part = first[0]
        coded = _coded((row[1:] for row in chain([first], rows)), lengths, block)
        yield from _written(((part, *row) for row in coded), folder, lengths, block, file_ids)


def write_tokens(tokens: DataFrame, folder: str, limit: int = LIMIT, block: int = BLOCK, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files in ascending order of document id and returns their list, with the ids before each file.

    ``tokens`` should be a written table: it is read for the counts and again for the coding. Documents without an id come
    first; equal ids stand in an order of their content. A file ends after ``file_ids`` ids, at the end of a document.
    No rows: no files. The list's running sum goes over one row for each file.
    """
    counts = global_counts(tokens)
    lengths = code_lengths(counts, limit).tobytes()
    parts = max(1, min(int(counts.sum()) // file_ids + 1, 1 << 16))
    # Ordered before they are coded: the sampling for ranges then costs a read and not a coding.
    files = arrow_map(
        in_order(tokens, parts).select(F.spark_partition_id().alias("part"), "doc_id", "planes", "n"),
        _coded_files, "part int, seq int, path string, n_docs long, n_ids long", folder, lengths, block, file_ids,
    )
    files = settled(files, "token-files")
    before = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def in_order(tokens: DataFrame, parts: int) -> DataFrame:
    tie = F.xxhash64("planes")
    return tokens.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)


def _read(rows: Iterator[tuple]) -> Iterable[tuple]:
    for path, start in rows:
        for key, ids in read_documents(read_file(path)):
            yield key, start, len(ids), ids.astype("<u4").tobytes()
            start += len(ids)


def read_tokens(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the listed files, ids as little-endian unsigned 32-bit numbers."""
    spread = files.select("path", "start").repartition(max(1, files.sparkSession.sparkContext.defaultParallelism), "path")
    return arrow_map(spread, _read, "doc_id long, start long, n_tokens long, ids binary")


def through_files(spark: SparkSession, docs: DataFrame, path: str, end: int | None = 0) -> DataFrame:
    """Tokenizes, writes the files, and reads them back."""
    tokens = settled(tokenized(docs, path, end), "tokens", compression="zstd")
    return read_tokens(write_tokens(tokens, shared_folder(spark, "tids")))

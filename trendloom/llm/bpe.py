"""Byte-level BPE by dynamic programming over prefixes.

Of the encoding of a prefix it is enough to know the last token: what stands before it is the encoding of the shorter
prefix. A sequence of tokens is an encoding exactly if each two neighbours are the encoding of their own bytes, as no
merge then ever crosses a border. So for each prefix there is one token that ends there and stands well after the last
token of the prefix it leaves. The table of last tokens grows by appending, and after an edit it is computed again only
from the edit to where it agrees with the old table.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from trendloom.llm.chunks import ChunkEncoder, Memo
from trendloom.llm.frames import arrow_map, column, portions

#: Pairs of tokens that a vocabulary remembers before it starts anew.
PAIRS = 400_000


class Vocabulary:
    """Tokens by rank. Every byte must be a token, and every longer token must arise from two tokens of lower rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        if len(self.tokens) != len(ranks):
            raise ValueError("two tokens have the same rank")
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        #: Every end of a token; the rank where it is a token itself, else -1.
        self.ends: dict[bytes, int] = {}
        #: A token's parts at its right and left edge, each with the rank of the merge that takes the part in.
        self.right: dict[int, list[tuple[bytes, int, float]]] = {}
        self.left: dict[int, list[tuple[bytes, int, float]]] = {}
        for token in sorted(ranks, key=len):
            rank = ranks[token]
            for i in range(len(token)):
                self.ends.setdefault(token[i:], -1)
            self.ends[token] = rank
            self.right[rank] = self.left[rank] = [(token, rank, float("inf"))]
            if len(token) > 1:
                halves = self._halves(token)
                if halves is None or max(halves) >= rank:
                    raise ValueError(f"{token!r} does not arise from two tokens of lower rank")
                below = [(t, r, min(by, rank)) for t, r, by in self.right[halves[1]]]
                self.right[rank] = self.right[rank] + below
                self.left[rank] = self.left[rank] + [(t, r, min(by, rank)) for t, r, by in self.left[halves[0]]]
        self.pairs: dict[int, bool] = {}

    def merged(self, data: bytes, until: int = 1) -> list[int]:
        """The definition: again and again the leftmost pair of lowest rank becomes one token."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > until:
            best = min(((r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: bytes) -> tuple[int, int] | None:
        halves = self.merged(token, until=2)
        return (halves[0], halves[1]) if len(halves) == 2 else None

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` are the encoding of their joined bytes: no merge over their border comes first."""
        key = left << 32 | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = not self._crossed(left, right)
        return found

    def _crossed(self, left: int, right: int) -> bool:
        ranks = self.ranks
        for a, made_a, taken_a in self.right[left]:
            for b, made_b, taken_b in self.left[right]:
                rank = ranks.get(a + b)
                if rank is None:
                    continue
                # The merge happens once both parts are there; of equal ranks the leftmost goes first.
                at = max(rank, made_a, made_b)
                if at < taken_a and at <= taken_b:
                    return True
        return False


def extend(vocabulary: Vocabulary, data: bytes, last: list[int], stop: int) -> None:
    """Adds the last tokens of the prefixes of ``data`` up to ``stop`` bytes."""
    ends, pairs, fits = vocabulary.ends, vocabulary.pairs, vocabulary.fits
    for end in range(len(last), stop + 1):
        for start in range(end - 1, -1, -1):
            token = ends.get(data[start:end])
            if token is None:
                raise AssertionError("every prefix has a last token")
            if token < 0:
                continue
            if start == 0:
                break
            before = last[start]
            good = pairs.get(before << 32 | token)
            if good or good is None and fits(before, token):
                break
        last.append(token)


def walk_back(vocabulary: Vocabulary, last: list[int]) -> list[int]:
    found, end, lengths = [], len(last) - 1, vocabulary.lengths
    while end:
        token = last[end]
        found.append(token)
        end -= lengths[token]
    found.reverse()
    return found


class PrefixTable:
    """The last token of every prefix of ``data``, which can grow and change."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last: list[int] = [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact, and only the new bytes are looked at."""
        self.data += more
        extend(self.vocabulary, bytes(self.data), self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Puts ``new`` in place of ``data[start:stop]``; returns how many positions were computed again."""
        start, stop, _ = slice(start, stop).indices(len(self.data))
        stop = max(start, stop)
        old = self.last[stop:]
        self.data[start:stop] = new
        data, last = bytes(self.data), self.last[: start + 1]
        shift, agreed, done = start + len(new), 0, 0
        for end in range(start + 1, len(data) + 1):
            extend(self.vocabulary, data, last, end)
            done += 1
            if end > shift:
                agreed = agreed + 1 if last[end] == old[end - shift] else 0
                if agreed >= self.vocabulary.longest:  # nothing after this can see further back
                    last += old[end - shift + 1 :]
                    break
        self.last = last
        return done

    def tokens(self) -> list[int]:
        return walk_back(self.vocabulary, self.last)


class Codec:
    """Texts to packed ids (little-endian unsigned 32-bit) and back. Matches of the pattern are encoded apart."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.matches = Memo(self._match)
        # Single spaces start a match in this family of patterns; any other pattern gets the whole text.
        spaced = " ?" in pattern and r"\s+(?!\S)|\s+" in pattern
        self.spaced = ChunkEncoder(self._matches, self._learn, spaced=True) if spaced else None
        self.bytes_of = [self.vocabulary.tokens.get(i) for i in range(max(self.vocabulary.tokens) + 1)]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        return self.spaced.many(texts) if self.spaced else [self._matches(t) for t in texts]

    def _matches(self, text: str) -> bytes:
        return b"".join(map(self.matches.__getitem__, self.pattern.findall(text)))

    def _learn(self, memo: Memo, words: list[str]) -> None:
        """Each word takes the prefix table of the one before it in order, up to where they differ."""
        vocabulary, ranks, last, before = self.vocabulary, self.vocabulary.ranks, [-1], b""
        for word in words:
            piece = b" " + word.encode("utf-8")
            rank = ranks.get(piece)
            if rank is not None:
                memo.put(word, rank.to_bytes(4, "little"))
                continue
            same = 0
            for a, b in zip(before, piece):
                if a != b:
                    break
                same += 1
            del last[same + 1 :]
            extend(vocabulary, piece, last, len(piece))
            ids = walk_back(vocabulary, last)
            memo.put(word, struct.pack(f"<{len(ids)}I", *ids))
            before = piece

    def _match(self, match: str) -> bytes:
        piece = match.encode("utf-8")
        rank = self.vocabulary.ranks.get(piece)
        if rank is not None:
            return rank.to_bytes(4, "little")
        last = [-1]
        extend(self.vocabulary, piece, last, len(piece))
        ids = walk_back(self.vocabulary, last)
        return struct.pack(f"<{len(ids)}I", *ids)

    def decode(self, packed: bytes) -> bytes:
        try:
            return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))
        except (IndexError, TypeError):
            raise ValueError("an id without a token") from None


class GrowingText:
    """A text with its encoding, which takes appended text without encoding the rest again."""

    #: A match depends on no more characters after its start than this, unless it runs to the end.
    AHEAD = 3

    def __init__(self, codec: Codec, text: str = ""):
        self.codec, self.text, self.open_from, self.done = codec, "", 0, b""
        self.append(text)

    def append(self, more: str) -> None:
        self.text += more
        closed = self.open_from
        parts = [self.done]
        for match in self.codec.pattern.finditer(self.text, self.open_from):
            if match.end() == len(self.text) or match.start() + self.AHEAD > len(self.text):
                break
            parts.append(self.codec._matches(match.group()))
            closed = match.end()
        self.done, self.open_from = b"".join(parts), closed

    def ids(self) -> bytes:
        return self.done + self.codec._matches(self.text[self.open_from :])


@lru_cache(maxsize=4)
def codec_of(path: str, pattern: str) -> Codec:
    """From a file of base64 tokens and ranks, once per worker."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, file))}
    return Codec(Vocabulary(ranks), pattern)


def _encoded(rows: Iterator[tuple], path: str, pattern: str, decoded: bool) -> Iterable[tuple]:
    codec = codec_of(path, pattern)
    for some in portions(rows):
        for (key, _), ids in zip(some, codec.encode_many([text or "" for _, text in some])):
            yield (key, ids, codec.decode(ids)) if decoded else (key, ids)


def _decoded(rows: Iterator[tuple], path: str, pattern: str) -> Iterable[tuple]:
    codec = codec_of(path, pattern)
    for key, ids in rows:
        yield key, ids, codec.decode(ids or b"")


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` of every whole text, ids packed as little-endian unsigned 32-bit numbers; no shuffle.

    Null and empty texts have no ids. Rows are encoded one by one: null and repeated keys keep their rows, other
    columns are not read. An empty table gives an empty table. ``path`` must be readable on the executors.
    """
    return arrow_map(docs.select(column(key).cast("long"), column(text).cast("string")), _encoded, "doc_id long, ids binary", path, pattern, False)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: encodes, and decodes the ids in the same worker, which so holds the vocabulary once."""
    rows = docs.select(column(key).cast("long"), column(text).cast("string"))
    return arrow_map(rows, _encoded, "doc_id long, ids binary, decoded binary", path, pattern, True)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``. Null ids give no bytes; an id without a token is an error."""
    return arrow_map(encoded.select("doc_id", "ids"), _decoded, "doc_id long, ids binary, decoded binary", path, pattern)

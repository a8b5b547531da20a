"""Encodes texts chunk by chunk, each distinct chunk once per worker."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks in one generation of what a worker remembers, and the longest one it remembers, in characters.
REMEMBERED, LONGEST = 500_000, 100
#: Of a library encoder: bytes of words, or of what follows them, and of their ids.
REMEMBERED_BYTES = 12 << 20
#: Characters of texts that are best given to a library encoder at once.
PORTION_TEXT = 8 << 20

#: A space that has white space or an end beside it.
_LOOSE = re.compile(r" (?:(?!\S)|(?<!\S ))")
_TIGHT = re.compile(r"(?<=\S) (?=\S)")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_LATIN = "".join(filter(_LETTERS.match, map(chr, range(256))))
#: A chunk of letters, and of letters and what follows them, if that is ASCII; for Arrow, which sees a column at a time.
_WORD_REST = r"(?s)\A(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>(?:[\x00-@\[-\x60{-\x7f].*)?)\z"
#: What some libraries take for white space and others don't.
_UNSURE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‍    　﻿]")


class Memo(dict):
    """Results by chunk, in two generations: when the young one is full it becomes the old one, and the old one goes.

    What is used stays, memory is bounded, and results never depend on what is remembered.
    """

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        value = self.old.get(chunk)
        if value is None:
            value = self.encode(chunk)
        self.put(chunk, value)
        return value

    def put(self, chunk: str, value: bytes) -> None:
        if len(chunk) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[chunk] = value

    def known(self, chunk: str) -> bool:
        return chunk in self or chunk in self.old


class ChunkEncoder:
    """Encodes texts from their chunks.

    With ``spaced``, for patterns in which a single space between two other characters always starts a match and belongs
    to it; else for tokenizers that drop white space and let nothing cross it. In both, letters and what follows them are
    matches of their own. ``learn(memo, words)`` puts new words, in order, into ``memo``, each with its space if ``spaced``.
    """

    def __init__(self, encode: Callable[[str], bytes], learn: Callable[[Memo, list[str]], None], spaced: bool):
        self.encode, self.learn, self.spaced = encode, learn, spaced
        self.first = Memo(encode)
        self.later = Memo(lambda chunk: encode(" " + chunk)) if spaced else self.first

    def _chunks(self, text: str) -> list[str] | None:
        if not self.spaced:
            return None if _UNSURE.search(text) else text.split()
        return _TIGHT.split(text) if _LOOSE.search(text) else text.split(" ")

    def many(self, texts: list[str]) -> list[bytes]:
        split = [self._chunks(t) for t in texts]
        seen: set[str] = set()
        for parts in split:
            seen.update(parts or ())
        found = self._found(seen).__getitem__
        first = self.first.__getitem__
        return [
            self.encode(text) if parts is None else b"".join(map(found, parts)) if not self.spaced else first(parts[0]) + b"".join(map(found, parts[1:]))
            for text, parts in zip(texts, split)
        ]

    def _found(self, seen: set[str]) -> dict[str, bytes]:
        """The ids of each chunk. Only words and what follows them are remembered, as their combinations are many."""
        words: set[str] = set()
        mixed, other = [], []
        for chunk in seen:
            end = m.end() if (m := _LETTERS.match(chunk)) else 0
            if end and end == len(chunk):
                words.add(chunk)
            elif end and chunk[end] < "\x80":
                mixed.append((chunk, chunk[:end], chunk[end:]))
                words.add(chunk[:end])
            else:
                other.append(chunk)
        first, later = self.first, self.later
        self.learn(later, sorted(w for w in words if not later.known(w)))
        found = {w: later[w] for w in words}
        for chunk in other:
            found[chunk] = later[chunk]
        for chunk, word, rest in mixed:
            found[chunk] = found[word] + first[rest]
        return found


class Columns:
    """The ids of strings as columns: strings met before, how many ids each has, and their ids one after the other.

    ``learn`` gives the last two for new strings. Beyond ``REMEMBERED_BYTES`` only the strings of the last call stay; results never
    depend on what is remembered.
    """

    def __init__(self, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]):
        self.learn = learn
        self.strings: pa.Array | None = None

    def of(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of these distinct strings has, and the ids."""
        if self.strings is None:
            self.strings, (self.lengths, self.ids) = strings, self.learn(strings)
            return self.lengths, self.ids
        at = pc.index_in(strings, value_set=self.strings)
        new = at.is_null()
        more = strings.filter(new)
        at = at.fill_null(0).to_numpy().copy()
        at[new.to_numpy(zero_copy_only=False)] = len(self.strings) + np.arange(len(more))
        lengths, ids = self.learn(more)
        self.strings = pa.concat_arrays([self.strings, more])
        self.lengths, self.ids = np.concatenate([self.lengths, lengths]), np.concatenate([self.ids, ids])
        places, _ = _places((np.cumsum(self.lengths, dtype=np.int64) - self.lengths).astype(np.int32)[at], self.lengths[at])
        lengths, ids = self.lengths[at], self.ids[places]
        if self.strings.nbytes + self.lengths.nbytes + self.ids.nbytes > REMEMBERED_BYTES:
            self.strings, self.lengths, self.ids = strings, lengths, ids
        return lengths, ids


class LibraryEncoder:
    """Texts to packed ids by the tokenizers library, with its own defaults, but for special tokens that it would add.

    The chunks of many texts are split, numbered and gathered as Arrow and numpy columns; Python handles each distinct chunk
    once a call. Words and what follows them are remembered. Which chunks can be encoded apart follows from the file's own
    splitting rule. Whole texts go to the library where a file has any other rule, and where a text may hold the string of a
    special token or white space on which libraries disagree.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Tasks are the parallel unit here; threads inside of them would only share the same cores.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.rule = _rule(path)
        self.lead = " " if self.rule == "spaced" else ""
        # Normalising may change letters of a special token's string but not two marks like these.
        marks = {t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, sorted(marks))), re.I) if marks else None
        if self.rule == "spaced":  # letters as the library's model takes them
            shown = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.shown = {ord(c): shown(c)[0][0] for c in _LATIN} | {ord(" "): " " + shown(" ")[0][0]}
        else:
            self.border = np.zeros(size, bool)
            for token, i in self.tokenizer.get_vocab().items():
                self.border[i] = token.endswith("</w>")
        self.words, self.rests = Columns(self._word_ids), Columns(lambda rests: self._packed(self._filled(rests)))

    def each(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, or of chunks as if they were."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _by_chunks(self, text: str) -> bool:
        if self.rule is None or (self.special and self.special.search(text)):
            return False
        return self.rule == "spaced" or not _UNSURE.search(text)

    def many(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain, loose, whole = [], [], []
        for i, text in enumerate(texts):
            if not self._by_chunks(text):
                whole.append(i)
            elif self.rule == "spaced" and _LOOSE.search(text):
                loose.append(i)
            else:
                plain.append(i)
        for i in whole:
            out[i] = self.each([texts[i]])[0]
        split = pc.split_pattern(pa.array([texts[i] for i in plain], pa.string()), " ") if self.rule == "spaced" else (
            pc.ascii_split_whitespace(pa.array([texts[i] for i in plain], pa.string()))
        )
        cut = pa.array([_TIGHT.split(texts[i]) for i in loose], pa.list_(pa.string()))
        for places, lists in ((plain, split), (loose, cut)):
            if places:
                for i, ids in zip(places, self._gathered(lists)):
                    out[i] = ids
        return out

    def _gathered(self, lists: pa.ListArray) -> Iterator[bytes]:
        """The ids of each list of chunks."""
        starts = lists.offsets.to_numpy().astype(np.int64)
        numbered = lists.flatten().dictionary_encode()
        which = numbered.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        starts -= starts[0]
        chunks = numbered.dictionary
        lengths, ids = self._chunk_ids(chunks)
        if self.lead:  # the first chunk of a text has no space before it
            firsts = self.each(chunks.take(pa.array(which[starts[:-1]])).to_pylist())
            which[starts[:-1]] = len(lengths) + np.arange(len(firsts), dtype=np.int32)
            more, own = self._packed(firsts)
            lengths, ids = np.concatenate([lengths, more]), np.concatenate([ids, own])
        item = self.dtype.itemsize
        begins = (np.cumsum(lengths, dtype=np.int64) - lengths).astype(np.int32)  # a call's distinct chunks are far fewer
        for low, high in _stretches(starts):
            some = which[starts[low] : starts[high]]
            at, ends = _places(begins[some], lengths[some])
            packed = ids[at].tobytes()
            borders = np.concatenate([[0], ends])[starts[low : high + 1] - starts[low]] * item
            for a, b in zip(borders.tolist(), borders[1:].tolist()):
                yield packed[a:b]

    def _packed(self, entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each entry has, and the ids."""
        lengths = np.fromiter(map(len, entries), np.int32, len(entries)) // self.dtype.itemsize
        return lengths, np.frombuffer(b"".join(entries), self.dtype)

    def _filled(self, chunks: pa.Array, lead: str = "") -> list[bytes]:
        """Ids of chunks by the library; of nothing, nothing."""
        texts = [lead + c for c in chunks.to_pylist()]
        found = iter(self.each([t for t in texts if t]))
        return [next(found) if t else b"" for t in texts]

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each distinct chunk has, and the ids, with the space before it where that belongs to it.

        Distinct words and rests are encoded once; a chunk is a word and a rest, or a chunk that is encoded whole and no rest.
        """
        cut = pc.extract_regex(chunks, _WORD_REST)
        whole = cut.is_null().to_numpy(zero_copy_only=False)
        words, rests = (cut.field(i).filter(pa.array(~whole)).dictionary_encode() for i in (0, 1))
        others = chunks.filter(pa.array(whole))
        columns = [self.words.of(words.dictionary), self._packed(self._filled(others, self.lead)), self.rests.of(rests.dictionary)]
        # The first half of a chunk, then the second; the last entry is nothing.
        lengths = np.concatenate([*(n for n, _ in columns), np.zeros(1, np.int32)])
        ids = np.concatenate([i for _, i in columns])
        parts = np.full((len(chunks), 2), len(lengths) - 1, np.int32)
        parts[~whole, 0] = words.indices.to_numpy()
        parts[whole, 0] = len(words.dictionary) + np.arange(len(others))
        parts[~whole, 1] = len(words.dictionary) + len(others) + rests.indices.to_numpy()
        begins = (np.cumsum(lengths, dtype=np.int64) - lengths).astype(np.int32)
        some = parts.ravel()
        at, _ = _places(begins[some], lengths[some])
        return lengths[parts[:, 0]] + lengths[parts[:, 1]], ids[at]

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids, as the library's model gives them for letters with the space before them.

        Where the file has another rule many words are one text, cut where a token ends a word.
        """
        if not len(words):
            return self._packed([])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()
        if self.rule == "spaced":
            tokenize = self.tokenizer.model.tokenize
            found = [[token.id for token in tokenize(word)] for word in (" " + joined).translate(self.shown)[1:].split(" ")]
            lengths = np.fromiter(map(len, found), np.int32, len(found))
            return lengths, np.fromiter(chain.from_iterable(found), self.dtype, int(lengths.sum()))
        texts = joined.split(" ")
        counted, packed = [], []
        for i in range(0, len(texts), 2000):
            some = texts[i : i + 2000]
            ids = np.frombuffer(self.each([" ".join(some)])[0], self.dtype)
            lengths = np.diff(np.flatnonzero(self.border[ids]) + 1, prepend=0).astype(np.int32)
            if len(lengths) != len(some):  # a word that the tokenizer splits or changes: one by one
                lengths, ids = self._packed(self.each(some))
            counted.append(lengths)
            packed.append(ids)
        return np.concatenate(counted), np.concatenate(packed)


def _places(begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the ids of some entries lie, entry after entry, and where each entry ends among them."""
    ends = np.cumsum(lengths, dtype=np.int64)
    at = np.repeat(begins - (ends - lengths).astype(np.int32), lengths)
    at += np.arange(len(at), dtype=np.int32)
    return at, ends


def _stretches(starts: np.ndarray, chunks: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Lists ``low`` to ``high`` with about so many chunks, one list at least."""
    low, n = 0, len(starts) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + chunks, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


@lru_cache(maxsize=2)
def _library(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def library_encoder(path: str) -> tuple[Callable[[list[str]], list[bytes]], np.dtype]:
    """Texts to packed ids by the tokenizers library, without added special tokens, and the type of the packed ids."""
    encoder = _library(path)
    return encoder.many, encoder.dtype


def _rule(path: str) -> str | None:
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    byte_level = next((s for s in steps if s.get("type") == "ByteLevel"), None)
    if byte_level is None or byte_level["add_prefix_space"]:
        return None
    if spec.get("normalizer") is None and len(steps) == 1 and byte_level["use_regex"]:
        return "spaced"
    normal = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = steps[0]
    if split.get("type") == "Split" and split["invert"] and split["behavior"] == "Removed" and normal == ["NFC", "Replace", "Lowercase"]:
        return "words" if _drops_space(split["pattern"]["Regex"]) else None
    return None


def _drops_space(pattern: str) -> bool:
    import regex

    return not regex.search(pattern, " \t\n\x0b\x0c\r") and not any(" " in m for m in regex.findall(pattern, "a b 1 2 ! ? 's ' s"))

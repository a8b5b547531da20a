"""The parts of the operators apart from Spark, and the pipeline from end to end."""

import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tests.llm import models
from tests.llm.test_contracts import awkward, check_packing, rows_of, source
from trendloom.llm import bpe, packing, quality, surrogates, tokenfile, warc

CODEC = bpe.codec_of(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
TEXTS = st.text(alphabet="ab thew'srel\n\t 12.!éß日\x1c\x85\xa0", max_size=60)


# Byte-level BPE


def own_tiktoken():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=CODEC.vocabulary.ranks, special_tokens={})


OWN = own_tiktoken()


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_encode_and_decode(text):
    packed = CODEC.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == OWN.encode_ordinary(text)
    assert CODEC.decode(packed) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_growing_text(parts):
    grown = bpe.GrowingText(CODEC)
    for i, part in enumerate(parts):
        grown.append(part)
        assert np.frombuffer(grown.ids(), "<u4").tolist() == OWN.encode_ordinary("".join(parts[: i + 1]))


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80), st.binary(max_size=20), st.integers(0, 80), st.integers(0, 80))
def test_edited_bytes(data, new, start, stop):
    table = bpe.PrefixTable(CODEC.vocabulary, data)
    assert table.tokens() == CODEC.vocabulary.merged(data)
    table.replace(start, stop, new)
    stop = max(min(start, len(data)), stop)
    edited = data[:start] + new + data[stop:]
    assert bytes(table.data) == edited and table.tokens() == CODEC.vocabulary.merged(edited)


def test_an_edit_is_local():
    text = ("the quick brown fox jumps over the lazy dog " * 200).encode()
    table = bpe.PrefixTable(CODEC.vocabulary, text)
    assert table.replace(4000, 4003, b"cat") < 200
    assert table.tokens() == bpe.PrefixTable(CODEC.vocabulary, text[:4000] + b"cat" + text[4003:]).tokens()


def test_pairs_by_definition():
    v, rng = CODEC.vocabulary, random.Random(5)
    tokens = sorted(v.tokens)
    for _ in range(3000):
        a, b = rng.choice(tokens[:4000]), rng.choice(tokens[:4000])
        assert v.fits(a, b) == (v.merged(v.tokens[a] + v.tokens[b]) == [a, b])
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0})


# Token files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=40), min_size=1, max_size=8), st.integers(9, 20), st.integers(1, 9))
def test_token_file(docs, limit, block):
    ids = np.array([i for d in docs for i in d], np.int64)
    lengths = tokenfile.code_lengths(np.bincount(ids, minlength=301), limit)
    assert lengths.max(initial=0) <= limit and (2.0 ** -lengths[lengths > 0].astype(float)).sum() <= 1
    sizes = np.array([len(d) for d in docs])
    payload, in_bytes, offsets = tokenfile.pack(ids, sizes, lengths, tokenfile.canonical(lengths), block)
    starts, n = np.concatenate([[0], np.cumsum(in_bytes)])[:-1], -(-sizes // block)
    data = tokenfile.file_bytes([(i or None, len(d)) for i, d in enumerate(docs)], payload, offsets + np.repeat(starts * 8, n), lengths, block)
    assert [(k, v.tolist()) for k, v in tokenfile.read_documents(data)] == [(i or None, d) for i, d in enumerate(docs)]
    with pytest.raises(ValueError):
        list(tokenfile.read_documents(data[:-9] + bytes([data[-9] ^ 1]) + data[-8:]))


def test_code_is_optimal_without_a_limit():
    import heapq

    rng = np.random.default_rng(2)
    counts = rng.integers(1, 1000, 200)
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], 0))
    assert int((counts * tokenfile.code_lengths(counts, 30)).sum()) == cost
    with pytest.raises(ValueError):
        tokenfile.code_lengths(counts, 7)


# Archives


def archive(n=6, size=3000):
    pages = [(i, f"https://example.com/{i}?a=b c", (f"<p>{i}</p>" * (size // 8)).encode(), None) for i in range(n)]
    return [warc.page_record(p, u, b, r, "2000-01-01T00:00:00Z") for p, u, b, r in pages]


def ids_of(found):
    return [warc.page_of(x[3][0]["warc-record-id"]) for x in found if x[0] == "record"]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_after_damage(packed):
    records = [warc.member(r) if packed else r for r in archive()]
    whole = b"".join(records)
    found = list(warc.salvage(whole))
    assert ids_of(found) == list(range(6)) and all(x[0] == "record" for x in found)
    borders = np.concatenate([[0], np.cumsum([len(r) for r in records])])
    for at in range(0, len(whole), max(1, len(whole) // 60)):
        broken = bytearray(whole)
        broken[at] ^= 0xFF
        hit = int(np.searchsorted(borders, at, side="right")) - 1
        found = list(warc.salvage(bytes(broken)))
        assert set(ids_of(found)) >= set(range(6)) - {hit}
        spans = [(x[1], x[2]) for x in found]
        assert spans[0][0] == 0 and spans[-1][1] == len(whole) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    cut = list(warc.salvage(b"junk" + whole[:-10]))
    assert ids_of(cut) == list(range(5)) and [x[0] for x in cut][0] == "gap" and cut[-1][0] == "gap"
    assert list(warc.salvage(b"")) == []
    lost_middle = records[0] + records[1][: len(records[1]) // 2] + records[2]
    assert ids_of(warc.salvage(lost_middle)) == [0, 2]


def test_salvage_inside_a_member():
    """One bad record in a member of many costs that record alone."""
    records = archive()
    for hit in range(6):
        some = list(records)
        some[hit] = some[hit].replace(b"<p>", b"<q>", 1)
        for data, n in ((warc.member(b"".join(some)), 1), (b"junk" + warc.member(b"".join(some)) + warc.member(records[0]), 2)):
            found = list(warc.salvage(data))
            assert ids_of(found)[:5] == [i for i in range(6) if i != hit] and len(ids_of(found)) == 4 + n
            start = sum(map(len, records[:hit]))
            assert [x[3] for x in found if x[0] == "gap"][-1].endswith(f"inflated bytes {start} to {start + len(records[hit])}")
    assert [x[0] for x in warc.salvage(warc.member(b""))] == ["gap"]
    assert list(warc.salvage(b"WARC/1.1\r\nWARC-Type: response")) == [("gap", 0, 29, "damaged record")]


def test_long_headers_are_read_and_lost_records_are_errors(spark, tmp_path):
    pages = spark.createDataFrame([(1, "ü" * 400_000, "a"), (2, "u", "b")], "page_id long, url string, html string")
    got = {r.page_id: len(r.url) for r in warc.through_archives(spark, pages).collect()}
    assert got == {1: 6 * 400_000, 2: 1}
    files = warc.write_archives(pages, str(tmp_path / "w"))
    assert warc.read_archives(files, strict=True).count() == 2 + files.count()
    with pytest.raises(Exception, match="records were written"):
        warc.read_archives(files.selectExpr("path", "records + 1 AS records"), strict=True).count()


def test_archives_awkward(spark, tmp_path):
    long = "x" * 1200
    rows = [(1, "u", long), (2, None, long), (3, "a\r\nb: c", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "u", long), (7, "ü", "é" * 600), (8, "ü", "é" * 600)]
    pages = spark.createDataFrame([(p, u, h, "r") for p, u, h in rows], "page_id long, url string, html string, payload string")
    files = warc.write_archives(pages, str(tmp_path / "w"), file_bytes=2000)
    records = warc.read_archives(files)
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.pages_of(records).collect()}
    assert got == {
        1: ("revisit", 3, 1200), 2: ("revisit", 3, 1200), 3: ("response", None, 1200), 4: ("response", None, 5), 5: ("response", None, 5), 6: ("response", None, 0),
        None: ("response", None, 1200), 7: ("revisit", 8, 1200), 8: ("response", None, 1200),
    }
    assert warc.gaps_of(records).count() == 0
    path = files.where("records > 0").first().path
    data = bytearray(open(path.removeprefix("file://"), "rb").read())
    data[len(data) // 2] ^= 0xFF
    open(path.removeprefix("file://"), "wb").write(data)
    assert warc.gaps_of(warc.read_archives(files)).count() >= 1
    assert warc.pages_of(warc.read_archives(warc.write_archives(pages.limit(0), str(tmp_path / "e")))).count() == 0


# Packing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 9), st.integers(2, 9))
def test_plan_places_all(lengths, groups, part):
    counts = np.bincount(np.array(lengths, np.int64), minlength=41)
    rules = packing.plan(counts, 40, ((groups, part),))
    by_length, by_sequence = {}, {}
    for r in rules:
        by_length.setdefault(r.length, []).append((r.rank, r.count))
        for i in range(r.count):
            by_sequence.setdefault(r.sequence + i, []).append((r.offset, r.length))
    for n, some in by_length.items():
        at = 0
        for rank, count in sorted(some):
            assert rank == at
            at += count
        assert at == counts[n]
    assert sum(map(len, by_sequence.values())) == len(lengths)
    for some in by_sequence.values():
        at = 0
        for offset, n in sorted(some):
            assert offset == at
            at += n
        assert at <= 40


def test_plan_is_near_the_best():
    rng = np.random.default_rng(4)
    counts = np.bincount(np.minimum(4096, rng.lognormal(6.4, 1.1, 30_000).astype(int) + 1), minlength=4097)
    least = -(-int((np.arange(4097) * counts).sum()) // 4096)
    assert max(r.sequence + r.count for r in packing.plan(counts)) <= 1.002 * least


# The pipeline


def test_pipeline_by_stage(spark, sf_dir):
    docs = source(spark, sf_dir)
    columns = docs.columns
    judged = quality.judged(docs, quality.trusted_of(source(spark, sf_dir, "labels"))).select("row.doc_id", "kept").collect()
    one = corpus_pipeline.settled(corpus_pipeline.quality_rules(spark, docs, sf_dir), "t1")
    assert one.columns == columns and {r.doc_id for r in one.collect()} == {r.doc_id for r in judged if r.kept}
    two = corpus_pipeline.settled(corpus_pipeline.line_dedup(spark, one, sf_dir), "t2")
    want = models.line_dedup([(r.doc_id, r.text) for r in one.collect()])
    assert two.columns == columns and {r.doc_id: r.text for r in two.collect()} == {d: t for d, (_, _, t) in want.items()}
    three = corpus_pipeline.settled(corpus_pipeline.minhash_dedup(spark, two, sf_dir), "t3")
    groups = models.near_duplicates([(r.doc_id, r.text) for r in two.collect()], 5)
    assert three.columns == columns and {r.doc_id for r in three.collect()} == {d for d, (_, c) in groups.items() if d == c}
    four = corpus_pipeline.settled(corpus_pipeline.surrogate_pii(spark, three, sf_dir), "t4")
    before, after = {r.doc_id: r for r in three.collect()}, {r.doc_id: r for r in four.collect()}
    assert four.columns == columns and set(before) == set(after)
    for d, r in after.items():
        assert len(surrogates.entities(r.text)) == len(surrogates.entities(before[d].text)) and r.n_chars == len(r.text)
        if not surrogates.entities(before[d].text):
            assert r.text == before[d].text
    five = rows_of(corpus_pipeline.best_fit_packing(spark, four, sf_dir))
    check_packing(five, [(r.doc_id, r.text) for r in after.values()], 4096)
    assert {r[:5] for r in rows_of(corpus_pipeline.run(spark, sf_dir))} == {r[:5] for r in five}


def test_stages_on_awkward_and_empty_tables(spark, sf_dir):
    for rows in (None, []):
        docs = awkward(spark) if rows is None else awkward(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.settled(stage(spark, docs, sf_dir), "awkward")
            assert name == "best-fit packing" or docs.columns == awkward(spark).columns


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_are_cut_into_words_and_rests_as_columns(name):
    import public_tokenizers
    import pyarrow as pa

    from trendloom.llm.chunks import LibraryEncoder

    encoder = LibraryEncoder(public_tokenizers.path(name))
    odd = ["abc", "abc,", "abc,d", "été!", "été", "don't", "ab中", "ab中c.", "中", ",", "1a", "a\n", "a\nb", "\n", "x×y", "a×", "Ab12", "a\x7f", "", "straße-1", "aé", "{a}", "a{", "a`b"]
    chunks = [c for c in odd if encoder.lead or not any(s in c for s in "\n")]
    lengths, ids = encoder._chunk_ids(pa.array(chunks))
    want = [encoder.each([encoder.lead + c])[0] if c or encoder.lead else b"" for c in chunks]
    ends = lengths.cumsum()
    assert [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist())] == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("remembered", [None, 0, 3000])
def test_words_are_remembered_as_columns(name, remembered, monkeypatch):
    from itertools import islice, product

    from trendloom.llm import chunks

    if remembered is not None:
        monkeypatch.setattr(chunks, "REMEMBERED_BYTES", remembered)
    encoder = chunks.LibraryEncoder(P.path(name))
    learned, learn = [], encoder.words.learn
    encoder.words.learn = lambda words: learned.extend(words.to_pylist()) or learn(words)
    # More words between the first texts and their return than two generations of 20 MB held.
    words = ["".join(w) for w in islice(product("étaoinshrdlucmfwypvbgkjqxzÉÀß", repeat=4), 300_000 if remembered is None else 500)]
    parts = [words[i::5] for i in range(5)]
    texts = [[" ".join(p[i : i + 50]) + ".\nEnd, été" for i in range(0, len(p), 50)] for p in [*parts, parts[0]]]
    for some in texts:
        assert encoder.many(some) == encoder.each(some)
    assert remembered is not None or len(learned) == len(set(learned))


def test_codes_of_all_lengths_are_packed():
    rng = np.random.default_rng(3)
    lengths = tokenfile.code_lengths(np.array([1 << min(i, 40) for i in range(30)] + [1] * 2000), 20)
    assert (lengths.min(), lengths.max()) == (1, 20) and len(set(lengths.tolist())) > 12
    sizes = rng.integers(0, 1500, 40)
    ids = rng.integers(0, len(lengths), int(sizes.sum()))
    codes = tokenfile.canonical(lengths)
    payload, in_bytes, offsets = tokenfile.pack(ids, sizes, lengths, codes, 512)
    bits = [f"{codes[i]:0{lengths[i]}b}" for i in ids.tolist()]
    borders = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    docs = ["".join(bits[a:b]) for a, b in zip(borders, borders[1:])]
    whole = "".join(d + "0" * (-len(d) % 8) for d in docs)
    assert payload == bytes(int(whole[i : i + 8], 2) for i in range(0, len(whole), 8))
    assert in_bytes.tolist() == [-(-len(d) // 8) for d in docs]
    assert offsets.tolist() == [sum(map(len, bits[a:i])) for a, b in zip(borders, borders[1:]) for i in range(a, b, 512)]

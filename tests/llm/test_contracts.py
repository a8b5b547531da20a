"""The registered queries against plain models, and SQL, on the smallest tables and on awkward ones."""

import base64
import collections
import functools
import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tests.compare import compare, tables
from tests.llm import models
from trendloom.llm import linededup, minhash, packing, quality, sharding, surrogates, tokenfile, topk, warc
from trendloom.llm.queries import ORACLES, QUERIES, SHARDS

LONG = "word " * 30_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, `a.b` int"
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, LONG), (7, LONG), (8, "a b c d e f g h i j k"), (9, "a b c d e f g h i j k l"),
    (10, "The same long line of text here\nx"), (11, "y\n  the SAME long line of text here  "), (12, "The same long line of text here"),
    (13, "naïve Ünïcode 日本語 \x1c x\x85y\xa0z 's 'll"), (None, "The same long line of text here"), (14, "mail a.b@example.com or A.B@example.com, call +1 (487) 555-7209"),
    (15, "a <|endoftext|> b <|ENDOFTEXT|>x"),
]


def awkward(spark, rows=AWKWARD):
    return spark.createDataFrame([(d, t, None, "s", len(t or ""), "r", 1) for d, t in rows], DOCS)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def source(spark, sf_dir, table="documents"):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(spark, sf_dir):
    return [(r.doc_id, r.text) for r in source(spark, sf_dir).select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def con(sf_dir):
    return tables(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], sf_dir) is None


@functools.cache
def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path(name))


def library_ids(name, text):
    return tokenizer(name).encode(text or "", add_special_tokens=False).ids


def test_op1(spark, sf_dir):
    import numpy as np
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for d, t in texts(spark, sf_dir):
        ids = own.encode_ordinary(t or "")
        want.add((d, len(ids), models.sha256(np.array(ids, "<u4").tobytes()), models.sha256((t or "").encode())))
    assert set(rows_of(QUERIES["op1_byte_bpe"](spark, sf_dir))) == want


@pytest.mark.parametrize("size", [2, 5])
def test_op2(spark, sf_dir, size):
    docs = texts(spark, sf_dir)
    want = models.near_duplicates(docs, size)
    got = minhash.near_duplicates(source(spark, sf_dir), size=size)
    assert {r[0]: r[1:] for r in rows_of(got)} == {d: (n, c, d == c) for d, (n, c) in want.items()}
    left = minhash.without_copies(source(spark, sf_dir), size=size)
    assert left.columns == source(spark, sf_dir).columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, (_, c) in want.items() if d == c)


def test_copies_by_id_and_text(spark):
    """A text of its own stays, whatever other rows of its id are; rows alike in id and text stay or go together."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "zab")
    rows = [(3, a), (5, a), (5, b), (5, b), (7, b), (7, c), (-1, c), (9, None), (9, ""), (None, a)]
    left = minhash.without_copies(awkward(spark, rows)).select("doc_id", "text").collect()
    want = [(3, a), (5, b), (5, b), (-1, c), (9, None), (9, ""), (None, a)]
    assert sorted(map(repr, map(tuple, left))) == sorted(map(repr, want))


def test_op2_chain_and_groups(spark):
    """A chain of neighbours that are alike though its ends are not, and a large group of near copies."""
    words = [f"w{i}" for i in range(300)]
    chain = [(100 + k, " ".join(words[6 * k : 6 * k + 101])) for k in range(12)]
    group = [(1000 + k, " ".join(words[:90] + [f"x{k}"] + words[91:200])) for k in range(60)]
    copies = [(5000 + k, "exactly the same words") for k in range(50)]
    docs = chain + group + copies
    want = models.near_duplicates(docs)
    got = {r[0]: r[1:3] for r in rows_of(minhash.near_duplicates(awkward(spark, docs)))}
    assert got == want
    assert len({c for _, c in want.values()}) == 3


def test_op2_left_over_members(spark, monkeypatch):
    """Copies of a text that is not there itself: with one hub and small blocks, the last comparison has links to find."""
    monkeypatch.setattr(minhash, "HUBS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 6_000)
    monkeypatch.setattr(minhash, "SPREAD", 5)
    draw = random.Random(4)
    docs = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(120)]
        for _ in range(40):
            words = list(base)
            for i in draw.sample(range(120), draw.randint(3, 12)):
                words[i] = f"x{draw.random()}"
            docs.append((len(docs) + 1, " ".join(words)))
    want = models.near_duplicates(docs)
    assert len({c for _, c in want.values()}) > 4
    got = {r[0]: r[1:3] for r in rows_of(minhash.near_duplicates(awkward(spark, docs)))}
    assert got == want


def _meeting(sets, components, block):
    """A table of one meeting of blocks 0 and 1, or of block 0 with itself, as the tasks get it."""
    import numpy as np
    import pyarrow as pa

    rows = [np.unique(np.array(sorted(s), "<u8")) for s in sets]
    return pa.table({
        "low": [0] * len(rows), "high": [max(block)] * len(rows), "block": block, "key": list(range(len(rows))), "n": [len(r) for r in rows],
        "component": components, "ids": [r.tobytes() for r in rows],
        "signature": [minhash.minima(r, minhash.LONG).astype(np.uint8).tobytes() for r in rows],
    })


@pytest.mark.parametrize("blocks", [1, 2])
def test_op2_blocks_hand_on_a_forest(blocks):
    """Alike members give links fewer than themselves; members of one component, and those below the threshold, give none."""
    draw = random.Random(7)
    ids = [draw.getrandbits(63) for _ in range(400)]
    alike = [set(ids[:100]) | {draw.getrandbits(63)} for _ in range(60)]
    unlike = [set(draw.sample(ids, 100)) for _ in range(20)]
    sets, block = alike + unlike, [i % blocks for i in range(80)]
    links = minhash._joining(_meeting(sets, list(range(80)), block), 80).to_pylist()
    assert len(links) == 59 and all(r["b"] < r["a"] < 60 for r in links)
    root = list(range(80))
    for r in links:
        old, new = root[r["a"]], root[r["b"]]
        root = [new if x == old else x for x in root]
    assert len(set(root[:60])) == 1
    joined = [0 if i < 59 else i for i in range(80)]
    assert [{r["a"], r["b"]} & {59} for r in minhash._joining(_meeting(sets, joined, block), 80).to_pylist()] == [{59}]
    assert minhash._joining(_meeting(sets, [0] * 80, block), 80).num_rows == 0


def test_op2_awkward(spark):
    got = rows_of(minhash.near_duplicates(awkward(spark)))
    want = models.near_duplicates([(d, t) for d, t in AWKWARD if d is not None])
    assert {r[0]: r[1:3] for r in got if r[0] is not None} == want
    assert [r[2:] for r in got if r[0] is None] == [(None, True)]
    assert rows_of(minhash.near_duplicates(awkward(spark, []))) == []
    repeated = rows_of(minhash.near_duplicates(awkward(spark, [(1, "a b c"), (1, "a b d"), (2, "a b d")])))
    assert sorted(repeated) == [(1, 2, 1, True), (2, 2, 1, False)]


def test_op2_filter_loses_no_key(spark, monkeypatch):
    keys = spark.range(-400, 400).withColumnRenamed("id", "key")
    mark = F.xxhash64("key").alias("mark")
    others = [(r["mark"], r["key"]) for r in spark.range(400, 20_400).withColumnRenamed("id", "key").select(mark, "key").collect()]
    own = [(r["mark"], r["key"]) for r in keys.select(mark, "key").collect()]
    bitmap = minhash.possible(keys.union(keys))
    assert list(minhash._passing(own, bitmap)) == [(key,) for _, key in own]
    assert len(list(minhash._passing(others, bitmap))) < 0.05 * len(others)
    assert list(minhash._passing(own + others, minhash.possible(keys.limit(0)))) == []
    # At its greatest size the filter passes more, and still every key.
    monkeypatch.setattr(minhash, "MOST_BITS", 1 << 15)
    many = minhash.possible(spark.range(400, 20_400).withColumnRenamed("id", "key"))
    assert len(many) == 4096 and list(minhash._passing(others, many)) == [(key,) for _, key in others]


def test_op2_shuffles_no_text(spark, tmp_path, monkeypatch):
    """Texts, signatures and sets are looked up by a filter; only a table whose ids repeat is grouped by id."""
    plans, settle = {}, minhash.settled

    def watched(df, name, **options):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return settle(df, name, **options)

    monkeypatch.setattr(minhash, "settled", watched)
    path = str(tmp_path / "docs")
    spark.range(300).selectExpr("id AS doc_id", "concat_ws(' ', 'some', 'words', 'of', 'text', id % 50) AS text").write.parquet(path)
    assert minhash.near_duplicates(spark.read.parquet(path)).count() == 300
    for name in ("shingle-sets", "shared-signatures", "long-signatures"):
        assert "Join" not in plans[name] and "Aggregate" not in plans[name]


def test_op4(spark, sf_dir):
    start, want = 0, []
    for d, t in sorted(texts(spark, sf_dir)):
        ids = library_ids("byte_bpe_50k.json", t) + [0]
        want.append((d, start, len(ids), models.crc(ids)))
        start += len(ids)
    assert sorted(rows_of(QUERIES["op4_token_files"](spark, sf_dir))) == want


def test_op4_awkward(spark):
    path = P.path("byte_bpe_50k.json")
    got = tokenfile.through_files(spark, awkward(spark), path).select("doc_id", "start", "n_tokens", F.crc32("ids"))
    start, want = 0, []
    for d, t in sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0])):
        ids = library_ids("byte_bpe_50k.json", t) + [0]
        want.append((d, start, len(ids), models.crc(ids)))
        start += len(ids)
    assert sorted(rows_of(got), key=lambda r: r[1]) == want
    assert rows_of(tokenfile.through_files(spark, awkward(spark, []), path)) == []


def test_op5_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (20, [0.5, 0.5, 9.0]), (1, [1.0, 0.5]), (2, [1.0, None]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (None, [1.0, 1.0]), (7, [-1.0, 0.25]), (7, [-2.0, 0.25])]
    df = spark.createDataFrame([(v, e, 1, "x") for v, e in rows], "vec_id long, embedding array<float>, label int, q string")
    vectors = {0: (64, 32), 20: (32, 32, 576), 1: (64, 32), 6: (), 7: (-128, 16)}
    want = []
    for q in (0, 20):
        scores = sorted(((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q))
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:3], 1)]
    assert sorted(rows_of(topk.top_k(df, "vec_id % 20 = 0", k=3))) == sorted(want)
    assert rows_of(topk.top_k(df.limit(0), "vec_id % 20 = 0")) == []
    assert rows_of(topk.top_k(df, "vec_id = 99")) == []


def test_op5_prunes_exactly():
    import numpy as np

    rng = np.random.default_rng(3)
    block = np.floor(64 * rng.standard_normal((100, 3000)) * np.linspace(2, 0.1, 100)[:, None]).astype(np.int64)
    ids = rng.permutation(3000)
    queries = block[:, :5]
    got = collections.defaultdict(list)
    for q, v, s in topk.best_of_block(ids[:5], queries, ids, block, 20):
        got[q].append((v, s))
    for i in range(5):
        scores = queries[:, i] @ block
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:20]
        assert got[int(ids[i])] == [(int(ids[j]), int(scores[j])) for j in order]


def test_op5_grid_moves_blocks_only(spark, monkeypatch):
    for name, value in (("CANDIDATES", 32), ("QUERIES", 8), ("HELD", 100 * 6), ("CELLS", 3)):
        monkeypatch.setattr(topk, name, value, raising=False)
    rng = random.Random(7)
    vectors = {i: tuple(rng.randint(-3, 3) for _ in range(rng.choice((0, 3, 6)))) if i % 3 else (1, -2, 3) for i in rng.sample(range(-500, 2000), 400)}
    df = spark.createDataFrame([(i, [x / 64 for x in v]) for i, v in vectors.items()], "vec_id long, embedding array<float>").repartition(3)
    found = topk.top_k(df, "vec_id % 5 = 0", k=7)
    want = []
    for q in (i for i in vectors if i % 5 == 0):
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:7]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert sorted(rows_of(found)) == sorted(want)
    # Copies of query blocks, one for each block they meet, look as small to Spark as the blocks and went to the driver for a broadcast.
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_op5_grid():
    assert topk._grid((0, 0), (0, 0), 1, 20, 24) == (1, 1)
    down, across = topk._grid((15_000_000, 1900), (750_000, 733), 64, 20, 48)
    assert down * topk.HELD >= 15_000_000 * 64 and down * across >= 48
    down, across = topk._grid((20_000, 3), (1000, 1), 64, 20, 48)
    assert (down, across) == (3, 1)


@pytest.mark.parametrize(("largest", "kind"), [(1, "f4"), (60, "f4"), (1 << 20, "f8"), (1 << 26, "i8"), (1 << 31, "O")])
def test_op5_best_of_several_blocks(largest, kind):
    import numpy as np

    rng = np.random.default_rng(4)
    block = rng.integers(-largest, largest + 1, (40, 450))
    block[20:] //= 1 + largest // 3
    block[0, 0] = block[0, 200] = block[0, 400] = largest
    ids = rng.permutation(900)[:450] - 300
    blocks = [topk.Candidates(ids[i : i + 150], block[:, i : i + 150]) for i in (0, 150, 300)]
    queries, asked = block[:33, :200], ids[:200]  # more than a tile; shorter than the candidates
    assert topk._kind(queries, blocks[0]) == np.dtype(kind)
    got = [r for found in topk.best_of_blocks(asked, queries, blocks, 9) for r in zip(*(x.tolist() for x in found))]
    want = []
    for i, q in enumerate(asked.tolist()):
        scores = (queries[:, i].astype(object) @ block[:33].astype(object)).tolist()
        want += [(q, v, -s) for s, v in sorted((-s, v) for s, v in zip(scores, ids.tolist()) if v != q)[:9]]
    assert got == want


def test_op5_blocks():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    for sizes, most in (((5, 12, 1), 4), ((3, 0, 3), 8192), ((), 3)):
        rows = [(i, [rng.randint(-200, 200) * (1 << 40 if i == 7 else 1) for _ in range(rng.choice((0, 2, 5)))]) for i in range(sum(sizes))]
        table, at, batches = pa.table({"vec_id": pa.array([i for i, _ in rows], pa.int64()), "q": pa.array([q for _, q in rows], pa.list_(pa.int64()))}).combine_chunks(), 0, []
        for n in sizes:
            batches += table.slice(at, n).to_batches()
            at += n
        got = []
        for batch in topk._packed(iter(batches), most):
            (row,) = batch.to_pylist()
            ids, block = topk._opened(row["ids"], row["block"], row["width"])
            assert row["first"] == ids[0] and len(ids) <= most and block.shape == (row["width"], len(ids))
            got += zip(ids.tolist(), block.T.tolist())
        assert [i for i, _ in got] == [i for i, _ in rows]
        assert all(b[: len(q)] == q and not any(b[len(q) :]) for (_, b), (_, q) in zip(got, rows))
    wide = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([np.ones(topk.COMPONENTS, "i8")] * 2)], ["vec_id", "q"])
    assert [len(b.column(2)[0].as_py()) for b in topk._packed(iter([wide]), 8192)] == [topk.COMPONENTS] * 2  # one row each, a byte a component


def test_op6(spark, sf_dir):
    got = rows_of(QUERIES["op6_sharding"](spark, sf_dir))
    assert len(got) == source(spark, sf_dir).count()
    table = slow_table(list(SHARDS), sharding.SLOTS)
    slots = dict(rows_of(source(spark, sf_dir).select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(sharding.SLOTS)))))
    assert all(slot == slots[d] and shard == table[slot] for d, slot, shard in got)
    sizes = collections.Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def slow_table(shards, slots):
    """Whole preference lists, then turns."""
    prefer = {}
    for s in shards:
        offset, step = sharding._number(s, "offset") % slots, sharding._number(s, "step") % (slots - 1) + 1
        prefer[s] = iter([(offset + j * step) % slots for j in range(slots)])
    table = {}
    while True:
        for s in sorted(shards):
            table[next(x for x in prefer[s] if x not in table)] = s
            if len(table) == slots:
                return [table[i] for i in range(slots)]


def test_op6_awkward(spark):
    placed = sharding.place(awkward(spark), ["doc_id", "a.b"], SHARDS[:3], slots=101)
    assert placed.columns == [*awkward(spark).columns, "slot", "shard"] and placed.count() == len(AWKWARD)
    with pytest.raises(ValueError):
        sharding.place(placed, ["doc_id"], SHARDS[:3])
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)
    assert sharding.moved(SHARDS, SHARDS[:-1]) < 0.06
    assert sharding.place(awkward(spark, []), ["doc_id"], SHARDS).count() == 0


def test_op7_awkward(spark):
    got = linededup.deduplicated(awkward(spark), batches=3).select("row.doc_id", "n_lines", "n_dropped", "kept_text")
    want = models.line_dedup([(d, t) for d, t in AWKWARD if d is not None])
    assert {r[0]: r[1:] for r in rows_of(got) if r[0] is not None} == want
    assert [r[2:] for r in rows_of(got) if r[0] is None] == [(0, "The same long line of text here")]
    left = linededup.without_repeated_lines(awkward(spark))
    assert left.columns == awkward(spark).columns and left.where("doc_id = 10").first().n_chars == 1 and left.where("doc_id = 1").first().text is None
    assert linededup.deduplicated(awkward(spark, [])).count() == 0
    twice = awkward(spark, [(1, "a line of twenty letters or more"), (1, "other\na line of twenty letters or more"), (2, "a line of twenty letters or more")])
    assert sorted(rows_of(linededup.deduplicated(twice).select("row.doc_id", "n_dropped", "kept_text"))) == [(1, 1, ""), (1, 1, "other"), (2, 0, "a line of twenty letters or more")]


def test_op7_runs_are_levelled(spark):
    runs = linededup.LineRuns(spark, fanout=2)
    for i in range(5):
        runs.add(spark.createDataFrame([(k, 0, 100 - i) for k in range(i, i + 3)], "h1 long, h2 long, doc_id long"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert sorted(r.h1 for r in runs.rows().collect()) == list(range(7))
    assert {r.h1: r.owner for r in runs.rows().collect()}[2] == 100


def test_op8(spark, sf_dir):
    want = {d: models.base_counts(t) for d, t in texts(spark, sf_dir)}
    got = {r[0]: r[1:] for r in rows_of(QUERIES["op8_quality"](spark, sf_dir))}
    assert {d: r[:6] for d, r in got.items()} == want
    assert not any(r[6] for r in got.values() if r[5])
    label = dict(rows_of(source(spark, sf_dir, "labels").select("doc_id", "quality")))
    good = [got[d][6] for d, q in label.items() if q == 1 and not got[d][5]]
    assert sum(good) >= 0.99 * len(good)


def test_op8_score(spark):
    """The score by hand: hashes from Spark, the rest in Python."""
    import math

    rows = [(1, "good words here"), (2, "bad words here"), (3, "bad"), (4, None)]
    docs, buckets = awkward(spark, rows), 64
    trusted = spark.createDataFrame([(1,), (77,), (None,)], "doc_id long")
    target = [r.good for r in quality.trusted_sample(trusted).where("half = 0").collect()]
    found = {r[0]: r[1] for r in rows_of(docs.select("doc_id", quality.grams(quality.words_of(F.col("text")), buckets)))}
    raw, good = collections.Counter(b for g in found.values() for b in g), collections.Counter(b for d in target for b in found.get(d, []))
    total = sum(raw.values())

    def ratio(b):
        return math.log((good[b] + quality.PRIOR * raw[b] / total) / ((sum(good.values()) + quality.PRIOR) * raw[b] / total))

    got = {r[0]: r[1] for r in rows_of(quality.judged(docs, trusted, buckets=buckets).select("row.doc_id", "score"))}
    assert got[4] is None
    for d in (1, 2, 3):
        assert got[d] == pytest.approx(sum(map(ratio, found[d])) / len(found[d]), abs=1e-4)
    none = quality.judged(docs, trusted.limit(0)).select("score", "kept").collect()
    assert {r.score for r in none} <= {0.0, None} and not any(r.kept for r in none)
    assert quality.judged(awkward(spark, []), trusted).count() == 0
    assert quality.without_poor_text(awkward(spark), trusted).columns == awkward(spark).columns


def test_op8_held_out(spark):
    """Half of the labels as target: the other half is told apart."""
    sf = "/root/testdata/sf0.01"
    docs, labels = source(spark, sf), source(spark, sf, "labels")
    trusted = quality.trusted_of(labels.where("doc_id % 2 = 1"))
    got = quality.judged(docs, trusted).where("NOT base_failed").select(F.col("row.doc_id").alias("doc_id"), "kept").join(labels.where("doc_id % 2 = 0"), "doc_id").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and not any(bad)


def test_op8_threshold(spark):
    """Ties at the threshold are kept, and one odd trusted document does not switch the ratio off."""
    scores = [i / 1000 for i in range(100)]
    plain = quality.threshold_of(spark.createDataFrame([(x,) for x in scores], "score double"))
    assert plain == pytest.approx(0.01 * 0.099 - quality.MARGIN)
    odd = quality.threshold_of(spark.createDataFrame([(x,) for x in [-5.0, *scores[:30]]], "score double"))
    assert odd > -0.05
    assert quality.threshold_of(spark.createDataFrame([], "score double")) == quality.DEFAULT
    docs = awkward(spark, [(1, " ".join(f"w{i}" for i in range(60))), (2, " ".join(f"v{i}" for i in range(60)))])
    nothing = spark.createDataFrame([], "doc_id long")
    assert [r.kept for r in quality.judged(docs, nothing, threshold=0.0).select("kept").collect()] == [True, True]


def test_op8_all_trusted_documents_count(spark):
    """Every trusted id is in one of the halves, however many there are; quantiles are those of ``percentile``."""
    halves = quality.trusted_halves(spark.range(50_000).select(F.col("id").alias("doc_id")))
    assert halves.select("good").distinct().count() == halves.count() == 50_000
    assert abs(halves.where("half = 0").count() - 25_000) < 1_000
    scores = spark.range(5_000).select((F.pmod(F.xxhash64("id"), F.lit(3_001)) / 700.0 - 2).alias("score"))
    shares = [0.0, 0.01, 0.1, 0.37, 0.5, 1.0]
    want = scores.agg(F.percentile("score", F.array(*map(F.lit, shares)))).first()[0]
    assert quality.quantiles_of(scores, shares) == pytest.approx(want, abs=1e-12)


def test_op8_buckets_grow_with_the_corpus(spark):
    assert quality.buckets_for(awkward(spark, [])) == quality.BUCKETS
    one = spark.range(1).select(F.expr("repeat('abcd', 1 << 20)").alias("text"))
    many = spark.range(1 << 13).crossJoin(one.limit(1)).select(F.concat("text", F.lit("")).alias("text"))
    assert quality.buckets_for(many) == 1 << 18


def test_op8_repeated_words_do_not_depend_on_packing(spark):
    """With few bits of the hashes left in what is sorted, different hashes agree there and whole ones are sorted."""
    rows = [(1, "a b c d a b c e"), (2, " ".join(f"w{i % 7}" for i in range(200))), (3, " ".join(f"w{i}" for i in range(300)) + " w1 w2 w3"), (4, "a a a"), (5, None)]
    words = quality.fixed(awkward(spark, rows).select("doc_id", "text"), words=quality.words_of(F.col("text")))
    windows = quality.fixed(words, windows=quality.windows_of(F.col("words")))
    usual, clashing = (dict(rows_of(quality.with_repeated_words(windows, bits).select("doc_id", "n_repeat_words"))) for bits in (1, 61))
    assert usual == clashing == {d: models.base_counts(t)[4] for d, t in rows}


def test_op10(spark, sf_dir):
    check_packing(rows_of(QUERIES["op10_packing"](spark, sf_dir)), texts(spark, sf_dir), 4096)


def check_packing(got, docs, capacity):
    want, total = [], 0
    for d, t in docs:
        ids = library_ids("word_bpe_49k.json", t) + [1]
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((d, piece, at, len(part), models.crc(part)))
    order = lambda r: (r[0] is not None, *((x or 0) for x in r))
    assert sorted((r[:5] for r in got), key=order) == sorted(want, key=order)
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r[5]].append((r[6], r[3]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= -(-total // capacity) * 1.02 + 1
    return len(sequences)


def test_op10_awkward(spark):
    got = rows_of(packing.pack_documents(awkward(spark), P.path("word_bpe_49k.json"), capacity=64))
    check_packing(got, AWKWARD, 64)
    assert rows_of(packing.pack_documents(awkward(spark, []), P.path("word_bpe_49k.json"))) == []

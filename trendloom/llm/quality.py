"""Quality rules: simple counts, and a log-likelihood ratio of hashed n-grams. DataFrame operations only.

Words and pairs of neighbours are hashed to buckets. Two multinomials over the buckets are counted: of trusted documents,
and of the raw corpus. A document's score is the mean, over its n-grams, of log(trusted / raw); every document is kept or
not by one fixed threshold. Log ratios are whole numbers in units of 1 / ``UNIT``, so sums do not depend on their order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.frames import carried, column, settled

#: Fewest buckets. There are as many as the square root of the corpus's bytes, as a power of two: see ``buckets_for``.
BUCKETS = 1 << 16
UNIT = 1 << 16
#: N-grams of the raw corpus that the target counts are mixed with.
PRIOR = 100_000.0
#: The threshold is a low quantile of the scores of trusted documents that the target was not counted from, less a margin that
#: spares clean documents; but no lower than ``FENCE`` times the distance from the median to the tenth percent below the latter,
#: so that a few odd ones among few don't move it far. Without any such document it is the default.
QUANTILE, MARGIN, FENCE, DEFAULT = 0.01, 0.01, 2.0, -0.15
#: Fewest words, and the largest share of repeated words, in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Bins of a unit of score, in which quantiles are looked for.
BINS = 1024

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def fixed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once for each row. A plain projection could be merged into what uses it, a filter far
    above included, and then be computed again for each element that a lambda function visits."""
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return rows.select("*", made.alias("_fixed")).select(*rows.columns, *[F.col("_fixed").getField(n).alias(n) for n in columns])


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", -1), "")


def buckets_for(docs: DataFrame, text: str = "text") -> int:
    """The power of two next above the square root of the bytes of all texts, and ``BUCKETS`` at least: 2**18 for 30 GB, 2**24
    for 100 TB. The table of ratios grows with the corpus and still fits into every task."""
    octets = docs.agg(F.sum(F.octet_length(column(text).cast("string")).cast("long"))).first()[0] or 0
    return max(BUCKETS, 1 << max(0, octets - 1).bit_length() // 2 + max(0, octets - 1).bit_length() % 2)


def grams(words: Column, buckets: int) -> Column:
    """The buckets of all words and of all pairs of neighbours."""
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))
    return F.concat(single, pairs)


def windows_of(words: Column) -> Column:
    """A hash for each window of three words."""
    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def with_repeated_words(rows: DataFrame, least_bits: int = 1) -> DataFrame:
    """Adds ``n_repeat_words``: words inside windows that occur twice or more.

    Sorting brings equal windows together, so the work is n log n. What is sorted are plain longs, the upper bits of a window's
    hash with its place in the lower ones, as many as places need and ``least_bits`` at least. Where different hashes agree in
    their upper bits, whole hashes are sorted with their places, so the result is that of whole hashes always.
    """
    bits = F.greatest(F.length(F.bin(F.size("windows").cast("long"))), F.lit(least_bits))
    rows = fixed(rows, mask=F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    mask = F.col("mask")
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    packed = F.transform("windows", lambda h, i: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))
    rows = fixed(rows, ordered=F.when(twice, F.sort_array(packed)))

    def alike(x: Column, y: Column) -> Column:
        return F.coalesce(x.bitwiseXOR(y).between(F.lit(0), mask), F.lit(False))

    near = F.filter("ordered", lambda x, k: alike(x, F.get("ordered", k - 1)) | alike(x, F.get("ordered", k + 1)))
    rows = fixed(rows, near=near)

    def hash_at(x: Column) -> Column:
        return F.get("windows", x.bitwiseAND(mask).cast("int"))

    clash = F.filter("near", lambda x, k: alike(x, F.get("near", k + 1)) & (hash_at(x) != hash_at(F.get("near", k + 1))))
    whole = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = fixed(rows, whole=F.when(F.size(clash) > 0, whole))

    def same(s: Column, k: Column) -> Column:
        return F.coalesce(F.get("whole", k)["h"] == s["h"], F.lit(False))

    exact = F.transform(F.filter("whole", lambda s, k: same(s, k - 1) | same(s, k + 1)), lambda s: s["i"])
    rows = fixed(rows, starts=F.coalesce(exact, F.transform("near", lambda x: x.bitwiseAND(mask).cast("int"))))
    covered = F.array_union(F.array_union("starts", F.transform("starts", lambda i: i + 1)), F.transform("starts", lambda i: i + 2))
    return fixed(rows, n_repeat_words=F.coalesce(F.when(F.col("starts").isNotNull(), F.size(covered)), F.lit(0)).cast("long"))


def measured(docs: DataFrame, text: str = "text", **more: Column) -> DataFrame:
    """``row``, ``words`` and the simple counts of each document."""
    rows = carried(docs, text=F.coalesce(column(text).cast("string"), F.lit("")), **more)
    rows = fixed(fixed(rows, words=words_of(F.col("text"))), windows=windows_of(F.col("words")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    rows = rows.withColumn("lines", lines).withColumn("n_words", F.size("words").cast("long"))
    rows = with_repeated_words(rows)
    rows = rows.select(
        "row", "words", *more, "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def trusted_halves(trusted: DataFrame) -> DataFrame:
    """``good, half``: the ids of all trusted documents, of which half 0 makes the target and half 1 sets the threshold."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("good")).where("good IS NOT NULL").distinct()
    return settled(ids.select("good", F.pmod(F.xxhash64(F.lit(8), "good"), F.lit(2)).alias("half")), "trusted")


#: Its name from when it was capped.
trusted_sample = trusted_halves


def log_ratios(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, ratio`` for every bucket that occurs. ``target`` has the ids of the target's documents in ``good``. The raw
    counts cover all documents. Words become rows with their followers before they are hashed, so hashing is compiled code.
    The ids grow with the corpus, so they are dealt with the texts and not broadcast."""
    rows = docs.select(column(key).cast("long").alias("id"), column(text).cast("string").alias("text"))
    rows = rows.join(target.select("good").hint("shuffle_hash"), F.col("id") == F.col("good"), "left")
    rows = fixed(rows.select("text", F.col("good").isNotNull().cast("long").alias("is_good")), words=words_of(F.col("text")))
    later = F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0)))
    rows = rows.select("is_good", F.explode(F.arrays_zip(F.col("words").alias("word"), later.alias("next"))).alias("w"))
    single = F.pmod(F.xxhash64("w.word"), F.lit(buckets)).cast("int")
    pair = F.when(F.col("w.next").isNotNull(), F.pmod(F.xxhash64("w.word", "w.next"), F.lit(buckets)).cast("int"))
    counts = rows.select("is_good", single.alias("one"), pair.alias("two"))
    counts = counts.select("is_good", F.explode(F.array("one", "two")).alias("bucket")).where("bucket IS NOT NULL")
    counts = settled(counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("is_good").alias("good")), "gram-counts")
    totals = F.broadcast(counts.agg(F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good")))
    share = F.col("raw") / F.col("all_raw")
    ratio = F.log((F.col("good") + PRIOR * share) / ((F.col("all_good") + PRIOR) * share))
    return counts.join(totals, F.lit(True)).select("bucket", F.round(ratio * UNIT).cast("int").alias("ratio"))


def quantiles_of(scores: DataFrame, shares: Sequence[float]) -> list[float] | None:
    """Exact quantiles of ``score``, between two scores in proportion; none of no scores.

    Two passes: bins first, then the ranks inside the bins that hold one. ``percentile`` would hold all scores in one task.
    """
    known = scores.where("score IS NOT NULL").select("score", F.floor(F.col("score") * BINS).alias("bin"))
    bins = known.groupBy("bin").count().orderBy("bin").collect()
    if not bins:
        return None
    last = sum(r["count"] for r in bins) - 1
    places = {}
    for rank in {f(share * last) for share in shares for f in (math.floor, math.ceil)}:
        before = 0
        for r in bins:
            if rank < before + r["count"]:
                places[r["bin"], rank - before + 1] = rank
                break
            before += r["count"]
    held = known.where(F.col("bin").isin([b for b, _ in places]))
    ranked = held.withColumn("place", F.row_number().over(Window.partitionBy("bin").orderBy("score")))
    one_of = [(F.col("bin") == b) & (F.col("place") == i) for b, i in places]
    at = {places[r["bin"], r["place"]]: r["score"] for r in ranked.where(F.array_contains(F.array(*one_of), True)).collect()}

    def quantile(x: float) -> float:
        low, high = math.floor(x), math.ceil(x)
        return at[low] if at[low] == at[high] else (high - x) * at[low] + (x - low) * at[high]

    return [quantile(share * last) for share in shares]


def threshold_of(scores: DataFrame) -> float:
    """The lowest ``score`` that is kept, from scores of trusted documents; see ``QUANTILE``."""
    found = quantiles_of(scores, (QUANTILE, 0.1, 0.5))
    if found is None:
        return DEFAULT
    low, tenth, middle = found
    return max(low - MARGIN, tenth - FENCE * (middle - tenth))


def judged(
    docs: DataFrame,
    trusted: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float | None = None,
    buckets: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``row`` (all columns of ``docs``, or those in ``keep``), the counts, ``base_failed``, ``score`` and ``kept``.

    ``trusted`` has the ids of trusted documents in ``doc_id``; all of them count, half in the target and half for the
    threshold. Null and empty texts have no words and fail; texts of any length are judged whole. Rows are judged one by one,
    repeated ones alike; a score at the threshold is kept. Rows without an id count in the raw corpus. Without trusted
    documents all ratios are 0, so that the simple rules decide alone. An empty table gives an empty table. ``docs`` should be
    a table, as it is read three times. The ratios, one number for each bucket, are a constant of the plan. Scores are
    written once, with ``row``, so that those of the held-out half are there before the threshold is.
    """
    buckets = buckets or buckets_for(docs, text)
    halves = trusted_halves(trusted)
    found = [0] * buckets
    for bucket, ratio in log_ratios(docs, halves.where("half = 0"), key, text, buckets).collect():  # one row for each bucket at most
        found[bucket] = ratio
    table = F.split(F.lit(",".join(map(str, found))), ",").cast("array<int>")  # folded to a constant
    row = F.col("row") if keep is None else F.struct(*[F.col("row").getField(c).alias(c) for c in keep])
    counted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score")
    rows = _scored(docs, table, text, buckets, id=column(key).cast("long")).select(row.alias("row"), "id", *counted)
    if threshold is None:
        rows = settled(rows, "scores")
        held = halves.where("half = 1").select("good")
        threshold = threshold_of(rows.where("NOT base_failed").select("id", "score").join(held, F.col("id") == F.col("good"), "left_semi"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False))
    return rows.select("row", *counted, kept.alias("kept"))


def _scored(docs: DataFrame, table: Column, text: str, buckets: int, **more: Column) -> DataFrame:
    rows = fixed(measured(docs, text, **more), grams=grams(F.col("words"), buckets))
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda sum_, b: sum_ + F.get(table, b))
    return fixed(rows, score=F.when(F.size("grams") > 0, total / F.size("grams") / UNIT))


def trusted_of(labels: DataFrame) -> DataFrame:
    """Ids of documents with quality 1 in a table of ``doc_id, quality``."""
    return labels.where("quality = 1").select("doc_id")


def without_poor_text(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", threshold: float | None = None) -> DataFrame:
    """The documents that are kept, with all their columns."""
    return judged(docs, trusted, key, text, threshold).where("kept").select("row.*")

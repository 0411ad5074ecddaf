"""Benchmark decontamination by spaced seeds, with DataFrame operations only.

Texts are lower-cased and cut into words of letters and digits. A document overlaps an item if,
for some alignment of the two word sequences, ``WINDOW`` consecutive aligned words (or all
words of a shorter item) agree in at least ``AGREE`` of the places: substitutions are tolerated.

1. *Seeds.* Two fixed masks, ``11011`` and ``110011``, name each position by the hash of the
   words under their ones; words under zeros are ignored. Every window of 15 words with up to 3
   substitutions keeps at least one seed of one mask (checked over all placements in the
   tests), so for items of 15 words or more the search is exact. Shorter items of which some
   placement keeps none (5, 6, 10 and 11 words) have the masks in ``SHORT`` besides, and items up
   to ``WHOLE`` words, which allow no substitution, are named by all their words. Documents are
   searched for such seeds only if the benchmark has items of these lengths.
2. *Filter.* Items' seeds set two bits each in an array of ``SEED_BITS`` bits a seed (128 KB at least, 8 MB at
   most: beyond half a million seeds more positions pass, and results stay the same). Documents keep the positions whose two
   bits are set, and documents without any leave before a shuffle.
3. *Join.* Positions and items' seeds meet by an equal-hash join; a (document, item, alignment)
   is kept once however many seeds it shares.
4. *Verification.* The aligned words are compared around each hit.

Defined results: null texts and texts without words never overlap; items of any length are searched
for, those with a null item_id too (reported as null, one key); a text without spaces, such as a CJK
sentence, is one word; repeated rows are judged alike; a null doc_id is reported as null; extra columns are ignored by
``overlaps`` and kept by ``decontaminated``; an empty table on either side gives no overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import common

WINDOW = 15
AGREE = 0.8
MASKS = ("11011", "110011")
#: More masks for items of so many words; with them every allowed placement of substitutions keeps a seed.
SHORT = {5: ("1111", "11101", "10111"), 6: ("1111",), 10: ("1111",), 11: ("1111",)}
#: Items up to so many words allow no substitution.
WHOLE = 4
#: Bits of the seed filter for each seed, and its least and most 64-bit words; powers of two.
SEED_BITS = 128
FILTER_WORDS = (1 << 14, 1 << 20)


def filter_words(seeds: int) -> int:
    """The size of the filter for so many seeds."""
    least, most = FILTER_WORDS
    return min(most, max(least, 1 << (max(seeds, 1) * SEED_BITS // 64 - 1).bit_length()))


def _hashes(df: DataFrame, *keys: str) -> DataFrame:
    """keys, h: the word hashes of ``text``."""
    words = "filter(split(lower(coalesce(cast(text as string), '')), '[^\\\\p{L}\\\\p{N}]+'), w -> w <> '')"
    return df.select(*keys, F.expr(f"transform({words}, w -> xxhash64(w))").alias("h"))


def _short_seeds(lengths: set[int]) -> dict[str, tuple[str, list[int]]]:
    """Column, mask and lengths of items of the seeds that items of these lengths need besides a and b."""
    of: dict[str, list[int]] = {}
    for n in sorted(lengths & SHORT.keys()):
        for m in SHORT[n]:
            of.setdefault(m, []).append(n)
    whole = {f"w{n}": ("1" * n, [n]) for n in range(1, WHOLE + 1) if n in lengths}
    return {f"m{m}": (m, ns) for m, ns in of.items()} | whole


def _seeded(df: DataFrame, short: dict[str, tuple[str, list[int]]]) -> DataFrame:
    """Adds a and b: the seeds of the two masks at each position (pairs of words, then pairs of pairs); and those of short items."""
    cols = df.columns

    def named(column: str, mask: str) -> str:
        under = ", ".join(f"get(h, i + {k})" for k, c in enumerate(mask) if c == "1")
        return f"slice(transform(h, (x, i) -> xxhash64({under}, '{column}')), 1, greatest(size(h) - {len(mask) - 1}, 0))"

    pairs = df.select(*cols, F.expr("zip_with(h, slice(h, 2, size(h)), (x, y) -> xxhash64(x, y))").alias("s"))
    return pairs.select(
        *cols,
        F.expr("slice(zip_with(s, slice(s, 4, size(s)), (x, y) -> xxhash64(x, y, 1)), 1, greatest(size(h) - 4, 0))").alias("a"),
        F.expr("slice(zip_with(s, slice(s, 5, size(s)), (x, y) -> xxhash64(x, y, 2)), 1, greatest(size(h) - 5, 0))").alias("b"),
        *(F.expr(named(column, mask)).alias(column) for column, (mask, _) in short.items()),
    )


def _filter_row(seeds: DataFrame, words: int) -> DataFrame:
    """One row, one array of so many longs with two bits set per seed."""
    mask = words * 64 - 1
    marked = seeds.select(F.explode(F.expr(f"array(seed & {mask}, shiftrightunsigned(seed, 32) & {mask})")).alias("bit"))
    marked = marked.groupBy(F.expr("bit div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits"))
    spark = seeds.sparkSession
    full = spark.range(words).withColumnRenamed("id", "word").join(marked, "word", "left")
    return full.agg(F.expr("transform(array_sort(collect_list(struct(word, coalesce(bits, 0L) as bits))), x -> x.bits)").alias("bits"))


def _passing(seeds: str, words: int) -> str:
    def bit(place: str) -> str:
        return f"(shiftright(get(bits, cast(shiftright({place}, 6) as int)), cast({place} & 63 as int)) & 1) = 1"

    mask = words * 64 - 1
    low, high = f"(v & {mask})", f"(shiftrightunsigned(v, 32) & {mask})"
    return f"array_compact(transform({seeds}, (v, i) -> CASE WHEN {bit(low)} AND {bit(high)} THEN struct(i as pos, v as seed) END))"


def _passing_once(seeds: str, words: int) -> str:
    """Like ``_passing``, but with the first place of each seed only: one place of a whole item is as good as any."""
    once = _passing(f"array_distinct({seeds})", words)
    return f"transform({once}, p -> struct(cast(array_position({seeds}, p.seed) - 1 as int) as pos, p.seed as seed))"


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, matched (equal words in the best window) and window, per overlapping document and item."""
    return _overlaps(docs, items, ["doc_id"])


def _overlaps(docs: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """``overlaps`` of rows that are named by columns ``keys``."""
    bench = _hashes(items.where("text is not null"), "item_id").where("size(h) > 0").distinct()
    bench = common.written(bench.withColumn("item", F.monotonically_increasing_id()), "items")
    short = _short_seeds({r["n"] for r in bench.select(F.expr(f"least(size(h), {WINDOW})").alias("n")).distinct().collect()})
    seeded = _seeded(bench, short)
    every = seeded.select("item", F.posexplode("a").alias("at", "seed")).union(seeded.select("item", F.posexplode("b").alias("at", "seed")))
    for column, (_, lengths) in short.items():
        every = every.union(seeded.where(F.size("h").isin(lengths)).select("item", F.posexplode(column).alias("at", "seed")))
    seeds = common.written(every, "item-seeds")
    size = filter_words(seeds.count())
    filter_bits = common.written(_filter_row(seeds, size), "seed-filter")
    tested = _seeded(_hashes(docs, *keys), short).withColumn("bits", filter_bits.scalar())
    found = {"pa": _passing("a", size), "pb": _passing("b", size)}
    found |= {f"p{c}": _passing_once(c, size) if c.startswith("w") else _passing(c, size) for c in short}
    tested = tested.select(*keys, "h", *(F.expr(e).alias(c) for c, e in found.items()))
    left = tested.select(*keys, "h", F.concat(*found).alias("passing"))
    # A filter here would be pushed below the projections, and every hash computed again for it: words of
    # documents without hits are set to null instead, and their rows are left out when read back.
    left = left.select(*keys, F.expr("CASE WHEN size(passing) > 0 THEN h END").alias("h"), "passing")
    left = common.written(left.withColumn("row", F.monotonically_increasing_id()), "seeded-documents").where("size(passing) > 0")
    hits = (
        left.select("row", F.explode("passing").alias("p"))
        .select("row", F.col("p.pos").alias("pos"), F.col("p.seed").alias("seed"))
        .join(seeds, "seed")
        .select("row", "item", (F.col("pos") - F.col("at")).alias("shift"))
        .distinct()
    )
    hits = common.written(hits, "alignments")
    aligned = hits.join(left.select("row", *keys, "h"), "row").join(bench.withColumnRenamed("h", "q"), "item")
    equal = "transform(q, (w, j) -> CASE WHEN j + shift >= 0 AND get(h, cast(j + shift as int)) = w THEN 1 ELSE 0 END)"
    aligned = aligned.select("row", "item_id", *keys, F.expr(equal).alias("e"), F.expr(f"least({WINDOW}, size(q))").alias("window"))
    best = "array_max(transform(sequence(0, size(e) - window), k -> aggregate(slice(e, k + 1, window), 0, (x, y) -> x + y)))"
    judged = aligned.select("row", *keys, "item_id", "window", F.expr(best).alias("matched"))
    judged = judged.where(F.col("matched") >= F.lit(AGREE) * F.col("window"))
    return judged.groupBy(*keys, "item_id").agg(
        F.max("matched").cast("long").alias("matched"), F.max("window").cast("long").alias("window")
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text overlaps no item.

    Rows are judged by their texts (two hashes), whatever their doc_ids: a clean row stays though another row of its doc_id, or
    another without one, overlaps.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keys = {"__text_a": F.xxhash64(text), "__text_b": F.xxhash64(text, F.lit(1))}
    named = docs.select(*(c.alias(n) for n, c in keys.items()), F.col("text"))
    bad = common.written(_overlaps(named, items, list(keys)).select(*keys).distinct(), "overlaps")
    return docs.withColumns(keys).join(bad, list(keys), "left_anti").drop(*keys)


def op9_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every overlapping pair of a document and a benchmark item."""
    return overlaps(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SQL_WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"


def _sql_seeds(table: str, key: str) -> str:
    picks = {m: " || ' ' || ".join(f"h[p + {i}]" for i, c in enumerate(m) if c == "1") for m in MASKS}
    return " UNION ALL ".join(
        f"SELECT {key}, p, '{m}:' || {words} AS seed FROM (SELECT {key}, h, unnest(range(1, len(h) - {len(m) - 2})) AS p FROM {table})"
        for m, words in picks.items()
    )


OP9_SQL = f"""
WITH docs AS (SELECT doc_id, {_SQL_WORDS} AS h FROM documents),
items AS (SELECT item_id, {_SQL_WORDS} AS h FROM benchmark WHERE text IS NOT NULL),
item_seeds AS ({_sql_seeds("items", "item_id")}),
doc_seeds AS (SELECT * FROM ({_sql_seeds("docs", "doc_id")}) WHERE seed IN (SELECT seed FROM item_seeds)),
alignments AS (SELECT DISTINCT d.doc_id, i.item_id, d.p - i.p AS shift FROM doc_seeds d JOIN item_seeds i USING (seed)),
compared AS (
  SELECT a.doc_id, a.item_id, least({WINDOW}, len(i.h)) AS w,
         [CASE WHEN j + shift >= 1 AND d.h[j + shift] = i.h[j] THEN 1 ELSE 0 END FOR j IN range(1, len(i.h) + 1)] AS e
  FROM alignments a JOIN docs d USING (doc_id) JOIN items i USING (item_id)
),
best AS (SELECT doc_id, item_id, w, list_max([list_sum(e[k : k + w - 1]) FOR k IN range(1, len(e) - w + 2)]) AS m FROM compared)
SELECT doc_id, item_id, CAST(max(m) AS BIGINT) AS matched, CAST(max(w) AS BIGINT) AS "window"
FROM best WHERE m >= {AGREE} * w GROUP BY doc_id, item_id
"""

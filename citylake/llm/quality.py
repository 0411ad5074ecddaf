"""Quality rules with adaptive thresholds, with DataFrame operations only.

Each text's measures (mean word length, symbols per word, share of repeated lines) go into quantile
sketches per language and source. A sketch counts values in bins whose bounds grow by ``GROWTH``, so a
quantile is off by ``ACCURACY`` of its value at most; whatever the order of rows and tasks, counts add up to the
same sketch, and thresholds are the same in every run. Sketches merge: a group's make a language's, languages'
make the whole table's. A group with fewer than ``LEAST`` texts takes the thresholds of its language, a
language with fewer those of the table. Thresholds are fences around the middle half: ``FENCE`` times its width
(at least ``FLOOR`` of the measure) beyond either quartile. They are joined back by language and source, and a
text is kept if it passes the base rules and all fences.

A hot source costs its bins (some hundred) per task before the shuffle; the threshold join has one row per
language and source and is left to Spark's size-based choice, with skewed partitions split.

Defined results: a null or empty text has no words and fails the base rules; it enters no sketch. Null
languages and sources are groups of their own. Repeated rows are judged alike, extra columns are ignored by
``judged``; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm import common

LEAST = 100
FENCE = 4.0
#: Largest relative error of a quantile; the bounds of a bin differ by the factor GROWTH.
ACCURACY = 0.005
GROWTH = (1 + ACCURACY) / (1 - ACCURACY)
#: Smallest width of the middle half of each measure that fences are made from.
FLOOR = {"word_length": 0.4, "symbols": 0.05, "repeated_lines": 0.1}

_LOG = repr(math.log(GROWTH))
_MIDDLE = f"CASE WHEN bin IS NULL THEN 0.0D ELSE 2D * power({GROWTH!r}D, bin) / ({GROWTH!r}D + 1D) END"
_SPACE = "[ \\\\t-\\\\r]"


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the base counts of every text; windows of 8 words are compared by 64-bit hashes."""
    text = "coalesce(cast(text as string), '')"
    split = docs.select(
        *keep,
        F.expr(f"filter(split({text}, '{_SPACE}+'), w -> w <> '')").alias("w"),
        F.expr(f"filter(split({text}, '\\n'), l -> l rlike '[^ \\\\t-\\\\r]')").alias("l"),
        F.expr(f"length({text}) - length(regexp_replace({text}, '[#*$%&|<>]', ''))").cast("long").alias("n_symbols"),
    )
    hashed = split.select(
        *keep,
        F.expr("cast(size(w) as bigint)").alias("n_words"),
        F.expr("aggregate(w, 0L, (n, x) -> n + length(x))").alias("word_chars"),
        "n_symbols",
        F.expr("cast(size(l) as bigint)").alias("n_lines"),
        F.expr("cast(size(l) - size(array_distinct(l)) as bigint)").alias("n_dup_lines"),
        F.expr("transform(w, x -> xxhash64(x))").alias("h"),
    )
    counts = [*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # Hashes of 2, 4 and 8 words from two of the half length.
    two = hashed.select(*counts, F.expr("zip_with(h, slice(h, 2, size(h)), (x, y) -> xxhash64(x, y))").alias("h"))
    four = two.select(*counts, F.expr("zip_with(h, slice(h, 3, size(h)), (x, y) -> xxhash64(x, y))").alias("h"))
    eight = four.select(
        *counts,
        F.expr("slice(zip_with(h, slice(h, 5, size(h)), (x, y) -> xxhash64(x, y)), 1, cast(greatest(n_words - 7, 0) as int))").alias("h"),
    )
    ranked = eight.select(
        *counts,
        F.expr(
            "CASE WHEN size(array_distinct(h)) < size(h) THEN array_sort(transform(h, (v, i) -> struct(v, i))) "
            "ELSE cast(array() as array<struct<v: bigint, i: int>>) END"
        ).alias("s"),
    )
    again = "(k > 0 AND get(s, k - 1).v = x.v) OR get(s, k + 1).v = x.v"
    places = ranked.select(
        *counts, F.expr(f"array_sort(array_compact(transform(s, (x, k) -> CASE WHEN {again} THEN x.i END)))").alias("p")
    )
    covered = "aggregate(zip_with(p, slice(p, 2, size(p)), (a, b) -> least(8, coalesce(b - a, 8))), 0L, (n, x) -> n + x)"
    return places.select(*counts, F.expr(covered).alias("n_repeat_words"))


def _measures(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("word_length", F.expr("word_chars / nullif(n_words, 0)"))
        .withColumn("symbols", F.expr("n_symbols / nullif(n_words, 0)"))
        .withColumn("repeated_lines", F.expr("n_dup_lines / nullif(n_lines, 0)"))
    )


def thresholds(measures: DataFrame) -> DataFrame:
    """lang, source, and low and high of each measure, for every language and source."""
    names = list(FLOOR)
    each = measures.select("lang", "source", F.expr(f"stack({len(names)}, {', '.join(f'{m!r}, {m}' for m in names)}) as (measure, value)"))
    # Bin k holds values up to GROWTH^k; zeros have the null bin, which comes first.
    binned = each.where("value is not null").withColumn("bin", F.expr(f"CASE WHEN value > 0 THEN cast(ceil(ln(value) / {_LOG}D) as int) END"))
    sketches = common.written(binned.groupBy("lang", "source", "measure", "bin").agg(F.count(F.lit(1)).alias("n")), "sketches")
    langs = sketches.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    total = langs.groupBy("measure", "bin").agg(F.sum("n").alias("n"))

    def fences(df: DataFrame, *keys: str) -> DataFrame:
        """Quartiles: the middle of the first bin up to which a quarter, or three, of the values lie."""
        of = Window.partitionBy(*keys, "measure")
        below = F.sum("n").over(of.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        upto = df.select(*keys, "measure", "n", F.expr(_MIDDLE).alias("value"), below.alias("below"), F.sum("n").over(of).alias("total"))
        quartiles = upto.groupBy(*keys).agg(
            F.max(F.when(F.col("measure") == names[0], F.col("total"))).alias("n"),
            *(
                F.min(F.when((F.col("measure") == m) & (4 * F.col("below") >= part * F.col("total")), F.col("value"))).alias(f"{m}_q{part}")
                for m in names
                for part in (1, 3)
            ),
        )
        out = []
        for m in names:
            width = f"{FENCE}D * greatest({m}_q3 - {m}_q1, {FLOOR[m]}D)"
            out += [F.expr(f"{m}_q1 - {width}").alias(f"{m}_low"), F.expr(f"{m}_q3 + {width}").alias(f"{m}_high")]
        return quartiles.select(*keys, "n", *out)

    by_source = fences(sketches, "lang", "source")
    limits = [f"{m}_{side}" for m in names for side in ("low", "high")]
    by_lang = fences(langs, "lang").select(F.col("lang").alias("lang_"), F.col("n").alias("n_"), *(F.col(c).alias(f"{c}_") for c in limits))
    whole = fences(total).agg(*(F.max(c).alias(c) for c in limits)).first()  # one row
    joined = by_source.join(by_lang, F.col("lang").eqNullSafe(F.col("lang_")), "left")
    return joined.select(
        "lang",
        "source",
        *(
            F.when(F.col("n") >= LEAST, F.col(c)).when(F.col("n_") >= LEAST, F.col(f"{c}_")).otherwise(F.lit(whole[c]).cast("double")).alias(c)
            for c in limits
        ),
    )


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed and kept of every document."""
    lang, source = (F.col(c).cast("string").alias(c) for c in ("lang", "source"))
    source_rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang, source, "text")
    counts = common.written(_measures(measured(source_rows, "doc_id", "lang", "source")), "measures")
    limits = common.written(thresholds(counts), "thresholds")
    limits = limits.withColumnRenamed("lang", "lang_").withColumnRenamed("source", "source_")
    same = F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_"))
    inside = [F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")) for m in FLOOR]
    passes = inside[0] & inside[1] & inside[2]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counts.join(limits, same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.coalesce(passes, F.lit(False))).alias("kept"),
    )


def op6_adaptive_quality(spark, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    return judged(common.documents(spark, sf_dir))


def _sql() -> str:
    """The same rules for DuckDB: each value is rounded to the middle of its bin, quartiles of these are exact."""
    names = list(FLOOR)
    quartiles = ", ".join(f"quantile_disc({m}_bin, {q}) AS {m}_{s}" for m in names for q, s in ((0.25, "q1"), (0.75, "q3")))
    middles = ", ".join(
        f"CASE WHEN {m} > 0 THEN 2 * power({GROWTH!r}::DOUBLE, ceil(ln({m}) / {_LOG}::DOUBLE)) / ({GROWTH!r}::DOUBLE + 1) ELSE {m} END AS {m}_bin" for m in names
    )

    def fences(pre: str) -> str:
        out = []
        for m in names:
            width = f"{FENCE} * greatest({pre}{m}_q3 - {pre}{m}_q1, {FLOOR[m]})"
            out.append(f"d.{m} BETWEEN {pre}{m}_q1 - {width} AND {pre}{m}_q3 + {width}")
        return " AND ".join(out)

    return f"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS t FROM documents
),
split AS MATERIALIZED (
  SELECT id, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts
),
windows AS (
  SELECT id, k, w[k : k + 7] AS g FROM (SELECT id, w, unnest(range(1, len(w) - 6)) AS k FROM split)
),
again AS (SELECT id, unnest(ks) AS k FROM (SELECT id, list(k) AS ks FROM windows GROUP BY id, g HAVING count(*) > 1)),
repeated AS (SELECT id, count(*) AS n FROM (SELECT DISTINCT id, unnest(range(k, k + 8)) AS p FROM again) GROUP BY id),
counts AS MATERIALIZED (
  SELECT x.id, doc_id, lang, source, len(w) AS n_words, coalesce(list_sum([length(y) FOR y IN w]), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines) AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM texts x JOIN split s USING (id) LEFT JOIN repeated r USING (id)
),
measures AS (
  SELECT *, word_chars / nullif(n_words, 0)::DOUBLE AS word_length, n_symbols / nullif(n_words, 0)::DOUBLE AS symbols,
         n_dup_lines / nullif(n_lines, 0)::DOUBLE AS repeated_lines
  FROM counts
),
d AS MATERIALIZED (SELECT *, {middles} FROM measures),
by_source AS (SELECT lang, source, count(word_length) AS n, {quartiles} FROM d GROUP BY lang, source),
by_lang AS (SELECT lang, count(word_length) AS n, {quartiles} FROM d GROUP BY lang),
whole AS (SELECT {quartiles} FROM d)
SELECT d.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT base_failed AND coalesce(CASE WHEN s.n >= {LEAST} THEN {fences("s.")} WHEN l.n >= {LEAST} THEN {fences("l.")} ELSE {fences("a.")} END, false) AS kept
FROM d JOIN by_source s ON d.lang IS NOT DISTINCT FROM s.lang AND d.source IS NOT DISTINCT FROM s.source
JOIN by_lang l ON d.lang IS NOT DISTINCT FROM l.lang CROSS JOIN whole a
"""


OP6_SQL = _sql()

"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

Each document gets integer measures. Their distribution per (lang, source) is kept as a log-linear histogram
sketch: values below 2**PRECISION have a bin each, larger ones share bins of 2**k with a relative width of at
most 2**(1-PRECISION). Sketches merge by adding counts, so they are a two-phase aggregation whose rows per group
are bounded by the number of bins, however hot a source is; the sketches of languages and of the corpus are merged from those.

No cutoff is fixed: with quartiles q25, q50, q75 a sketch accepts values up to q50 + SPREAD * (q50 - q25) and, for the word
length, from q50 - SPREAD * (q75 - q50); the half on the other side of the median gives the spread, so that a group keeps
a sound limit while less than half of it is junk. A rate's limit stays at most half way from q75 to 1000 per mille. The
limits of a group of n documents are shrunk to its language's, those to the corpus's, by n to SHRINK documents.
A document is rejected if the base rules reject it, if its word length lies outside, or if a count exceeds its
limit's share by more than SLACK occurrences (a rate of a short text is no evidence).

Defined cases: a null text has no words and fails the base rule; null lang or source form groups of their own;
repeated rows are judged and counted each; an empty table gives an empty result; extra columns pass through, also those
named like a measure; texts of any length are hashed in bounded segments.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.base import discard, map_batches, materialize, table
from touchline.llm.kernels import repeated_words, words

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_again long"
#: Values that the base rules name.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Rates per mille: the count and what it is a share of. n_again: words equal to the one before.
RATES = {"symbol_pm": ("n_symbols", "n_words"), "dup_line_pm": ("n_dup_lines", "n_lines"), "again_pm": ("n_again", "n_words")}
#: Hundredths of a code point a word; limited on both sides.
LENGTH = "word_len"
SPREAD, SLACK, SHRINK, PRECISION = 13, 3, 100, 9


def measure_batch(column: pa.Array) -> dict[str, pa.Array]:
    """The integer measures of each text."""
    n = len(column)
    out = {k.split()[0]: np.zeros(n, np.int64) for k in MEASURES.split(", ")}
    for row, hashes in words(column):
        out["n_words"][row] = len(hashes)
        out["n_again"][row] = int((hashes[1:] == hashes[:-1]).sum())
        out["n_repeat_words"][row] = repeated_words(hashes, WINDOW)
    for row in range(n):
        text = column[row].as_py()
        if not text:
            continue
        raw = text.encode()
        out["word_chars"][row] = len(text) - sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        out["n_symbols"][row] = sum(raw.count(bytes([c])) for c in SYMBOLS)
        lines = [x for x in raw.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
        out["n_lines"][row] = len(lines)
        out["n_dup_lines"][row] = len(lines) - len(set(lines))
    return {k: pa.array(v) for k, v in out.items()}


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep columns and the measures of each row; only texts go to Python."""
    return map_batches(docs, measure_batch, MEASURES, keep, [text])


def _values() -> dict:
    """The adaptive measures, as integers; null for a text without words."""
    per = lambda top, by: F.expr(f"case when n_words > 0 then {top} div greatest({by}, 1) end")
    return {name: per(f"1000 * {top}", by) for name, (top, by) in RATES.items()} | {LENGTH: per("100 * word_chars", "n_words")}


def sketch(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Mergeable histogram sketches: one row per group, measure and non-empty bin (upper bound, count)."""
    rates = _values()
    long = measured.select(*groups, F.explode(F.array(*[F.struct(F.lit(k).alias("name"), v.alias("v")) for k, v in rates.items()])).alias("m")).where("m.v is not null")
    shift = F.expr(f"greatest(0, length(bin(m.v)) - {PRECISION})")
    # the bin is named by its largest value
    upper = F.expr("shiftleft(shiftright(m.v, s) + 1, s) - 1")
    return long.withColumn("s", shift.cast("int")).groupBy(*groups, F.col("m.name").alias("name"), upper.alias("upper")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches of parts of a corpus, unioned, become the sketch of the whole."""
    return sketches.groupBy(*groups, "name", "upper").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group and measure: n, and the limits that its own sketch sets (low is null for rates)."""
    bins = sketches.groupBy(*groups, "name").agg(F.array_sort(F.collect_list(F.struct("upper", "n"))).alias("bins"), F.sum("n").alias("total"))
    # one walk over the bins: the first whose running count reaches each quarter
    step = "struct(a.c + b.n as c, " + ", ".join(f"case when a.q{q} is null and (a.c + b.n) * 100 >= total * {q} then b.upper else a.q{q} end as q{q}" for q in (25, 50, 75)) + ")"
    start = "struct(0L as c, cast(null as bigint) as q25, cast(null as bigint) as q50, cast(null as bigint) as q75)"
    at = bins.select(*groups, "name", "total", F.expr(f"aggregate(bins, {start}, (a, b) -> {step})").alias("a")).select(*groups, "name", "total", "a.q25", "a.q50", "a.q75")
    high = F.col("q50") + SPREAD * (F.col("q50") - F.col("q25"))
    top = F.when(F.col("name") == LENGTH, high).otherwise(F.least(high, F.greatest(F.col("q75"), F.expr("(q75 + 1000) div 2"))))
    low = F.when(F.col("name") == LENGTH, F.greatest(F.lit(0).cast("long"), F.col("q50") - SPREAD * (F.col("q75") - F.col("q50"))))
    return at.select(*groups, "name", F.col("total").alias("n"), top.alias("high"), low.alias("low"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source): the least and largest accepted value of each measure, shrunk to the language's and the corpus's."""
    own = quartiles(sketches, ["lang", "source"])
    by_lang = quartiles(merge(sketches, ["lang"]), ["lang"])
    whole = quartiles(merge(sketches, []), [])
    shrunk = lambda c: F.expr(f"({c} * n + up_{c} * {SHRINK}) div (n + {SHRINK})").alias(c)
    up = lambda df: df.withColumnsRenamed({"high": "up_high", "low": "up_low"}).drop("n")
    by_lang = by_lang.join(up(whole), "name").select("lang", "name", shrunk("high"), shrunk("low"))
    parent = up(by_lang).select(F.col("lang").alias("_lang"), F.col("name").alias("_name"), "up_high", "up_low")
    both = own.join(parent, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("name") == F.col("_name"))).select("lang", "source", "name", shrunk("high"), shrunk("low"))
    pick = lambda k, c: F.max(F.when(F.col("name") == k, F.col(c))).alias(f"{c}_{k}")
    return both.groupBy("lang", "source").agg(*[pick(k, "high") for k in (*RATES, LENGTH)], pick(LENGTH, "low"))


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """measured rows with base_failed and kept; limits are few rows, joined by size of their file."""
    bounds = [c for c in limits.columns if c not in ("lang", "source")]
    lim = limits.select(F.col("lang").alias("_l_lang"), F.col("source").alias("_l_source"), *bounds)
    joined = measured.join(lim, F.col("lang").eqNullSafe(F.col("_l_lang")) & F.col("source").eqNullSafe(F.col("_l_source")), "left")
    failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    within = F.expr(f"100 * word_chars div greatest(n_words, 1) between low_{LENGTH} and high_{LENGTH}")
    for name, (top, by) in RATES.items():
        within = within & F.expr(f"1000 * {top} <= high_{name} * {by} + {1000 * SLACK}")
    out = joined.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(within, F.lit(True)))
    return out.drop("_l_lang", "_l_source", *bounds)


def score_rules(docs: DataFrame) -> DataFrame:
    """doc_id, measures, base_failed and kept of every document; one pass over the texts."""
    measured = materialize(measure(docs, ["doc_id", "lang", "source"]), "rules")
    limits = materialize(thresholds(sketch(measured, ["lang", "source"])), "limits")
    return judge(measured, limits).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_again")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with docs' own columns.

    The thresholds come from a first pass that keeps no text; the second pass measures again, so that texts are never
    shuffled nor written. Rows stay in the JVM.
    """
    measured = materialize(measure(docs, ["lang", "source"]), "rules")
    limits = materialize(thresholds(sketch(measured, ["lang", "source"])), "limits")
    discard(measured)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "lang", "source", "text")
    return judge(measure(inner, ["row", "lang", "source"]), limits).where("kept").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_rules(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\x0C\r]+') AS words,
         row_number() OVER () AS rid
  FROM documents),
runs AS (SELECT rid, i, array_to_string(words[i : i + {WINDOW - 1}], ' ') AS run
  FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, run) AS n FROM runs) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^ \t\n\x0B\x0C\r]') GROUP BY rid),
m AS (SELECT w.rid, doc_id, lang, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[ \t\n\x0B\x0C\r]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(list_filter(list_zip(words[1 : len(words) - 1], words[2 : len(words)]), lambda p: p[1] = p[2]))::BIGINT AS n_again
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)),
long AS ({" UNION ALL ".join(f"SELECT lang, source, '{k}' AS name, 1000 * {a} // greatest({b}, 1) AS v FROM m WHERE n_words > 0" for k, (a, b) in RATES.items())}
  UNION ALL SELECT lang, source, '{LENGTH}', 100 * word_chars // n_words FROM m WHERE n_words > 0),
binned AS (SELECT lang, source, name, (((v >> s) + 1) << s) - 1 AS upper, count(*) AS n
  FROM (SELECT *, greatest(0, length(bin(v)) - {PRECISION})::BIGINT AS s FROM long) GROUP BY 1, 2, 3, 4),
parts AS (SELECT 0 AS level, * FROM binned UNION ALL SELECT 1, lang, NULL, name, upper, n FROM binned UNION ALL SELECT 2, NULL, NULL, name, upper, n FROM binned),
merged AS (SELECT level, lang, source, name, upper, sum(n) AS n FROM parts GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, name ORDER BY upper) AS c, sum(n) OVER (PARTITION BY level, lang, source, name) AS total FROM merged),
quart AS (SELECT level, lang, source, name, any_value(total)::BIGINT AS n, min(upper) FILTER (c * 100 >= total * 25) AS q25, min(upper) FILTER (c * 100 >= total * 50) AS q50,
    min(upper) FILTER (c * 100 >= total * 75) AS q75 FROM ranked GROUP BY 1, 2, 3, 4),
own AS (SELECT *, CASE WHEN name = '{LENGTH}' THEN q50 + {SPREAD} * (q50 - q25) ELSE least(q50 + {SPREAD} * (q50 - q25), greatest(q75, (q75 + 1000) // 2)) END AS high,
    CASE WHEN name = '{LENGTH}' THEN greatest(0, q50 - {SPREAD} * (q75 - q50)) END AS low FROM quart),
by_lang AS (SELECT l.lang, l.name, (l.high * l.n + w.high * {SHRINK}) // (l.n + {SHRINK}) AS high, (l.low * l.n + w.low * {SHRINK}) // (l.n + {SHRINK}) AS low
  FROM own l JOIN own w ON l.level = 1 AND w.level = 2 AND l.name = w.name),
lim AS (SELECT g.lang, g.source, g.name, (g.high * g.n + l.high * {SHRINK}) // (g.n + {SHRINK}) AS high, (g.low * g.n + l.low * {SHRINK}) // (g.n + {SHRINK}) AS low
  FROM own g JOIN by_lang l ON g.level = 0 AND g.name = l.name AND g.lang IS NOT DISTINCT FROM l.lang),
bad AS (SELECT DISTINCT rid FROM m JOIN lim ON m.lang IS NOT DISTINCT FROM lim.lang AND m.source IS NOT DISTINCT FROM lim.source
  WHERE n_words > 0 AND CASE name {" ".join(f"WHEN '{k}' THEN 1000 * {a} > high * {b} + {1000 * SLACK}" for k, (a, b) in RATES.items())} ELSE 100 * word_chars // n_words NOT BETWEEN low AND high END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
  (NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND bad.rid IS NULL) AS kept, n_lines, n_again
FROM m LEFT JOIN bad USING (rid)
"""

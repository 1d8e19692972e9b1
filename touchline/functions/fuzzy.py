"""Name similarity: trigram Jaccard, Jaro-Winkler, token-sort ratio, bands and hints."""

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.core import col


def trigrams(name: str | Column) -> Column:
    """Distinct trigrams of the words, each with two blanks ahead and one behind; other signs break words."""
    words = F.filter(F.split(F.regexp_replace(F.lower(col(name)), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    return F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))))


def similarity(a: str | Column, b: str | Column) -> Column:
    """Trigram Jaccard, 0 where both are empty."""
    x, y = trigrams(a), trigrams(b)
    return F.coalesce(F.size(F.array_intersect(x, y)) / F.nullif(F.size(F.array_union(x, y)).cast("double"), F.lit(0.0)), F.lit(0.0))


def similar_pairs(left: DataFrame, right: DataFrame, a: str, b: str, threshold: float) -> DataFrame:
    """Unblocked fuzzy join by an inverted trigram index: pairs that share enough trigrams, then verified.

    The index joins on trigrams, so no pair without a shared one is made; left and right need unique a and b.
    """
    x = left.select(a).distinct().withColumn("_g", trigrams(a))
    y = right.select(b).distinct().withColumn("_h", trigrams(b))
    met = x.select(a, F.explode("_g").alias("_t"), F.size("_g").alias("_n")).join(y.select(b, F.explode("_h").alias("_t"), F.size("_h").alias("_m")), "_t")
    shared = met.groupBy(a, b, "_n", "_m").agg(F.count("*").alias("_k"))
    return shared.withColumn("similarity", F.col("_k") / (F.col("_n") + F.col("_m") - F.col("_k"))).where(F.col("similarity") > threshold).select(a, b, "similarity")


def blocked_pairs(left: DataFrame, right: DataFrame, block: list[str], a: str, b: str, threshold: float, inclusive: bool = False) -> DataFrame:
    """Pairs within equal block keys whose names are similar beyond threshold (or at it, if inclusive)."""
    x = left.withColumn("_g", trigrams(a))
    y = right.withColumn("_h", trigrams(b))
    both = x.join(y, block).withColumn("similarity", F.size(F.array_intersect("_g", "_h")) / F.size(F.array_union("_g", "_h")).cast("double")).drop("_g", "_h")
    return both.where(F.col("similarity") >= threshold if inclusive else F.col("similarity") > threshold)


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, hits = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    other = [b[j] for j in range(len(b)) if used[j]]
    swaps = sum(x != y for x, y in zip(hits, other, strict=True)) // 2
    m = len(hits)
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def winkler(a: str, b: str) -> float:
    """Jaro with a boost of 0.1 per shared first letter (4 at most), given only above 0.7."""
    s = jaro(a, b)
    if s <= 0.7:
        return s
    p = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        p += 1
    return s + 0.1 * p * (1 - s)


def indel_ratio(a: str, b: str) -> float:
    """2 * longest common subsequence / total length."""
    if not a and not b:
        return 1.0
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], left + 1 if x == y else max(row[j], row[j - 1])
    return 2 * row[-1] / (len(a) + len(b))


def _by_pair(score):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else score(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return F.pandas_udf(run, "double")


def jaro_winkler(a: str | Column, b: str | Column) -> Column:
    return _by_pair(winkler)(col(a), col(b))


def indel(a: str | Column, b: str | Column) -> Column:
    return _by_pair(indel_ratio)(col(a), col(b))


def sorted_tokens(name: str | Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(col(name), r"\s+"), lambda w: w != "")), " ")


def token_sort_ratio(a: str | Column, b: str | Column) -> Column:
    return indel(sorted_tokens(a), sorted_tokens(b))


def working_confidence(jw: str | Column, ts: str | Column) -> Column:
    return F.least(col(jw), col(ts))


def band(confidence: str | Column) -> Column:
    c = col(confidence)
    return F.when(c == 1.0, "exact").when(c >= 0.8, "high").when(c >= 0.5, "review").otherwise("low")


def pair_hint(a: str | Column, b: str | Column) -> Column:
    """Why two normalized names may belong together; the first rule that holds."""
    x, y = col(a), col(b)
    s, t = F.split(x, " "), F.split(y, " ")
    same = lambda i: F.element_at(s, i) == F.element_at(t, i)
    tokens = lambda z: F.array_sort(F.array_distinct(z))
    return (
        F.when(x == y, "exact_after_normalize")
        .when(F.contains(y, x) | F.contains(x, y), "substring_match")
        .when((F.size(s) >= 2) & (F.size(t) >= 2) & same(1) & same(-1), "given_and_surname_match_extra_middle_token")
        .when(same(-1), "same_surname_diff_given_name")
        .when(same(1), "same_given_name_diff_surname")
        .when(tokens(s) == tokens(t), "same_tokens_reordered")
        .otherwise("other")
    )

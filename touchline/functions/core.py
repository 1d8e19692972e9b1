"""Scalar column functions: all built-in expressions, so they stay in generated code and push down."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pitch geometry (per cent of length and width).
DEF_THIRD, MID_THIRD = 33.3, 66.6
BOX_DEPTH, BOX_LOW, BOX_HIGH = 17.0, 21.1, 78.9


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(top: str | Column, bottom: str | Column) -> Column:
    """top / bottom, NULL where bottom is 0 or NULL."""
    return col(top) / F.nullif(col(bottom), F.lit(0))


def pct(top: str | Column, bottom: str | Column, digits: int = 1) -> Column:
    """100 top / bottom, rounded half to even as numeric Python does; NULL for an empty denominator."""
    return F.bround(F.when(col(bottom) > 0, 100.0 * col(top) / col(bottom)), digits)


def round_sql(c: str | Column, digits: int) -> Column:
    """Half away from zero, as decimal SQL rounding does."""
    return F.round(col(c), digits)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes NULL in every column."""
    return df.select(*[F.when(F.isnan(n), None).otherwise(F.col(n)).alias(n) if t in ("double", "float") else F.col(n) for n, t in df.dtypes])


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a NULL grouping key vanish."""
    return df.dropna(subset=keys)


def third(x: str | Column) -> Column:
    """def up to 33.3, mid up to 66.6, else att; NULL falls to att."""
    return F.when(col(x) <= DEF_THIRD, "def").when(col(x) <= MID_THIRD, "mid").otherwise("att")


def in_box(x: str | Column, y: str | Column, attacking: bool) -> Column:
    deep = col(x) >= 100.0 - BOX_DEPTH if attacking else col(x) <= BOX_DEPTH
    return F.coalesce(deep & col(y).between(BOX_LOW, BOX_HIGH), F.lit(False))


def enters_final_third(end_x: str | Column) -> Column:
    return F.coalesce(col(end_x) > MID_THIRD, F.lit(False))


def enters_box(end_x: str | Column, end_y: str | Column) -> Column:
    return in_box(end_x, end_y, attacking=True)


def has_qualifier(qualifiers: str | Column, names: list[str]) -> Column:
    """Whether an array<struct<type struct<displayName>>> holds one of names; NULL array: false."""
    return F.coalesce(F.exists(col(qualifiers), lambda q: q["type"]["displayName"].isin(names)), F.lit(False))


def season_code(season: str | Column) -> Column:
    """'2015-16' to '1516'."""
    return F.concat(F.substring(col(season), 3, 2), F.substring(col(season), 6, 2))


def season_start(season: str | Column) -> Column:
    """'2013-14' to 2013."""
    return F.split_part(col(season), F.lit("-"), F.lit(1)).cast("int")


def numeric_name(name: str | Column) -> Column:
    """Whether a name reads as a number (nan and inf included)."""
    return col(name).try_cast("double").isNotNull()


def identity_key(player_id: str | Column, player: str | Column) -> Column:
    """id:<id> where there is one, else name:<name>."""
    return F.coalesce(F.concat(F.lit("id:"), col(player_id).cast("string")), F.concat(F.lit("name:"), col(player)))


def money(text: str | Column) -> Column:
    """Millions in '€15.00m' or '€500k'; NULL for anything else."""
    bare = F.trim(F.regexp_replace(col(text), "€", ""))
    number = F.substring(bare, F.lit(1), F.length(bare) - 1).try_cast("double")
    return F.when(bare.endswith("m"), number).when(bare.endswith("k"), number / 1000)


def fee(text: str | Column) -> Column:
    """struct<amount double, type string> of a transfer's fee cell; nine kinds, or `unrecognized: ...`."""
    raw = col(text)
    t, low = F.trim(raw), F.lower(F.trim(raw))
    loan = money(F.trim(F.regexp_replace(t, "Loan fee", "")))
    none = F.lit(None).cast("double")
    as_ = lambda amount, kind: F.struct(amount.alias("amount"), kind.alias("type"))
    return (
        F.when(raw.isNull() | (raw == ""), as_(none, F.lit("empty_cell")))
        .when(t == "-", as_(none, F.lit("unknown")))
        .when(t == "?", as_(none, F.lit("unknown_historical")))
        .when(low == "end of loan", as_(none, F.lit("loan_ended")))
        .when(low == "free transfer", as_(F.lit(0.0), F.lit("free_transfer")))
        .when(low == "loan transfer", as_(none, F.lit("unpaid_loan")))
        .when(low.startswith("loan fee") & loan.isNotNull(), as_(loan, F.lit("paid_loan")))
        .when(low.startswith("loan fee"), as_(none, F.lit("paid_loan_undisclosed")))
        .when(money(t).isNotNull(), as_(money(t), F.lit("permanent_transfer")))
        .otherwise(as_(none, F.concat(F.lit("unrecognized: "), t)))
    )


def internal_promotion(club: str | Column) -> Column:
    return F.coalesce(col(club).rlike(r"\b(U1[6-9]|U2[0-3])\b"), F.lit(False))


def reserve_side(club: str | Column) -> Column:
    return F.coalesce(col(club).rlike(r"\b(U1[6-9]|U2[0-3])\b|\s(B|II)$|^Jong\s"), F.lit(False))


def first_match(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first rule that holds."""
    out = reduce(lambda acc, r: acc.when(r[0], r[1]) if acc is not None else F.when(r[0], r[1]), rules, None)
    return out.otherwise(otherwise) if out is not None else F.lit(otherwise)


def href_id(href: str | Column, part: str) -> Column:
    """The number after /part/ of a link, NULL without one."""
    return F.nullif(F.regexp_extract(col(href), f"/{part}/([0-9]+)", 1), F.lit("")).cast("long")


def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Letters without their marks, by Unicode's compatibility decompositions: one for one, and one for several."""
    one, several = {}, {}
    for code in [*range(0xA0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), *range(0x2C60, 0x2C80), *range(0xA720, 0xA800), *range(0xFB00, 0xFB07)]:
        c = chr(code)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if c.isalpha() and plain != c and c == c.lower() and plain:
            (one if len(plain) == 1 else several)[c] = plain
    return one, several


_ONE, _SEVERAL = _folds()
#: Combining marks, which a name in decomposed form holds.
_MARKS = "".join(chr(c) for c in range(0x300, 0x370))


def plain_name(name: str | Column) -> Column:
    """Lower case without accents, one blank between words; letters that Unicode does not decompose (ø, ł, ß, ı) stay."""
    low = F.translate(F.lower(col(name)), "".join(_ONE) + _MARKS, "".join(_ONE.values()))
    # only texts that hold such a letter are gone through again
    for c, plain in _SEVERAL.items():
        low = F.replace(low, F.lit(c), F.lit(plain))
    return F.trim(F.regexp_replace(low, r"\s+", " "))


def loose_club(name: str | Column) -> Column:
    """Lower case, hyphens as blanks, without the words fc, sc, vv."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(col(name)), "-", " "), r"\s+", " ")
    return F.trim(F.regexp_replace(bare, r"\b(fc|sc|vv)\b", ""))


def primary_position(positions: str | Column) -> Column:
    return F.nullif(F.upper(F.trim(F.split_part(col(positions), F.lit(","), F.lit(1)))), F.lit(""))


def per90(count: str | Column, nineties: str | Column) -> Column:
    return F.round(col(count) / F.nullif(col(nineties), F.lit(0)), 2)


def guarded(rate: str | Column, attempts: str | Column, least: int) -> Column:
    """rate only where attempts (NULL: 0) reach least."""
    return F.when(F.coalesce(col(attempts), F.lit(0)) >= least, col(rate))


def within(c: str | Column, low: float, high: float) -> Column:
    return F.when(col(c).between(low, high), col(c))


def with_prefix(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keys else F.col(c).alias(prefix + c) for c in df.columns])


def domain(column: str) -> str | None:
    """fbref, ws, tm or gk by a column's prefix."""
    return next((d for d in ("fbref", "ws", "tm", "gk") if column.startswith(d + "_")), None)


def any_of(columns: list[str], template: str) -> Column:
    """OR of a predicate template over columns."""
    return F.expr(" OR ".join(f"({template.format(c=c)})" for c in columns))


def height_cm(text: str | Column) -> Column:
    """'1,83 m' to 183."""
    got = F.regexp_extract(col(text), r"([0-9]+[,.][0-9]+)\s*m", 1)
    return F.round(F.regexp_replace(got, ",", ".").try_cast("double") * 100).cast("int")


def unpivot(df: DataFrame, ids: list[str], columns: list[str], name: str = "column_name", value: str = "value") -> DataFrame:
    """One row per id and column, values as double; one scan."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(ids, columns, name, value)

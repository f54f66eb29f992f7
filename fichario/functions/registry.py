"""Registry field functions: dates, amounts, keys, activity and city codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions.text import digits, is_blank, strip, zero_pad

_SHORT_DATE = r"^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])$"


def parse_date(c: Column) -> Column:
    """Yyyymmdd text to DATE; blank, all-zero and impossible dates give NULL.

    One-digit months and days (``2026131``) are read as well, longest month first.
    """
    text = F.nullif(strip(c), F.lit(""))
    year, month, day = (F.regexp_extract(text, _SHORT_DATE, i) for i in (1, 2, 3))
    padded = F.concat(year, F.lpad(month, 2, "0"), F.lpad(F.ltrim(day), 2, "0"))
    # Impossible months and days are sorted out here: a failed parse costs an exception.
    full = text.rlike(r"^\d{4}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])$")
    digits8 = F.when(full, text).when(year != "", padded)
    return F.when(~digits8.startswith("0000"), F.try_to_date(digits8, "yyyyMMdd"))


def parse_amount(c: Column) -> Column:
    """``1.234.567,89`` to DECIMAL(18,2); NULL means zero, unreadable text gives NULL."""
    plain = F.replace(F.coalesce(c, F.lit("0")), F.lit("."), F.lit(""))
    return F.replace(plain, F.lit(","), F.lit(".")).try_cast("decimal(18,2)")


def branch_key(root: Column, order: Column, check: Column) -> Column:
    """14-digit branch key from its three parts."""
    return F.concat_ws("", root, order, check)


def content_hash(columns: list[Column]) -> Column:
    """P5: SHA-256 over all cleaned columns joined by ``|``, NULL as empty text."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def normalize_cnae(c: Column) -> Column:
    """Short numeric activity codes are zero-padded to 7; NULL becomes empty text."""
    code = F.coalesce(strip(c), F.lit(""))
    return F.when(code.rlike("^[0-9]{1,6}$"), F.lpad(code, 7, "0")).otherwise(code)


def secondary_cnaes(c: Column) -> Column:
    """Comma list of activity codes as a set of 7-character codes."""
    codes = F.transform(F.split(F.coalesce(c, F.lit("")), ","), normalize_cnae)
    return F.array_distinct(F.filter(codes, lambda code: F.length(code) == 7))


def city_code(c: Column) -> Column:
    """City code trimmed and zero-padded to 4."""
    return zero_pad(F.coalesce(strip(c), F.lit("")), 4)


def state_code(c: Column) -> Column:
    return F.upper(F.coalesce(c, F.lit("")))


def phone_text(area: Column, number: Column) -> Column:
    """P10: area code and number in one text; empty, never NULL."""
    return F.concat_ws("", area, number)


def has_trade_name(c: Column) -> Column:
    """F4."""
    return ~is_blank(c)


def has_valid_phone(area: Column, number: Column) -> Column:
    """two-digit area code and a number of 8 digits or more that is not all zeros."""
    area_digits = digits(F.coalesce(area, F.lit("")))
    number_digits = digits(F.coalesce(number, F.lit("")))
    return (
        (F.length(area_digits) == 2)
        & (F.length(number_digits) >= 8)
        & number_digits.rlike("[1-9]")
    )


def size_band(porte: Column, mei: Column, simples: Column, capital: Column) -> Column:
    """First matching rule wins; STRUCT of band label and its source."""

    def band(label: str, source: str) -> Column:
        return F.struct(F.lit(label).alias("faixa"), F.lit(source).alias("fonte"))

    amount = F.coalesce(capital.cast("string").try_cast("double"), F.lit(0.0))
    rule = F.when(mei == "S", band(K.BAND_MEI, K.BAND_SOURCE_REGISTRY))
    for code, label in K.BAND_BY_PORTE.items():
        rule = rule.when(porte == code, band(label, K.BAND_SOURCE_REGISTRY))
    return (
        rule.when(simples == "S", band(K.BAND_SIMPLES, K.BAND_SOURCE_REGISTRY))
        .when(amount >= 10_000_000, band(K.BAND_CAPITAL_HIGH, K.BAND_SOURCE_CAPITAL))
        .when(amount >= 1_000_000, band(K.BAND_CAPITAL_MEDIUM, K.BAND_SOURCE_CAPITAL))
        .otherwise(band(K.BAND_UNKNOWN, K.BAND_SOURCE_LOCAL))
    )

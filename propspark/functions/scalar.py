"""Scalar column functions.

Every function takes and returns ``Column`` expressions built only from
``pyspark.sql.functions``, so they stay inside whole-stage codegen.
Column arguments may be names or Columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from propspark.constants import FRENCH_MONTHS, IMAGE_PATH_FORMAT, PERSONS_PER_HOUSEHOLD


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1 -------------------------------------------------------------------------
def clean_numeric(c, mode: str = "strict", junk_replacement: str = "0") -> Column:
    """Text number -> DOUBLE.

    ``strict`` (default): a decimal comma becomes a dot, blanks are removed,
    anything else that is not a number gives NULL.
    ``substitute``: every character outside ``[0-9.]`` is replaced in place by
    ``junk_replacement`` (``"12,5"`` -> ``"120.000015"`` for ``"0.00001"``),
    then cast; the result is NULL if the cast fails.  NULL stays NULL.
    """
    c = _c(c)
    if mode == "strict":
        txt = F.regexp_replace(F.replace(c.cast("string"), F.lit(","), F.lit(".")), r"\s", "")
        # Keep only plain decimal literals; Spark would accept '1d' / '5f'.
        ok = txt.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$")
        return F.when(ok, txt.try_cast("double"))
    if mode == "substitute":
        txt = F.regexp_replace(c.cast("string"), "[^0-9.]", junk_replacement)
        ok = txt.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$")
        return F.when(ok, txt.try_cast("double"))
    raise ValueError(f"unknown mode {mode!r}")


# F2 F3 F4 -------------------------------------------------------------------
def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Strict date parse; unparsable text gives NULL."""
    c = _c(c)
    return F.try_to_date(c.cast("string"), fmt) if fmt else F.to_date(c)


def month_key(c) -> Column:
    """``YYYY-MM`` text of a date."""
    return F.date_format(_c(c), "yyyy-MM")


def year_of(c) -> Column:
    return F.year(_c(c))


# F5 -------------------------------------------------------------------------
def french_month_to_date(c, fail_on_unknown: bool = True) -> Column:
    """``"févr. 2015"`` -> DATE 2015-02-01.

    Unknown month labels or a label that is not two words raise (as the source
    pipeline does) unless ``fail_on_unknown=False``, which gives NULL.
    Built from cheap string functions (no array split): the optimizer may
    push a date filter on the result below an aggregation, where it runs
    once per input row.
    """
    c = F.trim(_c(c))
    pairs = []
    for k, v in FRENCH_MONTHS.items():
        pairs += [F.lit(k), F.lit(v)]
    month = F.element_at(F.create_map(*pairs), F.substring_index(c, " ", 1))
    yr = F.substring_index(c, " ", -1).try_cast("int")
    ok = c.rlike(r"^\S+ +[0-9]+$") & month.isNotNull()
    value = F.make_date(yr, month, F.lit(1))
    if fail_on_unknown:
        return F.when(c.isNull(), F.lit(None).cast("date")).when(ok, value).otherwise(
            F.raise_error(F.concat(F.lit("unrecognised month label: "), c)).cast("date"))
    return F.when(ok, value)


# F6 -------------------------------------------------------------------------
def comma_decimal(c) -> Column:
    """First ``,`` becomes ``.``, then cast to DOUBLE (bad text -> NULL)."""
    c = _c(c).cast("string")
    txt = F.regexp_replace(c, "^([^,]*),", "$1.")
    ok = F.trim(txt).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return F.when(ok, F.trim(txt).try_cast("double"))


# F22 ------------------------------------------------------------------------
def sql_round(c, scale: int = 2) -> Column:
    """ROUND of a DOUBLE the way SQL engines do it: scale by 10^d in floating
    point, round half away from zero, scale back.  ``F.round`` rounds the
    exact decimal value instead, which differs on binary ties such as
    985.4 / 40 = 24.634999999999998 (SQL: 24.64, F.round: 24.63)."""
    k = float(10 ** scale)
    return F.round(_c(c).cast("double") * F.lit(k)) / F.lit(k)


# F7 F8 ----------------------------------------------------------------------
def safe_ratio(num, den, scale: int | None = None) -> Column:
    """num / den, NULL when den is 0 or NULL (no inf, no ANSI error)."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return sql_round(r, scale) if scale is not None else r


# F9 -------------------------------------------------------------------------
def department_prefix(code) -> Column:
    """3 characters for overseas codes starting 97/98, else 2."""
    code = _c(code).cast("string")
    return (F.when(F.substring(code, 1, 2).isin("97", "98"), F.substring(code, 1, 3))
            .otherwise(F.substring(code, 1, 2)))


# F10 ------------------------------------------------------------------------
def is_missing(c) -> Column:
    """NULL or NaN counts as missing."""
    c = _c(c)
    return c.isNull() | F.isnan(c)


def missing_flag(c) -> Column:
    return is_missing(c).cast("int")


def fill_missing(c, value) -> Column:
    c = _c(c)
    return F.when(is_missing(c), F.lit(value).cast("double")).otherwise(c)


# F12 ------------------------------------------------------------------------
def households_from_population(pop, persons: float = PERSONS_PER_HOUSEHOLD) -> Column:
    return F.round(_c(pop).cast("double") / F.lit(persons)).cast("int")


# F13 F14 --------------------------------------------------------------------
def natural_log(c) -> Column:
    return F.ln(_c(c).cast("double"))


def one_hot(c, value) -> Column:
    """1 when ``c == value``, 0 otherwise, NULL when c is NULL."""
    return (_c(c) == F.lit(value)).cast("int")


# F15 F16 --------------------------------------------------------------------
def band(c, bands, otherwise) -> Column:
    """Chained CASE on ``c < bound``.  A NULL value falls into ``otherwise``."""
    c = _c(c)
    expr = None
    for bound, label in bands:
        expr = (F.when(c < F.lit(bound), F.lit(label)) if expr is None
                else expr.when(c < F.lit(bound), F.lit(label)))
    return expr.otherwise(F.lit(otherwise))


def label_if(cond: Column, yes: str, no: str) -> Column:
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


# F17 ------------------------------------------------------------------------
def truthy_int(c) -> Column:
    """Truthiness of a boolean, number or text column as 0/1: false, 0, empty
    text and NULL -> 0, anything else -> 1 (so the texts "0" and "false" -> 1).
    A field whose JSON type varies needs ``truthy_variant``."""
    c = _c(c)
    text, kind = c.cast("string"), F.typeof(c)
    yes = (F.when(kind == "string", F.length(text) > 0)
           .when(kind == "boolean", text == "true")
           .otherwise(F.coalesce(text.try_cast("double") != 0, text.isNotNull())))
    return F.coalesce(yes, F.lit(False)).cast("int")


def truthy_variant(v) -> Column:
    """Truthiness of a VARIANT column (a JSON value with its type) as 0/1:
    missing, null, false, 0, "", [] and {} -> 0, anything else -> 1."""
    v = _c(v)
    kind = F.schema_of_variant(v)
    yes = (F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
           .when(kind == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
           .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~F.to_json(v).isin("[]", "{}"))
           .when(kind == "VOID", False)
           .otherwise(F.try_variant_get(v, "$", "double") != 0))
    return F.coalesce(yes, F.lit(False)).cast("int")


# F18 F20 --------------------------------------------------------------------
def tolerant_float(c) -> Column:
    """Missing, empty or non-numeric -> NULL, else DOUBLE."""
    txt = F.trim(_c(c).cast("string"))
    ok = txt.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return F.when(ok, txt.try_cast("double"))


def empty_to_null_double(c) -> Column:
    return tolerant_float(c)


# F19 ------------------------------------------------------------------------
_PRICE_OBJECT = "value DOUBLE, commission DOUBLE"


def polymorphic_price(raw) -> Column:
    """A field given as JSON text that is a number or an object
    ``{value, commission}`` (one JSON parse per row).

    Number -> itself.  Object -> ``value`` unless it is 0 or missing, then
    ``commission``.  Anything else -> NULL.
    """
    txt = _c(raw)
    obj = F.from_json(txt, _PRICE_OBJECT)
    return F.coalesce(tolerant_float(txt), F.nullif(obj["value"], F.lit(0.0)), obj["commission"])


def polymorphic_value(raw) -> Column:
    """Number -> itself; object -> its ``value``."""
    txt = _c(raw)
    return F.coalesce(tolerant_float(txt), F.from_json(txt, _PRICE_OBJECT)["value"])


# F21 ------------------------------------------------------------------------
def image_path(listing_id, n) -> Column:
    """``<id>/image_<n>.jpg``."""
    return F.format_string(IMAGE_PATH_FORMAT, _c(listing_id).cast("string"), _c(n).cast("int"))


# F24 ------------------------------------------------------------------------
def name_or_empty(tags, key: str = "name") -> Column:
    return F.coalesce(F.element_at(_c(tags), F.lit(key)), F.lit(""))

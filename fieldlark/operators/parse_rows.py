"""Delimited text rows: typed rows on one side, rows that break the contract on the other.

Every field is first held as nullable text; the constraint rules are column
expressions that add to one error array per row; a row is valid when that array is
empty. One narrow pass without a shuffle; both outputs are filters over the same scan.

Defined results
- NULL line: error ``line:null``. Empty line: one empty field, so ``line:field_count``.
- A line whose quoting is broken has only ``line:quoting``; one with a wrong number of
  fields has only ``line:field_count`` (its values have no names to be checked under).
- Repeated lines are separate rows and get the same result. Very long lines are scanned
  by possessive patterns, whose matching does not recurse.
- Columns of the input are kept, unless a parsed field has the same name, which wins;
  ``errors``, if taken, is replaced as well.
- Empty input: empty outputs of the same schemas.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mean a missing value.
MISSING = ("", "NULL", "null", "NA", "na", "N/A", "n/a")

NUMBER = r"\A[+-]?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?\z"
MOMENT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}(?:T(?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9])?)?Z?\z"


@dataclass(frozen=True)
class Field:
    """One field of the contract. kind: text, digits, decimal, pattern or period."""

    name: str
    kind: str = "text"
    required: bool = False
    low: float | None = None
    high: float | None = None
    pattern: str = ""
    positive: bool = False


@dataclass(frozen=True)
class Contract:
    fields: Sequence[Field]
    separator: str = "\t"
    missing: Sequence[str] = field(default=MISSING)
    # A character that may enclose a whole field, or none: then no character is special but the separator.
    quote: str = '"'


OCCURRENCE = Contract(
    (
        Field("gbifID", "digits", required=True, positive=True),
        Field("occurrenceID"),
        Field("datasetKey"),
        Field("basisOfRecord"),
        Field("acceptedTaxonKey", "digits"),
        Field("scientificName"),
        Field("taxonRank"),
        Field("countryCode", "pattern", pattern=r"\A[A-Z]{2}\z"),
        Field("decimalLatitude", "decimal", low=-90, high=90),
        Field("decimalLongitude", "decimal", low=-180, high=180),
        Field("eventDate", "period"),
        Field("locality"),
    )
)


def _patterns(separator: str, quote: str) -> tuple[str, str]:
    sep, q = ("\\x{%x}" % ord(c) for c in (separator, quote))
    quoted, plain = f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}", f"[^{q}{sep}]*+"
    one = f"(?:{quoted}|{plain})"
    return rf"\A{one}(?:{sep}{one})*+\z", f"{sep}({quoted}|{plain})"


def _day(value: Column) -> Column:
    """The calendar day of a moment, NULL if the text is none (year 0 is no year)."""
    day = F.substring(value, 1, 10).try_cast("date")
    return F.when(value.rlike(MOMENT) & (F.substring(value, 1, 4) != "0000"), day)


def _rules(f: Field, v: Column) -> list[Column]:
    """Error texts of one field, each NULL where its rule holds."""

    def err(cond: Column, what: str) -> Column:
        return F.when(cond, F.lit(f"{f.name}:{what}"))

    out = [err(v.isNull(), "missing")] if f.required else []
    if f.kind == "digits":
        ok = v.rlike(r"\A[0-9]{1,18}\z")
        out.append(err(~ok, "not_digits"))
        if f.positive:
            out.append(err(ok & (v.try_cast("bigint") <= 0), "not_positive"))
    elif f.kind == "decimal":
        ok = v.rlike(NUMBER)
        out += [err(~ok, "not_a_number"), err(ok & ~v.try_cast("double").between(f.low, f.high), "out_of_range")]
    elif f.kind == "pattern":
        out.append(err(~v.rlike(f.pattern), "pattern"))
    elif f.kind == "period":
        parts = F.split(v, "/", -1)
        first, last = _day(parts[0]), _day(F.try_element_at(parts, F.lit(2)))
        n = F.size(parts)
        out += [
            err(v.isNotNull() & ((n > 2) | first.isNull() | ((n == 2) & last.isNull())), "not_a_date"),
            err((n == 2) & (first > last), "reversed"),
        ]
    return out


def _typed(f: Field, v: Column) -> list[Column]:
    if f.kind == "digits":
        return [v.try_cast("bigint").alias(f.name)]
    if f.kind == "decimal":
        return [F.when(v.rlike(NUMBER), v.try_cast("double")).alias(f.name)]
    if f.kind == "period":
        parts = F.split(v, "/", -1)
        return [
            v.alias(f.name),
            _day(parts[0]).alias(f"{f.name}_first"),
            F.coalesce(_day(F.try_element_at(parts, F.lit(2))), _day(parts[0])).alias(f"{f.name}_last"),
        ]
    return [v.alias(f.name)]


def _once(df: DataFrame, what: Column) -> DataFrame:
    """``df`` with one more column that is computed once for each row: filters and later
    columns refer to the output of a generator instead of repeating the expression."""
    return df.select("*", F.inline(F.array(F.struct(what))))


def check_lines(df: DataFrame, line: str, contract: Contract = OCCURRENCE) -> DataFrame:
    """``df`` plus one nullable text column for each field and ``errors``."""
    names = [f.name for f in contract.fields]
    taken = {n.lower() for n in [*names, "errors"]} - {line.lower()}
    raw, values = "__line", "__values"
    text, quote = F.col(raw), contract.quote
    base = df.select(F.col(line).alias(raw), *[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
    plain = F.split(text, "\\x{%x}" % ord(contract.separator), -1)
    if quote:
        whole, one = _patterns(contract.separator, quote)
        bare = ~F.contains(text, F.lit(quote))
        cells = F.when(bare, plain).when(text.rlike(whole), F.regexp_extract_all(F.concat(F.lit(contract.separator), text), F.lit(one), F.lit(1)))
    else:
        cells = plain

    def clean(x: Column) -> Column:
        if quote:
            x = F.when(x.startswith(quote), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit(2 * quote), F.lit(quote))).otherwise(x)
        return F.trim(x)

    def present(x: Column) -> Column:
        return F.when(~x.isin(*contract.missing), x)

    base = _once(base, F.transform(F.transform(cells, clean), present).alias(values))
    fits = F.size(values) == len(names)
    base = base.withColumns({n: F.when(fits, F.get(F.col(values), F.lit(i))) for i, n in enumerate(names)})
    checks = [e for f in contract.fields for e in _rules(f, F.col(f.name))]
    errors = (
        F.when(text.isNull(), F.array(F.lit("line:null")))
        .when(F.col(values).isNull(), F.array(F.lit("line:quoting")))
        .when(~fits, F.array(F.lit("line:field_count")))
        .otherwise(F.array_compact(F.array(*checks)))
    )
    return _once(base, errors.alias("errors")).drop(values, raw)


def valid_rows(df: DataFrame, line: str, contract: Contract = OCCURRENCE) -> DataFrame:
    """The rows without errors, each field in its type; periods also as first and last day."""
    checked = check_lines(df, line, contract)
    names = {f.name for f in contract.fields}
    keep = [F.col(f"`{c}`") for c in checked.columns if c not in names and c not in ("errors", line)]
    typed = [t for f in contract.fields for t in _typed(f, F.col(f.name))]
    return checked.where(F.size("errors") == 0).select(*keep, *typed)


def broken_rows(df: DataFrame, line: str, contract: Contract = OCCURRENCE) -> DataFrame:
    """The rows with errors: the columns of ``df`` and ``errors``."""
    checked = check_lines(df, line, contract)
    mine = {f.name for f in contract.fields} - set(df.columns)
    return checked.where(F.size("errors") > 0).drop(*mine)

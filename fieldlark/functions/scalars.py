"""Column expressions over text, URLs, hashes, numbers and statuses. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands between the values of a row, and for a missing one, in row digests.
UNIT = "\x1f"
NO_VALUE = "<NULL>"
# Fixed value: the order of severity of check statuses.
SEVERITY = ("CONFLICT", "FAIL", "UNKNOWN", "NOT_TESTED", "PASS")


def nonblank(c: Column) -> Column:
    """Text without outer spaces; blank becomes NULL."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def stripped(c: Column) -> Column:
    """Text without any outer white space; blank becomes NULL."""
    return F.nullif(F.regexp_replace(c.cast("string"), r"^\s+|\s+$", ""), F.lit(""))


def first_known(*cs: Column, missing: str = "<MISSING>") -> Column:
    return F.coalesce(*[nonblank(c) for c in cs], F.lit(missing))


def meaningful(c: Column, sentinels: Sequence[str]) -> Column:
    """Whether a value says something: not blank and none of the sentinels, whatever the case."""
    return F.coalesce(nonblank(c).isNotNull() & ~F.lower(F.trim(c.cast("string"))).isin(*[s.lower() for s in sentinels]), F.lit(False))


def in_vocabulary(c: Column, words: Sequence[str]) -> Column:
    return F.lower(F.trim(c.cast("string"))).isin(*[w.lower() for w in words])


def ladder(*steps: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The text of the first condition that holds."""
    out = reduce(lambda acc, s: acc.when(s[0], s[1]), steps[1:], F.when(steps[0][0], steps[0][1]))
    return out.otherwise(otherwise) if otherwise is not None else out


def worst_status(statuses: Sequence[Column]) -> Column:
    """CONFLICT before FAIL before UNKNOWN (or NOT_TESTED) before PASS."""
    all_ = F.array(*statuses)
    return ladder(
        (F.array_contains(all_, "CONFLICT"), "CONFLICT"),
        (F.array_contains(all_, "FAIL"), "FAIL"),
        (F.exists(all_, lambda s: s.isin("UNKNOWN", "NOT_TESTED")), "UNKNOWN"),
        otherwise="PASS",
    )


def distinct_from(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def reasons(named: Mapping[str, Column]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in named.items()]))


def row_text(*cs: Column) -> Column:
    """The text of a row that its digest is made of."""
    return F.concat_ws(UNIT, *[F.coalesce(c.cast("string"), F.lit(NO_VALUE)) for c in cs])


def tagged_hash(kind: str | None, c: Column) -> Column:
    """``sha256:`` and the digest of a value, under a kind so that groups of kinds differ."""
    text = c if kind is None else F.concat(F.lit(f"{kind}|"), c)
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def hash_order(seed: str, *cs: Column) -> Column:
    """A reproducible order that looks random: the digest of seed and key."""
    return F.sha2(F.concat_ws(":", F.lit(seed), *[c.cast("string") for c in cs]), 256)


def _url_parts(c: Column) -> tuple[Column, Column, Column]:
    """Scheme and authority in lower case and all that follows the authority, of the text before
    any fragment. No pattern is needed: a URL is cut at its first ``#``, ``://``, ``/`` and ``?``."""
    bare = F.substring_index(F.trim(c), "#", 1)
    scheme = F.lower(F.substring_index(bare, "://", 1))
    tail = F.when(F.contains(bare, F.lit("://")), F.substring(bare, F.length(scheme) + 4, F.length(bare))).otherwise("")
    authority = F.substring_index(F.substring_index(tail, "/", 1), "?", 1)
    return scheme, F.lower(authority), F.substring(tail, F.length(authority) + 1, F.length(tail))


# The schemes of web addresses and the port each stands for.
WEB_PORTS = {"http": ":80", "https": ":443"}


def canonical_url(c: Column) -> Column:
    """The form in which spellings of one web address meet: scheme and host in lower case, no
    default port, no fragment, and a path of at least ``/``. NULL for all else."""
    scheme, authority, rest = _url_parts(c)
    path = F.coalesce(F.nullif(rest, F.lit("")), F.lit("/"))
    forms = [
        F.when((scheme == s) & (authority != ""), F.concat(F.lit(f"{s}://"), F.when(authority.endswith(port), F.substring(authority, F.lit(1), F.length(authority) - len(port))).otherwise(authority), path))
        for s, port in WEB_PORTS.items()
    ]
    return F.coalesce(*forms)


def url_status(c: Column) -> Column:
    """PASS for a web address with a host, without user and with a port up to 65535 if any."""
    scheme, authority, _ = _url_parts(c)
    port = F.substring_index(authority, ":", -1)
    ported = F.contains(authority, F.lit(":")) & port.rlike("^[0-9]+$")
    ok = scheme.isin(*WEB_PORTS) & (authority != "") & ~F.contains(authority, F.lit("@")) & (~ported | F.coalesce(port.try_cast("int") <= 65535, F.lit(False)))
    return ladder((nonblank(c).isNull(), "UNKNOWN"), (ok, "PASS"), otherwise="FAIL")


def platform(c: Column) -> Column:
    """The host (and port) that an address of any scheme names; NULL without one."""
    return F.nullif(_url_parts(c)[1], F.lit(""))


def format_status(kind: Column, mime: Column) -> Column:
    """Whether a media type and its MIME type go together."""
    # Media types and the MIME prefix each goes with.
    prefix = F.when(F.lower(F.trim(kind)) == "stillimage", "image/").when(F.lower(F.trim(kind)) == "movingimage", "video/").when(F.lower(F.trim(kind)) == "sound", "audio/")
    m = F.lower(nonblank(mime))
    return ladder((m.isNull() | prefix.isNull(), "UNKNOWN"), (m.startswith(prefix), "PASS"), otherwise="CONFLICT")


def csv_safe(c: Column) -> Column:
    """Text that a spreadsheet won't run as a formula."""
    return F.when(c.rlike(r"^[=+@\-]"), F.concat(F.lit("'"), c)).otherwise(c)


def decade(year: Column) -> Column:
    """The first year of the decade, as a whole number."""
    return (F.floor(year.try_cast("double") / 10) * 10).cast("bigint")


def binomial(c: Column) -> Column:
    """Genus and epithet of a scientific name, NULL unless both look like names."""
    t = F.split(F.trim(c), r"\s+")
    a, b = F.get(t, F.lit(0)), F.get(t, F.lit(1))
    return F.when(a.rlike("^[A-Z][a-z-]+$") & b.rlike("^[a-z][a-z-]+$"), F.concat_ws(" ", a, b))


def keyword_flags(c: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """The groups of which some keyword occurs as a whole word, in order."""
    return F.array_compact(F.array(*[F.when(F.lower(c).rlike(r"\b(?:" + "|".join(ws) + r")\b"), F.lit(g)) for g, ws in groups.items()]))


def split_flags(c: Column, by: str = ";") -> Column:
    """Distinct non-empty parts of a list in text, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), by), lambda x: F.trim(x)), lambda x: x != "")))


# ---- dates



def _shape(c: Column) -> Column:
    """The text with a 9 for every digit, so that forms of dates compare as plain texts."""
    return F.translate(c, "012345678", "999999999")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _clock(day_text: Column, clock: Column) -> Column:
    """Whether text after the T is a clock, whether it has a zone, and the moment."""

    def read(shape: Column) -> Column:
        zone = F.when(clock.endswith("Z"), 1).when(F.right(shape, F.lit(6)).isin("+99:99", "-99:99"), 6).otherwise(0)
        return let(F.struct(F.left(clock, F.length(clock) - zone).alias("plain"), F.left(shape, F.length(shape) - zone).alias("shape"), F.right(clock, zone).alias("zone")), judge)

    def judge(x: Column) -> Column:
        whole, part = F.left(x["shape"], F.lit(8)), F.substring(x["shape"], 9, 99)
        formed = (x["shape"] == "99:99") | ((whole == "99:99:99") & ((part == "") | (F.length(part).between(2, 7) & (F.rtrim(part, F.lit("9")) == "."))))
        seconds = F.when(F.length(x["plain"]) == 5, ":00").otherwise("")
        return F.struct(formed.alias("formed"), (x["zone"] != "").alias("zoned"), F.concat(day_text, F.lit(" "), x["plain"], seconds, x["zone"]).try_cast("timestamp").alias("instant"))

    return let(_shape(clock), read)


def _boundary(c: Column) -> Column:
    """One date or moment: ``formed`` (written as a full day, or a day, T and a clock), ``timed``,
    ``zoned``, its ``day`` (NULL if the calendar or the clock has none) and its ``instant``."""
    timed = F.contains(c, F.lit("T"))
    day_text = F.substring_index(c, "T", 1)
    no = F.lit(False)

    def put(k: Column) -> Column:
        day = F.when(~day_text.startswith("0000"), day_text.try_cast("date"))
        formed = (_shape(day_text) == "9999-99-99") & (~timed | k["formed"])
        return F.struct(F.coalesce(formed, no).alias("formed"), F.coalesce(timed, no).alias("timed"), F.coalesce(k["zoned"], no).alias("zoned"), F.when(~timed | k["instant"].isNotNull(), day).alias("day"), k["instant"].alias("instant"))

    return let(_clock(day_text, F.when(timed, F.substring(c, F.instr(c, "T") + 1, F.length(c)))), put)


def day_of(c: Column) -> Column:
    """The calendar day of a full date or moment, NULL for partial dates and all else."""
    return let(_boundary(c), lambda x: F.when(x["formed"], x["day"]))


def _partial(c: Column) -> Column:
    """Whether the text is a year, or a year and a month."""
    return F.coalesce(_shape(c).isin("9999", "9999-99"), F.lit(False))


def _partial_exists(c: Column) -> Column:
    return F.concat(c, F.when(F.length(c) == 4, F.lit("-01-01")).otherwise(F.lit("-01"))).try_cast("date").isNotNull() & ~c.startswith("0000")


def event_date_status(c: Column) -> Column:
    """PASS, FAIL or UNKNOWN for year, month, day, moment and intervals of two of them."""
    t = stripped(c)

    def judge(ends: Column) -> Column:
        # One struct an end: whether it is sound, and its day if it is a full one.
        read = F.transform(ends, lambda e: let(day_of(e), lambda d: F.struct(F.when(_partial(e), _partial_exists(e)).otherwise(d.isNotNull()).alias("sound"), d.alias("day"))))
        return let(read, lambda r: (F.size(r) <= 2) & F.forall(r, lambda x: x["sound"]) & ~F.coalesce(F.get(r, F.lit(0))["day"] > F.get(r, F.lit(1))["day"], F.lit(False)))

    return ladder((t.isNull(), "UNKNOWN"), (let(F.split(t, "/", -1), judge), "PASS"), otherwise="FAIL")


def derived_components(event_date: Column, year: Column, month: Column, day: Column) -> Column:
    """Year, month and day that a strict event date can fill where they are blank, with a
    status. Intervals give their first day; what is there is never replaced."""
    names = ("year", "month", "day")
    raw, have = stripped(event_date), {"year": stripped(year), "month": stripped(month), "day": stripped(day)}

    def judge(x: Column) -> Column:
        raw, n, start, stop = x["raw"], x["n"], x["start"], x["stop"]
        interval, clocks = n == 2, start["timed"] & stop["timed"]
        said = {"year": F.year(start["day"]), "month": F.month(start["day"]), "day": F.dayofmonth(start["day"])}
        contradicted = [x[k].isNotNull() & ~F.coalesce(x[k].try_cast("int") == said[k], F.lit(False)) for k in names]
        turned = F.when(clocks, start["instant"] > stop["instant"]).otherwise(start["day"] > stop["day"])
        # The names of the statuses and methods.
        wrong = lambda e: F.when(~e["formed"], "unsupported_format").when(e["day"].isNull(), "invalid_calendar_date")
        # Each step speaks only where those before it are silent.
        status = F.coalesce(
            F.when(reduce(lambda a, b: a & b, [x[k].isNotNull() for k in names]), "not_needed"),
            F.when(raw.isNull(), "missing_event_date"),
            F.when(_partial(raw), F.when(_partial_exists(raw), "insufficient_precision").otherwise("invalid_calendar_date")),
            F.when(n > 2, "unsupported_format"),
            wrong(start),
            F.when(interval, F.coalesce(wrong(stop), F.when(clocks & (start["zoned"] != stop["zoned"]), "unsupported_format").when(turned, "reversed_interval"))),
            F.when(reduce(lambda a, b: a | b, contradicted), "existing_component_conflict"),
            F.when(x["year"].isNull() & (said["year"] < 1960), "excluded_pre_1960"),
            F.lit("derived"),
        )
        method = F.concat_ws("_", F.lit("event_date"), F.when(interval, "interval_start").otherwise("single"), F.when(start["timed"], "timestamp").otherwise("date"))
        found = F.struct(*[F.when(x[k].isNull(), said[k]).alias(k) for k in names], method.alias("method"))

        def give(s: Column) -> Column:
            used = s["status"].isin("derived", "excluded_pre_1960")
            return F.struct(*[F.when(used, s["found"][k]).alias(f"derived_{k}") for k in names], F.when(used, s["found"]["method"]).alias("method"), s["status"].alias("status"))

        return let(F.struct(status.alias("status"), found.alias("found")), give)

    def read(ends: Column) -> Column:
        end = lambda i: _boundary(F.trim(F.get(ends, F.lit(i))))
        return let(F.struct(raw.alias("raw"), F.size(ends).alias("n"), end(0).alias("start"), end(1).alias("stop"), *[have[k].alias(k) for k in names]), judge)

    return let(F.split(raw, "/", -1), read)


# ---- numbers


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def wilson(successes: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Lower and upper end of Wilson's interval of a proportion; NULL for no trials."""
    p, n = ratio(successes, n), n.cast("double")
    middle = F.try_divide(p + F.try_divide(F.lit(z * z / 2), n), 1 + F.try_divide(F.lit(z * z), n))
    half = F.try_divide(F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(z * z / 4), n * n)) * z, 1 + F.try_divide(F.lit(z * z), n))
    return F.greatest(F.lit(0.0), middle - half), F.least(F.lit(1.0), middle + half)


def band(c: Column, width: float) -> Column:
    """The number of the band of a value, a whole number that can be hashed and compared."""
    return F.floor(c / width).cast("bigint")

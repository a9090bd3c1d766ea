"""Functions that SQL lacks (Unicode folding, exact byte fingerprints, text mining), as
Arrow-batched UDFs, and licence terms, which stay in the JVM."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlark.functions.scalars import let

# Marks that are written in several ways, and marks that blanks may surround.
HYPHENS, SINGLE_QUOTES, DOUBLE_QUOTES = "‐‑‒–—−", "‘’‚‛", "“”„"
CLOSE_MARKS = ",;:/()-"
_PLAIN = {ord(c): plain for marks, plain in ((HYPHENS, "-"), (SINGLE_QUOTES, "'"), (DOUBLE_QUOTES, '"')) for c in marks}
_AT_MARKS = re.compile("([" + re.escape(CLOSE_MARKS) + "])")


def fold_name(value: str | None) -> str | None:
    """The key of one name; None for a blank one."""
    if value is None:
        return None
    text = " ".join(unicodedata.normalize("NFKC", value).translate(_PLAIN).split())
    return "".join(piece.strip() for piece in _AT_MARKS.split(text)).casefold() or None


@F.pandas_udf(T.StringType())
def name_key(names: pd.Series) -> pd.Series:
    """The key under which spellings of a name meet: NFKC, plain marks without blanks around
    them, one blank between words, folded case."""
    return names.map(fold_name, na_action="ignore")


# Three-letter codes of languages that also have two letters.
_TWO = {"eng": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es", "por": "pt", "jpn": "ja", "ita": "it", "nld": "nl", "dut": "nl", "rus": "ru", "zho": "zh", "chi": "zh"}


def language_tag(c: Column) -> Column:
    """``language, script, region, tag`` of a language tag, NULL where it names no language.
    Parts may stand in any order after the language and be divided by ``-`` or ``_``."""
    parts = F.split(F.replace(F.trim(c), F.lit("_"), F.lit("-")), "-")
    first = F.lower(F.get(parts, F.lit(0)))
    letters = lambda x, n: (F.length(x) == n) & (F.translate(F.lower(x), "abcdefghijklmnopqrstuvwxyz", "") == "")
    digits = lambda x: (F.length(x) == 3) & (F.translate(x, "0123456789", "") == "")
    language = F.when(letters(first, 2) | letters(first, 3), F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in _TWO.items() for x in kv]), first), first))
    rest = F.slice(parts, 2, 99)
    pick = lambda test: F.get(F.filter(rest, test), F.lit(0))
    script = F.when(language.isNotNull(), F.initcap(pick(lambda x: letters(x, 4))))
    region = F.when(language.isNotNull(), F.upper(pick(lambda x: letters(x, 2) | digits(x))))
    return F.struct(language.alias("language"), script.alias("script"), region.alias("region"), F.nullif(F.concat_ws("-", language, script, region), F.lit("")).alias("tag"))


def canonical_json(value: object) -> str:
    """The one text of a JSON value: keys sorted, no blanks, numbers told apart from text and
    whole numbers from others. Keys that are not text and non-finite numbers are refused."""

    def check(x: object) -> None:
        if isinstance(x, dict):
            if not all(isinstance(k, str) for k in x):
                raise TypeError("keys must be text")
            x = list(x.values())
        if isinstance(x, (list, tuple)):
            for v in x:
                check(v)

    check(value)
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def fingerprint(value: object) -> str:
    """``sha256:`` and the digest of the canonical JSON: equal for equal values only. A design
    of its own, whose digests are comparable only with each other."""
    return "sha256:" + hashlib.sha256(canonical_json(value).encode("utf-8", "surrogatepass")).hexdigest()


@F.pandas_udf(T.StringType())
def json_fingerprint(texts: pd.Series) -> pd.Series:
    """The fingerprint of JSON text: equal for equal values, however the text is written."""
    return texts.map(lambda t: fingerprint(json.loads(t)), na_action="ignore")


_NEGATION = re.compile(r"\b(?:no|not|without|never|kein\w*|ohne|sans|sin|sem)\b", re.I)


def term_extractor(terms: dict[str, str], lookback: int = 40):
    """A UDF: for each text the named terms it states, and those it only denies within
    ``lookback`` characters before the term."""
    compiled = {k: re.compile(v, re.I) for k, v in terms.items()}

    def look(text: str) -> tuple[list[str], list[str]]:
        stated, denied = [], []
        for name, pattern in compiled.items():
            hits = [bool(_NEGATION.search(text[max(0, m.start() - lookback) : m.start()])) for m in pattern.finditer(text)]
            if hits:
                (denied if all(hits) else stated).append(name)
        return stated, denied

    @F.pandas_udf(T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in ("stated", "denied")]))
    def extract(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([look(t) if isinstance(t, str) else ([], []) for t in texts], columns=["stated", "denied"])

    return extract


# The elements of Creative Commons licences and the versions there have been.
CC_ELEMENTS = ("by", "nc", "nd", "sa")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def licence(c: Column) -> Column:
    """Family, version and permissions of a licence text or URL, read as a set of words.

    A Creative Commons licence names the suite (or stands alone) and its elements; ``zero`` and
    ``mark`` are the two tools for the public domain. What has words that are no part of a
    licence's name is not recognised."""
    words = F.filter(F.split(F.lower(F.regexp_replace(c, r"[^A-Za-z0-9.]+", " ")), " "), lambda w: w != "")
    return let(F.struct(c.alias("text"), words.alias("words")), _licence_of)


# What may stand beside the elements: the scheme, the site and its folders, the suite, the document.
_SITE = ("creativecommons.org", "www.creativecommons.org")
_BESIDE = ("http", "https", *_SITE, "licenses", "publicdomain", "legalcode", "deed", "deed.en", "cc", "creative", "commons", "attribution", "license", "licence", "international")


def _licence_of(x: Column) -> Column:
    c, words = x["text"], x["words"]
    has = lambda *ws: F.arrays_overlap(words, F.array(*map(F.lit, ws)))
    known = F.forall(words, lambda w: w.isin(*_BESIDE, *CC_ELEMENTS, *CC_VERSIONS, "zero", "cc0", "mark", "pdm"))
    reserved = F.contains(F.lower(c), F.lit("all rights reserved")) | (F.lower(F.trim(c)) == "copyright")
    mark = (has("public") & has("domain")) | F.coalesce(has("pdm"), F.lit(False)) | (has("publicdomain") & has("mark"))
    zero = known & (has("cc0") | (has("zero") & has("cc", "publicdomain")) | ((F.size(words) == 1) & has("zero")))
    named = known & has("by") & ~(has("nd") & has("sa")) & (has("cc", "creative", *_SITE) | F.get(words, F.lit(0)).isin("by"))
    cc = F.concat_ws("-", F.lit("cc"), *[F.when(has(e), F.lit(e)) for e in CC_ELEMENTS])
    family = F.when(reserved, "copyright").when(mark, "pdm").when(zero, "cc0").when(named, cc)
    version = F.when(mark & ~reserved, "1.0").when(~reserved, F.when(family.isNotNull(), F.get(F.filter(words, lambda w: w.isin(*CC_VERSIONS)), F.lit(0))))
    return let(F.struct(family.alias("family"), version.alias("version"), F.coalesce(reserved | has("nd"), F.lit(False)).alias("fixed"), has("sa").alias("alike"), F.coalesce(reserved | has("nc"), F.lit(False)).alias("closed")), _terms_of)


def _terms_of(x: Column) -> Column:
    unknown, free = x["family"].isNull(), x["family"].isin("cc0", "pdm")
    # The names of permissions and of what a policy makes of them.
    return F.struct(
        x["family"].alias("family"),
        x["version"].alias("version"),
        F.when(unknown, "UNKNOWN").when(x["closed"], "NO").otherwise("YES").alias("commercial"),
        F.when(unknown, "UNKNOWN").when(x["fixed"], "NO").when(x["alike"], "SHARE_ALIKE").otherwise("YES").alias("derivatives"),
        F.when(unknown, "UNKNOWN").when(free, "NOT_REQUIRED").otherwise("REQUIRED").alias("attribution"),
        F.when(unknown, "QUARANTINED").when(x["fixed"], "DENIED").when(x["closed"], "RESEARCH_ONLY").otherwise("ALLOWED").alias("policy"),
    )

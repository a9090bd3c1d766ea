"""Per-document text quality statistics, and rules that tell prose from other text.

One pass over whole texts in Arrow batches, without a shuffle: lengths, words, symbols,
line ends, common words, list and table line shares, and repetition statistics (shares of
repeated lines, paragraphs and sentences, and the share of characters that the dominant
word n-grams cover). ``is_prose`` combines them: text counts as prose by the characters
of its sentences that are built with the function words of a language (or, where no
blanks divide words, with hiragana), less what repetition and noise take away.

Defined results
- NULL and blank texts have 0 counts, NULL means and shares, and are no prose.
- Repeated rows get equal rows; rows with a NULL id keep it. Empty table: empty result.
- All columns but id and text are ignored, so names cannot clash.
- ``lang`` is not read: it may be missing or wrong.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlark.session import spread

# Articles, pronouns, prepositions, conjunctions and auxiliaries of the languages expected.
COMMON = {
    "en": "the an of and to in is are was were be been it its that this these those for on with by at from into as or but not no so if than then when while where which who whose what we he she they their there has have had did all any such only also".split(),
    "de": "der die das den dem des ein eine einen einem einer und oder aber in im an am auf aus bei beim mit nach von vom vor zu zum zur für ist sind war wurde wird hat nicht nur auch als wie wenn weil dass es er sie wir sich".split(),
    "fr": "le la les un une de des du au aux et ou mais dans en par pour sur sous avec sans entre est sont était été ce cette ces il elle nous vous ils on se sa son ses leur que qui dont où ne pas car comme".split(),
    "es": "el la los las un una unos unas de del al en por para con sin sobre entre hasta desde es son era fue ha han se su sus lo le que como cuando donde porque pero no si ya muy más este esta".split(),
    "pt": "os as um uma de do da dos das em no na nos nas ao aos por pelo pela para com sem sobre entre até desde é são era foi ser se seu sua que como quando onde porque mas não já muito mais este esta".split(),
}
FUNCTION_WORDS = frozenset(w for ws in COMMON.values() for w in ws if len(w) > 1)
# As they stand in running text; words in capitals are codes, such as licences, more often than words.
_WRITTEN = FUNCTION_WORDS | {w.capitalize() for w in FUNCTION_WORDS}
# The blanks of ASCII, as str.split() knows them.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
NOISE = "@#%^&*~|§\\{}<>=_$`[]"

_WORD = re.compile(r"[^\W\d_]+")
# ASCII with a blank for everything but letters.
_ONLY_LETTERS = "".join(chr(i) if chr(i).isalpha() else " " for i in range(128))
_END = re.compile(r"(?<=[.!?;:。！？])\s+|(?<=[。！？])|\n\s*\n")
_ITEM = re.compile(r"\s*(?:[-*+•–—·▪◦‣]\s|\(?\d{1,3}[.)]\s|\[\d+\]\s|\[[ xX]\]\s|[a-z]\)\s|https?://\S+\s*$)")
_ROW = re.compile(r"\t|\||^\s*[{<]|;\S+;|\S\s{2,}\S+.*\s{2,}\S|\.{5,}")
_HIRAGANA = re.compile(r"[ぁ-ゟ]")
_CJK = re.compile(r"[ぁ-ヿ㐀-鿿]")
# UTF-8 read byte by byte: a first byte of two, three or four, and as many bytes that go on. Those
# from 80 to 9F are controls in one single-byte code and the marks of the last class in another.
_GOES_ON = "[\\u0080-\\u00bf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]"
_MOJIBAKE = re.compile(f"[\\u0080-\\u009f\\ufffd]|[Â-ß]{_GOES_ON}|[à-ï]{_GOES_ON}{{2}}|[ð-ô]{_GOES_ON}{{3}}")
_NOISE = re.compile("[" + re.escape(NOISE) + "!]+")
_DIGITS = re.compile(r"\d+")
_PARAGRAPH = re.compile(r"\n\s*\n")
_CLOSERS = ".!?;:。！？…\"'»”"
TOP_NGRAM, LONG_NGRAM = 4, 5
TOGETHER = 100_000

FIELDS = (
    ("n_chars", "bigint"),
    ("n_words", "bigint"),
    ("n_lines", "bigint"),
    ("n_sentences", "bigint"),
    ("mean_word_length", "double"),
    ("symbol_share", "double"),
    ("digit_share", "double"),
    ("noise_share", "double"),
    ("broken_word_share", "double"),
    ("mojibake_share", "double"),
    ("lines_ending_in_punctuation", "double"),
    ("common_word_share", "double"),
    ("list_line_share", "double"),
    ("table_line_share", "double"),
    ("duplicate_line_share", "double"),
    ("duplicate_paragraph_share", "double"),
    ("duplicate_sentence_share", "double"),
    ("top_ngram_share", "double"),
    ("duplicate_ngram_share", "double"),
    ("prose_share", "double"),
    ("is_prose", "boolean"),
)


def _repeated(parts: list[str]) -> float:
    """Share of the characters that lie in second and later copies of a part."""
    if len(set(parts)) == len(parts):
        return 0.0
    total = sum(map(len, parts))
    return sum(len(p) * (n - 1) for p, n in Counter(parts).items()) / total


def _apart(places: Iterable[int], n: int) -> int:
    """How many of the rising places hold an n-gram without overlapping the one before."""
    count, free = 0, 0
    for i in places:
        if i >= free:
            count, free = count + 1, i + n
    return count


def _top(at: np.ndarray, gram: np.ndarray, doc: np.ndarray, n: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """For each document the first place of its most frequent n-gram (ties: the first in the text;
    -1 for none) and how often it occurs without overlaps. ``at`` rises."""
    first, times = np.full(n_docs, -1), np.zeros(n_docs, np.int64)
    if not len(at):
        return first, times
    counts = np.bincount(gram)[gram]
    order = np.lexsort((at, -counts, doc[at]))
    heads = order[np.flatnonzero(np.diff(doc[at][order], prepend=-1))]
    first[doc[at[heads]]] = at[heads]
    best = np.full(n_docs, -1)
    best[doc[at[heads]]] = gram[heads]
    places = at[gram == best[doc[at]]]
    times = np.bincount(doc[places], minlength=n_docs)
    tight = (np.diff(places) < n) & (doc[places[1:]] == doc[places[:-1]])
    for d in np.unique(doc[places[1:]][tight]):
        times[d] = _apart(places[doc[places] == d].tolist(), n)
    return first, times


def _repetition(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """For the words of each text: the largest share of letters that the most frequent n-gram
    covers, for n from 1 to ``TOP_NGRAM``, and the share that lies in n-grams of ``LONG_NGRAM``
    words which occur more than once. Overlapping occurrences cover a letter once.

    All texts are counted together by numbers of words. An n-gram can be repeated only where
    its first and its last n - 1 words are, so each n looks only at what is left of the one before."""
    n_docs = len(texts)
    words = [w for t in texts for w in t]
    doc = np.repeat(np.arange(n_docs), [len(t) for t in texts])
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.concatenate([[0], np.cumsum(size)])
    letters = np.maximum(1, np.bincount(doc, weights=size, minlength=n_docs))
    code, names = pd.factorize(np.array(words, object))
    kinds = len(names) + 1
    best, covered = np.zeros(n_docs), np.zeros(len(words) + 1, np.int64)
    at, gram = np.arange(len(words)), pd.factorize(doc * kinds + code)[0]
    for n in range(1, LONG_NGRAM + 1):
        if n > 1:
            near = np.flatnonzero((np.diff(at) == 1) & (doc[at[1:]] == doc[at[:-1]]))
            at, gram = at[near], pd.factorize(gram[near] * kinds + code[at[near] + n - 1])[0]
        again = np.bincount(gram, minlength=1)[gram] > 1
        at, gram = at[again], pd.factorize(gram[again])[0]
        if n <= TOP_NGRAM:
            first, times = _top(at, gram, doc, n, n_docs)
            best = np.maximum(best, np.where(first >= 0, times * (ends[np.minimum(first + n, len(words))] - ends[np.maximum(first, 0)]), 0))
    np.add.at(covered, at, 1)
    np.add.at(covered, at + LONG_NGRAM, -1)
    inside = np.cumsum(covered[:-1]) > 0
    return best / letters, np.bincount(doc, weights=size * inside, minlength=n_docs) / letters


def _torn(text: str) -> int:
    """Characters of noise that stand between two letters, as markup around words does not."""
    end = len(text)
    return sum(m.end() - m.start() for m in _NOISE.finditer(text) if m.start() and m.end() < end and text[m.start() - 1].isalpha() and text[m.end()].isalpha())


def _is_row(line: str) -> bool:
    """Whether a line has the marks of a table row; most lines have none of their signs."""
    if "\t" in line or "|" in line or ";" in line or "  " in line or "....." in line or line.lstrip()[:1] in ("{", "<"):
        return bool(_ROW.search(line))
    return False


def _units(lines: list[str]) -> tuple[list[tuple[str, bool]], int, int]:
    """Sentences, each with whether it is a list entry or a table row, and how many lines are
    entries and rows. Entries and rows stand for themselves, other lines run on."""
    out: list[tuple[str, bool]] = []
    run: list[str] = []
    n_items = n_rows = 0

    def flush() -> None:
        if run:
            out.extend((x, False) for x in map(str.strip, _END.split("\n".join(run))) if x)
            run.clear()

    for line in lines:
        item, row = _ITEM.match(line), _is_row(line)
        n_items += bool(item)
        n_rows += bool(row)
        if item or row:
            flush()
            out.append((line.strip(), True))
        else:
            run.append(line)
    flush()
    return out, n_items, n_rows


def _is_sentence(s: str, words: list[str], common: list[str], apart: bool) -> bool:
    """Whether words are held together by function words; entries and rows need more of them."""
    if not words or "{" in s or "}" in s or "</" in s or "();" in s:
        return False
    if not s.isascii() and (cjk := len(_CJK.findall(s))):
        if cjk >= 8 or 2 * cjk > sum(map(len, words)):
            return len(_HIRAGANA.findall(s)) >= 0.2 * cjk
    if s.isupper():
        common = [w for w in map(str.lower, words) if w in FUNCTION_WORDS]
        if len(set(common)) < 2:
            return False
    if apart:
        return len(set(common)) >= 2 and len(common) >= 0.2 * len(words)
    return len(common) >= 1 and len(common) >= 0.12 * len(words)


def _measure(text: str) -> tuple[list[int], dict, list[str]]:
    """The counts, the shares and the words (in lower case) of one text that is not blank."""
    raw = text.splitlines()
    lines = [x for x in map(str.strip, raw) if x]
    units, n_items, n_rows = _units(raw)
    every: list[str] = []
    prose = whole = n_common = 0
    for unit, apart in units:
        words = unit.translate(_ONLY_LETTERS).split() if unit.isascii() else _WORD.findall(unit)
        every += words
        common = [w for w in words if w in _WRITTEN]
        n = len(unit) - unit.count(" ")
        whole += n
        n_common += len(common)
        if _is_sentence(unit, words, common, apart):
            prose += n
    joined = " ".join(every)
    n_words, letters = len(every), len(joined) - max(0, len(every) - 1)
    if text.isascii():
        dense = len(text) - sum(map(text.count, BLANKS))
        digits = sum(map(text.count, "0123456789"))
    else:
        dense = sum(map(len, text.split()))
        digits = sum(map(len, _DIGITS.findall(text)))
    noise = sum(map(text.count, NOISE))
    broken = 0 if text.isascii() else sum(map(len, _MOJIBAKE.findall(text)))
    stats = {
        "mean_word_length": letters / n_words if n_words else None,
        "symbol_share": (dense - letters - digits) / dense,
        "digit_share": digits / dense,
        "noise_share": noise / dense,
        "broken_word_share": _torn(text) / max(1, letters) if noise or "!" in text else 0.0,
        "mojibake_share": broken / dense,
        "lines_ending_in_punctuation": sum(x[-1] in _CLOSERS for x in lines) / len(lines),
        "common_word_share": n_common / n_words if n_words else None,
        "list_line_share": n_items / len(lines),
        "table_line_share": n_rows / len(lines),
        "duplicate_line_share": _repeated(lines),
        "duplicate_paragraph_share": _repeated([x for x in map(str.strip, _PARAGRAPH.split(text)) if x]),
        "duplicate_sentence_share": _repeated([u for u, _ in units]),
        "prose_share": prose / max(1, whole),
    }
    return [len(text), n_words, len(lines), len(units)], stats, joined.lower().split(" ") if n_words else []


def measured(texts: list[str | None]) -> Iterator[tuple]:
    """The values of ``FIELDS`` of each text, in order. Texts are taken together until they have
    ``TOGETHER`` words, so that memory is bounded by that and the longest text."""
    held: list[tuple] = []
    n_held = 0

    def flush() -> Iterator[tuple]:
        known = [h for h in held if len(h) > 1]
        top, again = _repetition([h[2] for h in known]) if known else ((), ())
        more = iter(zip(top, again))
        for h in held:
            if len(h) == 1:
                yield (h[0], 0, 0, 0, *[None] * (len(FIELDS) - 5), False)
                continue
            stats = h[1]
            prose = stats.pop("prose_share")
            stats["top_ngram_share"], stats["duplicate_ngram_share"] = map(float, next(more))
            stats["prose_share"] = prose
            yield (*h[0], *stats.values(), prose_by(stats))

    for text in texts:
        held.append(_measure(text) if text and not text.isspace() else (len(text or ""),))
        n_held += len(held[-1][2]) if len(held[-1]) > 1 else 0
        if n_held >= TOGETHER or len(held) >= TOGETHER:
            yield from flush()
            held, n_held = [], 0
    yield from flush()


def measure(text: str | None) -> tuple:
    """The values of ``FIELDS`` for one text."""
    return next(measured([text]))


def prose_by(s: dict) -> bool:
    """The combined rules over the statistics of one text. Entries and rows make a list or a table
    unless clearly more than half of the text is sentences; repeated lines, paragraphs or
    sentences, one dominant n-gram or passages that come again and again make junk, as do
    torn words and broken encodings."""
    structured = s["list_line_share"] + s["table_line_share"] > 0.5
    repeated = max(s["duplicate_line_share"], s["duplicate_paragraph_share"], s["duplicate_sentence_share"])
    sentences = s["prose_share"] > (0.6 if structured else 0.5)
    return sentences and repeated <= 0.5 and s["top_ngram_share"] <= 0.5 and s["duplicate_ngram_share"] <= 0.8 and s["broken_word_share"] <= 0.03 and s["mojibake_share"] <= 0.1


def text_statistics(documents: DataFrame, ident: str, text: str) -> DataFrame:
    """``doc_id`` and the columns of ``FIELDS``, one row per row of ``documents``."""
    kind = documents.schema[ident].dataType.simpleString()
    types = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(measured(batch.column("text").to_pylist()))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(FIELDS)
            arrays = [pa.array(c, types[t]) for c, (_, t) in zip(columns, FIELDS, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *[n for n, _ in FIELDS]])

    asked = documents.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    return spread(asked, "doc_id").mapInArrow(look, f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, t in FIELDS))

"""Scalar text functions as Column expressions; Python only where Spark has no built-in."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Typographic characters and what quote comparison takes them for.
QUOTE_FORMS = {
    "‘": "'", "’": "'", "‚": "'", "‛": "'", "′": "'", "“": '"', "”": '"', "„": '"', "″": '"',
    "–": "-", "—": "-", "−": "-", "‐": "-", "‑": "-", " ": " ", " ": " ", " ": " ",
}
#: Characters that quote comparison ignores.
INVISIBLE = "​‌‍﻿­"
#: Words of company names that the base's key ignores.
NAME_NOISE = "ltda|s\\.?a\\.?|me|epp|eireli|inc|llc|group|grupo|pesquisas?|pesquisa|marketing|research|consultoria|consulting|de|do|da|e"
#: The same for the network export.
NETWORK_NOISE = "ltda|s\\.?a\\.?|sa|me|epp|eireli|inc|llc|corp|corporation|group|grupo|holding|company|co|the|and|e|de|da|do|dos|das"
#: Stop words by language, in order of preference in a tie.
STOP_WORDS = {
    "en": ["the", "and", "of", "to", "is", "in", "that", "for", "are", "with", "how", "what"],
    "pt": ["o", "a", "de", "que", "para", "não", "uma", "com", "os", "como", "em", "é"],
    "es": ["el", "la", "de", "que", "los", "para", "una", "con", "las", "cómo", "en", "es"],
}
#: The same for the languages of the driver's tables.
TABLE_STOP_WORDS = {
    "en": ["the", "and", "of", "to", "is", "in", "that", "for"],
    "fr": ["le", "la", "les", "des", "et", "que", "du", "un"],
    "de": ["der", "die", "das", "und", "ist", "mit", "ein", "den"],
    "es": ["el", "los", "las", "de", "que", "por", "una", "con"],
}
#: Letters that canonical decomposition leaves alone.
POLISH = ("łŁ", "lL")
TURKISH = ("ıİşŞğĞçÇöÖüÜ", "iIsSgGcCoOuU")
#: Greek letters that look like Latin ones, and their look-alikes.
GREEK_LOOKALIKES = ("ABEZHIKMNOPTYXo", "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧο")
#: How a sentence ends, how an open line doesn't, how a line that goes on begins; a short line, and a long paragraph.
SENTENCE_ENDS = (".", "!", "?", '"', "”", "'", ")", "…")
OPEN_ENDS = (*SENTENCE_ENDS, ":")
GOES_ON = ",;:.)%"
SHORT_LINE = 25
LONG_PARAGRAPH = 1500
#: A word of five letters or more in the languages of the radar.
LONG_WORD = r"[\wáéíóúãõâêôçñü]{5,}"
#: Words too common in the subject to tell texts apart.
GENERIC_WORDS = [
    "market", "research", "insights", "using", "other", "pesquisa", "mercado", "investigación", "investigacion", "mercados", "empresa",
    "times", "teams", "analysis", "análisis", "análise", "survey", "surveys", "about", "which",
]


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(from, to): every BMP letter whose decomposition is one letter and marks, from the Unicode data."""
    source, target = [], []
    for point in range(0x80, 0x10000):
        if 0xD800 <= point < 0xE000:
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", chr(point)) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != chr(point):
            source.append(chr(point))
            target.append(base)
    return "".join(source), "".join(target)


def fold(text: Column) -> Column:
    """Text without accents, natively: one letter for each accented one, then no marks."""
    plain = F.regexp_replace(F.translate(text, *accent_table()), r"\p{Mn}+", "")
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(plain)


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility composition, which Spark lacks."""
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(T.StringType())
def fold_compatible(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining characters."""
    return text.map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)), na_action="ignore")


def collapse(text: Column) -> Column:
    """White space of any kind to single blanks, none at the ends; null stays null."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def plain_text(markup: Column) -> Column:
    """Tags out, the five common character references decoded, white space collapsed."""
    out = F.regexp_replace(markup, "<[^>]*>", " ")
    for name, char in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("amp", "&")):
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    return collapse(out)


def label_regions(running: Column, labels: Iterable[str]) -> Column:
    """array<struct<label,value>>: running text cut at labels, each value up to the next one.

    Labels are taken as they stand, upper or lower case alike, at the start of a word
    and before a colon or the end of one; of labels that begin alike the longest
    counts. They may come in any order, repeat or be missing. Text before the first
    one belongs to none.
    """
    words = "|".join(re.escape(x) for x in sorted(set(labels), key=lambda x: (-len(x), x)))
    mark = rf"(?iu)(?<![\p{{L}}\p{{N}}])({words})(?![\p{{L}}\p{{N}}])\s*:?"
    found, gaps = F.regexp_extract_all(running, F.lit(mark), F.lit(1)), F.split(running, mark)
    return F.transform(found, lambda x, i: F.struct(F.lower(x).alias("label"), collapse(F.get(gaps, i + 1)).alias("value")))


def quote_form(text: Column, compatible: bool = True) -> Column:
    """The form in which quotes and pages are compared: typography unified, white space collapsed."""
    out = nfkc(text) if compatible else text
    out = F.translate(out, "".join(QUOTE_FORMS) + INVISIBLE, "".join(QUOTE_FORMS.values()))
    return collapse(out)


def search_key(text: Column, compatible: bool = True) -> Column:
    """The form in which vocabulary is searched: quote form without accents, lower case."""
    return F.lower(fold(quote_form(text, compatible)))


def squeeze_key(name: Column, noise: str = NAME_NOISE, sharp_s: bool = False) -> Column:
    """A company name as a key: folded, noise words out, only a-z and 0-9 left. Null is empty."""
    out = F.lower(F.coalesce(name, F.lit("")))
    out = F.replace(out, F.lit("ß"), F.lit("ss")) if sharp_s else out
    return F.regexp_replace(F.regexp_replace(fold(out), rf"\b({noise})\b", " "), "[^a-z0-9]", "")


def token_key(name: Column, noise: str = NAME_NOISE) -> Column:
    """A company name as folded words with one blank between them."""
    return F.trim(F.regexp_replace(F.regexp_replace(fold(F.lower(F.coalesce(name, F.lit("")))), rf"\b({noise})\b", " "), "[^a-z0-9]+", " "))


def slug(text: Column, most: int = 70) -> Column:
    return F.left(F.regexp_replace(F.regexp_replace(fold(F.lower(text)), "[^a-z0-9]+", "-"), "^-|-$", ""), F.lit(most))


def domain_guesses(name: Column, suffixes: Iterable[str] = (".com.br", ".com"), least: int = 4, most: int = 30) -> Column:
    """Domains a company of that name may have: its first one, two, three and all words, each with each suffix."""
    words = F.filter(F.split(token_key(name), " "), lambda w: w != "")
    joined = F.array_append(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.array_join(F.slice(words, 1, n), "")), F.array_join(words, ""))
    fit = F.filter(F.array_distinct(joined), lambda s: F.length(s).between(least, most))
    return F.flatten(F.transform(fit, lambda s: F.array(*[F.concat(s, F.lit(x)) for x in suffixes])))


def shorten(text: Column, limit: int = 360) -> Column:
    """At most ``limit`` characters, cut at a blank, without a comma or colon at the end."""
    cut = F.regexp_replace(F.regexp_extract(F.left(text, F.lit(limit)), r"(?s)^(.*) [^ ]*$", 1), "[,;:]+$", "")
    whole = F.regexp_replace(F.left(text, F.lit(limit)), "[,;:]+$", "")
    return F.when(F.char_length(text) <= limit, text).otherwise(F.when(F.contains(F.left(text, F.lit(limit)), F.lit(" ")), cut).otherwise(whole))


def sentences(text: Column, least: int = 25) -> Column:
    """Sentences of every line: cut after . ! ? before a capital, digit, quote or bracket."""
    parts = F.flatten(F.transform(F.split(text, "\n"), lambda x: F.split(x, r"(?<=[.!?])\s+(?=[A-Z0-9\"'(])")))
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: F.char_length(s) >= least)


def paragraphs(text: Column, short: int = SHORT_LINE, most: int | None = LONG_PARAGRAPH) -> Column:
    """Paragraphs of a text whose lines break at every inline element.

    A line starts a paragraph unless it begins like the middle of one (a small
    letter or a mark of ``GOES_ON``), or is short after a line that has no end. What
    exceeds ``most`` characters takes no further line. Paragraphs that don't end
    like a sentence are left out, and those of four lines or more that are short in
    their majority. Null and empty texts have none. All of it stays in one row.
    """
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))), lambda x: x != "")
    marks = lambda chars: F.array(*[F.lit(c) for c in chars])
    ends = lambda x, chars: F.array_contains(marks(chars), F.right(x, F.lit(1)))

    def starts(ls: Column) -> Column:
        first = lambda x: F.left(x, F.lit(1))
        middle = lambda x: F.array_contains(marks(GOES_ON), first(x)) | first(x).rlike(r"^\p{Ll}")
        stub = lambda x, before: (F.char_length(x) < short) & ~ends(before, OPEN_ENDS)
        at = F.filter(F.transform(ls, lambda x, i: F.when((i == 0) | ~(middle(x) | stub(x, F.get(ls, i - 1))), i)), lambda i: i.isNotNull())
        return F.array_append(at, F.size(ls))

    def cut(stretch: Column) -> Column:
        """A stretch in parts, none of which was over ``most`` before its last line."""
        fresh = lambda done, x: F.struct(done.alias("done"), F.array(x).alias("open"), F.char_length(x).alias("n"))
        grown = lambda a, x: F.struct(a["done"].alias("done"), F.array_append(a["open"], x).alias("open"), (a["n"] + 1 + F.char_length(x)).alias("n"))
        step = lambda a, x: F.when(a["n"] > most, fresh(F.array_append(a["done"], a["open"]), x)).otherwise(grown(a, x))
        none = F.array().cast("array<array<string>>")
        return F.aggregate(F.slice(stretch, 2, F.size(stretch)), fresh(none, F.element_at(stretch, 1)), step, lambda a: F.array_append(a["done"], a["open"]))

    def stretches(ls: Column) -> Column:
        parts = F.transform(F.array(starts(ls)), lambda s: F.transform(F.slice(s, 1, F.size(s) - 1), lambda a, i: F.slice(ls, a + 1, F.get(s, i + 1) - a)))[0]
        if most is None:
            return parts
        size = lambda p: F.aggregate(p, F.lit(-1), lambda a, x: a + 1 + F.char_length(x))
        return F.flatten(F.transform(parts, lambda p: F.when(size(p) > most, cut(p)).otherwise(F.array(p))))

    prose = lambda p: (F.size(p) < 4) | (2 * F.size(F.filter(p, lambda x: F.char_length(x) < short)) <= F.size(p))
    joined = F.transform(F.array(lines), lambda ls: F.transform(F.filter(stretches(ls), prose), lambda p: collapse(F.array_join(p, " "))))[0]
    return F.filter(joined, lambda x: ends(x, SENTENCE_ENDS))


def guess_language(text: Column, stop: Mapping[str, list[str]] = STOP_WORDS, default: str = "en", least: int = 3, most: int = 6000) -> Column:
    """The language with most stop words, the first in the table in a tie, the default under ``least``."""
    words = F.regexp_extract_all(F.lower(F.left(F.coalesce(text, F.lit("")), F.lit(most))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    count = lambda w, known: F.size(F.filter(w, lambda x: x.isin(*known)))
    names = F.array(*[F.lit(x) for x in stop])

    def pick(w: Column) -> Column:
        scores = F.array(*[count(w, known) for known in stop.values()])
        best = F.array_max(scores)
        return F.when(best >= least, F.element_at(names, F.array_position(scores, best).cast("int"))).otherwise(F.lit(default))

    return F.transform(F.array(words), pick)[0]


def stems(text: Column, size: int = 6, generic: Iterable[str] = GENERIC_WORDS) -> Column:
    """Distinct first letters of the long words of a text that aren't generic."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{5,}"), F.lit(0))
    generic = list(generic)
    kept = F.filter(words, lambda w: ~w.isin(*generic)) if generic else words
    return F.array_distinct(F.transform(kept, lambda w: F.left(w, F.lit(size))))


def repaired(text: str) -> str:
    """Text whose UTF-8 was read as cp1252 or latin-1, put right run by run where that gives valid text."""

    def run(part: str) -> str:
        for codec in ("cp1252", "latin-1"):
            try:
                fixed = part.encode(codec).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
            return run(fixed) if fixed != part and len(fixed) < len(part) else fixed
        return part

    if text.isascii():
        return text
    whole = run(text)
    if whole != text:
        return whole
    out, part = [], ""
    for char in text + "\0":
        if "\x80" <= char <= "\xff" or char in "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ":
            part += char
        else:
            out.append(run(part) if part else "")
            out.append(char)
            part = ""
    return "".join(out)[:-1]


@F.pandas_udf(T.StringType())
def repair_mojibake(text: pd.Series) -> pd.Series:
    return text.map(repaired, na_action="ignore")


def decoded(raw: bytes, header: str | None = None, candidates: Iterable[str] = ("utf-8", "cp1252", "latin-1")) -> tuple[str, str]:
    """(text, codec) of a body: the header's charset, the document's own, then candidates; mojibake vetoes."""
    import re

    head = raw[:2048].decode("ascii", "ignore")
    named = [header, *re.findall(r"""charset=["']?([\w-]+)""", head, re.I)[:1]]
    if raw.startswith(b"\xef\xbb\xbf"):
        return raw[3:].decode("utf-8", "replace"), "utf-8"
    for codec in [*[n for n in named if n], *candidates]:
        try:
            text = raw.decode(codec)
        except (LookupError, UnicodeDecodeError):
            continue
        if codec.lower().replace("-", "") != "utf8" and repaired(text) != text:
            continue
        return text, codec.lower()
    return raw.decode("utf-8", "replace"), "utf-8?"


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("codec", T.StringType())]))
def decode_bytes(raw: pd.Series, header: pd.Series) -> pd.DataFrame:
    """struct<text,codec> of binary bodies with the charset that their headers declare, if any."""
    pairs = [decoded(bytes(r), h or None) if r is not None else (None, None) for r, h in zip(raw, header)]
    return pd.DataFrame(pairs, columns=["text", "codec"])


def mostly_script(text: Column, script: str = "IsLatin", share: float = 0.7) -> Column:
    """Whether at least ``share`` of the letters are of a script; null without letters."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.when(letters > 0, F.regexp_count(text, F.lit(rf"\p{{{script}}}")) >= letters * share)


def greek_upper(text: Column) -> Column:
    return fold(F.upper(text))


def greek_category(text: Column, allowed: Iterable[str]) -> Column:
    """struct<value,known>: the text in Greek letters, and whether it's one of a closed list."""
    value = F.translate(F.upper(F.trim(text)), *GREEK_LOOKALIKES)
    return F.struct(value.alias("value"), value.isin(*allowed).alias("known"))


def split_address(block: Column) -> Column:
    """struct<address,email,phone> of a multi-line block; labels go, the first e-mail and phone win."""
    lines = F.filter(F.transform(F.split(block, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    email, phone = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", r"\+?\d[\d ()./-]{6,}\d"
    bare = F.transform(lines, lambda x: F.regexp_replace(x, r"(?i)^(address|adres|phone|tel\.?|fax|e-?mail)\s*:?\s*", ""))
    is_phone = lambda x: x.rlike(rf"^\s*{phone}\s*$")
    address = F.filter(bare, lambda x: ~x.rlike(email) & ~is_phone(x) & (x != ""))
    first = lambda a: F.coalesce(F.try_element_at(a, F.lit(1)), F.lit(""))
    emails = F.filter(F.transform(bare, lambda x: F.regexp_extract(x, email, 0)), lambda x: x != "")
    phones = F.filter(bare, is_phone)
    return F.struct(F.array_join(address, ", ").alias("address"), first(emails).alias("email"), first(phones).alias("phone"))


def country_of_address(address: Column, aliases: Mapping[str, str], default: str = "") -> Column:
    """The last comma part of an address, by alias where there is one; names with a comma count as one part."""
    tail = F.lower(F.trim(F.regexp_replace(F.element_at(F.split(address, ","), -1), r"\.$", "")))
    two = F.lower(F.trim(F.array_join(F.slice(F.split(address, r"\s*,\s*"), -2, 2), ", ")))
    by = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.when(F.size(F.split(address, ",")) > 1, by[two]), by[tail], F.when(tail != "", F.initcap(tail)), F.lit(default))


def state_of_address(address: Column) -> Column:
    """The two capitals after the last dash, slash or comma; empty without them."""
    return F.regexp_extract(address, r"(?:[-/,]\s*)([A-Z]{2})\b(?!.*[-/,]\s*[A-Z]{2}\b)", 1)


def building_of_address(address: Column, kinds: str = "edif[íi]cio|ed\\.?|torre|building|tower") -> Column:
    """The comma part that names a building; empty without one."""
    return F.coalesce(F.try_element_at(F.filter(F.split(address, r"\s*[,-]\s*"), lambda x: x.rlike(rf"(?iu)^({kinds})\b")), F.lit(1)), F.lit(""))


def name_of_file(path: Column) -> Column:
    """A logo's or document's file name as words, without size, version and kind of file."""
    base = F.regexp_replace(F.regexp_extract(path, r"([^/?#]+)(?:[?#].*)?$", 1), r"\.[A-Za-z0-9]{2,5}$", "")
    for _ in range(3):  # endings can be stacked
        base = F.regexp_replace(base, r"(?i)[-_ ]*(\d+x\d+|logo|scaled|final|v?\d+|web|copy|rgb|cmyk)$", "")
    return F.initcap(F.trim(F.regexp_replace(F.regexp_replace(base, r"(?i)^logo[-_ ]*", ""), r"[-_+]+|%20", " ")))


def name_fits_domain(name: Column, domain: Column) -> Column:
    """Whether the key of a name and the first label of a domain contain one another."""
    key, label = squeeze_key(name), F.regexp_replace(F.substring_index(F.lower(domain), ".", 1), "[^a-z0-9]", "")
    return (key != "") & (label != "") & (F.contains(key, label) | F.contains(label, key))


def deobfuscate(text: Column) -> Column:
    """E-mail addresses written with (at), [dot] and the like, as they are meant."""
    at = F.regexp_replace(text, r"(?i)\s*[\[({]\s*(?:at|arroba)\s*[\])}]\s*", "@")
    return F.regexp_replace(at, r"(?i)\s*[\[({]\s*(?:dot|ponto|punkt)\s*[\])}]\s*", ".")


def xor_hex(code: Column) -> Column:
    """Text whose bytes are given in hex, each XORed with the first one."""
    byte = lambda i: F.conv(F.substring(code, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
    chars = F.transform(F.sequence(F.lit(1), (F.length(code) / 2).cast("int") - 1), lambda i: F.char(byte(i).bitwiseXOR(byte(F.lit(0)))))
    return F.when(F.length(code) >= 4, F.array_join(chars, "")).otherwise(F.lit(""))


def thousands(number: Column, mark: str = ".") -> Column:
    return F.replace(F.format_number(number, 0), F.lit(","), F.lit(mark))


def listed(items: Column, word: str = "e") -> Column:
    """``a, b e c``."""
    n = F.size(items)
    return F.when(n <= 1, F.array_join(items, "")).otherwise(F.concat(F.array_join(F.slice(items, 1, n - 1), ", "), F.lit(f" {word} "), F.element_at(items, -1)))


def title_part(title: Column, marks: str = r"\s+[|–—·-]\s+") -> Column:
    """What stands before the first separator of a page title."""
    return F.trim(F.element_at(F.split(title, marks), 1))


def without_markdown(text: Column, limit: int = 320) -> Column:
    """Placeholders to empty, emphasis and links to plain words, shortened."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"\[([^\]]*)\]\([^)]*\)", "$1"), r"[*_`#]+", "")
    empty = F.lower(F.trim(bare)).isin("", "-", "n/a", "none", "null", "not found", "not accessible")
    return F.when(empty, F.lit("")).otherwise(shorten(collapse(bare), limit))


def rich_text(value: Column, kind: str) -> Column:
    """A list, a map or a plain value as one string, parts joined as exports show them."""
    if kind == "list":
        return F.array_join(value, " | ")
    if kind == "map":
        return F.array_join(F.transform(F.map_entries(value), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), " | ")
    return F.coalesce(value.cast("string"), F.lit(""))



"""Quality rules: line-first cleaning with native functions only.

Every line is judged on its own and by its neighbours. Punctuation: crowded
exclamation marks, too many symbols, too few letters, a long line without any mark
of a sentence, a line cut off by an ellipsis. Navigation: crowded separators, a run
of short lines. Boilerplate: phrases that sites repeat, in the languages of the
corpus. Lines that fail are taken out, and a document that loses too much of its
text that way is rejected. Repetition and length rules over the whole text come
before. All of it is a projection of one row: no shuffle, no Python, whatever the
size of the table; lines that documents share are the business of line dedup.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WHITE, let

#: Characters that count as symbols in the base rules.
SYMBOLS = "#*$%&|<>"
#: Characters between the items of a menu or trail.
SEPARATORS = "|»›•·"
#: Marks that a sentence has, and those it ends with.
SENTENCE = ".!?:;…。！？؟"
ENDS = ".!?…。！？؟"
#: Phrases of lines that sites repeat, in English, French, German and Spanish. Lower case, as substrings.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "accept cookies", "use of cookies", "enable javascript", "subscribe to our",
    "sign up for our", "click here", "read more", "share this", "follow us", "back to top", "skip to content",
    "tous droits réservés", "conditions d'utilisation", "politique de confidentialité", "mentions légales", "accepter les cookies",
    "utilise des cookies", "activer javascript", "lire la suite", "cliquez ici", "suivez-nous", "inscrivez-vous à notre", "retour en haut", "aller au contenu",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "impressum", "cookies akzeptieren",
    "verwendet cookies", "javascript aktivieren", "weiterlesen", "klicken sie hier", "hier klicken", "folgen sie uns", "newsletter abonnieren", "zum inhalt springen",
    "todos los derechos reservados", "términos de uso", "condiciones de uso", "política de privacidad", "política de cookies",
    "aceptar cookies", "utiliza cookies", "habilitar javascript", "leer más", "haga clic aquí", "haz clic aquí", "síguenos en", "suscríbete a", "volver arriba", "ir al contenido",
)

#: A line of so many words has a mark of a sentence; a menu is so many short lines in a row, of so many words and characters.
UNMARKED_WORDS = 12
MENU_LINES = 5
MENU_WORDS = 3
MENU_CHARS = 40
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
MAX_SYMBOL_PERCENT = 10
MAX_LOST_PERCENT = 50


def words_of(text: Column) -> Column:
    """Maximal runs without white space; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), lambda w: w != "")


def solid(text: Column) -> Column:
    """Code points that aren't white space."""
    return F.char_length(F.regexp_replace(text, f"[{WHITE}]+", "")).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur at least twice, each word once, first occurrences included.

    Windows are compared by hash. Texts without a repeated window, most of them,
    stop at a hash set; the others sort their windows, so a text of n words never
    costs more than n log n.
    """

    def keys(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])
        )

    def covered(k: Column) -> Column:
        ordered = F.array_sort(F.transform(k, lambda x, i: F.struct(x.alias("k"), i.alias("i"))))
        hits = let(
            ordered,
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda x, j: (F.get(s, j + 1)["k"] == x["k"]) | ((j > 0) & (F.get(s, j - 1)["k"] == x["k"])),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(
            hits, start, lambda a, p: F.struct((a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"), p.alias("last"))
        )["n"].cast("long")

    def count(h: Column) -> Column:
        return F.when(F.size(h) <= window, F.lit(0).cast("long")).otherwise(
            let(keys(h), lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0).cast("long")).otherwise(covered(k)))
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), count)


def line_fails(line: Column, size: Column) -> Column:
    """Whether a line by itself is navigation, badly punctuated or boilerplate. Blank lines pass; they weigh nothing.

    ``size`` is :func:`solid` of the line. Two of a mark are the least that can fail a line, and most lines have a mark
    of a sentence, so few lines are cut into words.
    """
    crowded = lambda n: (n >= 2) & (n * 5 >= F.greatest(F.size(words_of(line)), F.lit(10)))
    out = crowded(F.regexp_count(line, F.lit(f"[{SEPARATORS}]"))) | crowded(F.regexp_count(line, F.lit("!!")))
    out = out | (F.regexp_count(line, F.lit(r"[#*$%&|<>{}\\^~=_]")) * 100 > size * MAX_SYMBOL_PERCENT)
    out = out | (F.char_length(F.regexp_replace(line, r"[^\p{L}]+", "")) * 100 < size * 40)
    out = out | line.rlike(rf"(?:\.\.\.|…)[{WHITE}]*$")
    out = out | ((size >= UNMARKED_WORDS) & ~line.rlike(f"[{SENTENCE}]") & (F.size(words_of(line)) >= UNMARKED_WORDS))
    listed = lambda low: reduce(or_, [F.contains(low, F.lit(phrase)) for phrase in BOILERPLATE])
    return out | let(F.lower(line), listed)


def line_is_short(line: Column, size: Column) -> Column:
    """Whether a line could be an entry of a menu: a few words that don't end like a sentence."""
    return size.between(1, MENU_CHARS) & ~line.rlike(rf"[{ENDS}][{WHITE}]*$") & (F.size(words_of(line)) <= MENU_WORDS)


def with_menus(lines: Column) -> Column:
    """``lines`` with those bad, too, that stand in a run of short ones."""

    def in_run(i: Column) -> Column:
        at = lambda k: F.coalesce(F.get(lines, i + k)["short"], F.lit(False))
        return F.exists(F.sequence(F.lit(1 - MENU_LINES), F.lit(0)), lambda k: F.forall(F.sequence(F.lit(0), F.lit(MENU_LINES - 1)), lambda j: at(k + j)))

    marked = F.transform(lines, lambda x, i: F.struct(x["line"].alias("line"), x["size"].alias("size"), (x["bad"] | (x["short"] & in_run(i))).alias("bad"), x["short"].alias("short")))
    return F.when(F.size(F.filter(lines, lambda x: x["short"])) >= MENU_LINES, marked).otherwise(lines)


def verdict(text: Column, max_lost_percent: int = MAX_LOST_PERCENT, cleaned: bool = True) -> Column:
    """One struct with the counts and verdict of a text; each part of it is computed once a row, in filters too.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    lost_chars (characters of failed lines), n_failed_lines and kept; with
    ``cleaned`` also clean_text, the text without failed lines.
    """

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n"), repeated_words(words).alias("repeated"))

    def of_lines(lines: Column) -> Column:
        full = F.transform(F.filter(lines, lambda x: x["size"] > 0), lambda x: x["line"])
        total = lambda size: F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + size(x))
        parts = [
            total(lambda x: x["size"]).alias("chars"), total(lambda x: F.when(x["bad"], x["size"]).otherwise(0)).alias("lost"),
            F.size(F.filter(lines, lambda x: (x["size"] > 0) & x["bad"])).cast("long").alias("failed"),
            let(full, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("dup"),
        ]
        if cleaned:
            stay = F.filter(lines, lambda x: (x["size"] == 0) | ~x["bad"])
            parts.append(F.array_join(F.transform(stay, lambda x: x["line"]), "\n").alias("text"))
        return F.struct(*parts)

    def judge(s: Column) -> Column:
        w, x = s["w"], s["x"]
        failed = (w["n"] < MIN_WORDS) | (w["repeated"] * 100 > w["n"] * MAX_REPEATED_PERCENT)
        named = [
            w["n"].alias("n_words"), x["chars"].alias("word_chars"), s["symbols"].alias("n_symbols"), x["dup"].alias("n_dup_lines"),
            w["repeated"].alias("n_repeat_words"), failed.alias("base_failed"), x["lost"].alias("lost_chars"), x["failed"].alias("n_failed_lines"),
            (~failed & (x["lost"] * 100 <= x["chars"] * max_lost_percent)).alias("kept"),
        ]
        return F.struct(*named, *([x["text"].alias("clean_text")] if cleaned else []))

    text = F.coalesce(text, F.lit(""))
    judged = lambda x: let(solid(x), lambda n: F.struct(x.alias("line"), n.alias("size"), line_fails(x, n).alias("bad"), line_is_short(x, n).alias("short")))
    lines = let(F.transform(F.split(text, "\n"), judged), with_menus)
    symbols = F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long")
    return let(F.struct(let(words_of(text), of_words).alias("w"), let(lines, of_lines).alias("x"), symbols.alias("symbols")), judge)


def with_quality(docs: DataFrame, text: str = "text", max_lost_percent: int = MAX_LOST_PERCENT, cleaned: bool = True) -> DataFrame:
    """(row, quality): the whole input row nested, so that no name can clash, and its :func:`verdict`.

    Null text: counts of 0, base_failed.
    """
    return docs.select(F.struct("*").alias("row"), verdict(F.col(text), max_lost_percent, cleaned).alias("quality"))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns and text unchanged."""
    return docs.where(verdict(F.col(text), cleaned=False)["kept"])


def op10_quality_rules(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, the base counts, base_failed and kept, plus the method's figures.

    Null text: no words, so base_failed. Empty tables give an empty result;
    repeated rows are judged one by one; other columns are ignored.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines", "lost_chars"]
    return with_quality(docs.select("doc_id", "text"), cleaned=False).select(F.col("row.doc_id").alias("doc_id"), *[F.col(f"quality.{n}").alias(n) for n in names])

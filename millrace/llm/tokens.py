"""Token counts by offset-mapped attribution.

Every document is encoded once, whole. A byte-level vocabulary splits the UTF-8
bytes without gaps, so a running sum of token sizes is the span of every token.
Spans are interval-joined with the spans of fields or sections, both sorted, and a
token across a boundary goes where an explicit rule says.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.words import slices
from millrace.session import ship_package

#: How a vocabulary of this family cuts a text before merging. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space from this size on are cut out before the pattern sees them: its look-ahead backtracks over them.
#: Fixed value: the characters are those that the pattern takes for white space.
LONG_WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{64,}")
#: A token that crosses a boundary belongs to the section of its first byte, of its
#: last byte, or of most of its bytes (the first one in a tie).
RULES = ("first", "last", "most")


def vocabulary_path() -> str:
    """The installed byte-level vocabulary; a path of one's own serves as well."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def broadcast_vocabulary(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The vocabulary file's bytes, a few MB whatever the corpus; executors need no file."""
    ship_package(spark)
    with open(path or vocabulary_path(), "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if printable, else the next unused code point from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes as the vocabulary file's own library does, several times faster, and knows each token's bytes."""

    def __init__(self, raw: bytes):
        import tiktoken

        spec = json.loads(raw)
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.bpe = tiktoken.Encoding("millrace", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        #: The same merges for a text that is one piece, however long.
        self.whole = tiktoken.Encoding("millrace-whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.size = np.zeros(max([*ranks.values(), *self.special.values()]) + 1, np.int64)
        self.size[list(ranks.values())] = [len(b) for b in ranks]
        for token, i in self.special.items():
            self.size[i] = len(token.encode())

    def _pieces(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text without special tokens.

        A run of white space is one piece but for its last character, which goes
        with the word after it, if there is one.
        """
        at = 0
        for run in LONG_WHITE.finditer(text):
            end = run.end() - (run.end() < len(text))
            yield self.bpe.encode_to_numpy(text[at : run.start()])
            yield self.whole.encode_to_numpy(text[run.start() : end])
            at = end
        yield self.bpe.encode_to_numpy(text[at:])

    def ids(self, text: str) -> np.ndarray:
        parts: list[np.ndarray] = []
        for piece in self.cut.split(text) if self.cut else [text]:
            parts += [np.array([self.special[piece]], np.uint32)] if piece in self.special else self._pieces(piece)
        return np.concatenate(parts) if len(parts) > 1 else parts[0]


@lru_cache(maxsize=2)
def _encoder(raw: bytes) -> Encoder:
    return Encoder(raw)


def encoder_of(shared: Broadcast) -> Encoder:
    """One encoder a Python worker."""
    return _encoder(shared.value)


def attribute(sizes: np.ndarray, bounds: np.ndarray, rule: str = "first") -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that cross a boundary).

    ``sizes`` are the tokens' bytes; ``bounds`` the sorted first bytes of the
    sections, the first one 0. Both runs are sorted, so the join is two searches.
    """
    end = np.cumsum(sizes)
    start = end - sizes
    first = np.searchsorted(bounds, start, side="right") - 1
    last = np.searchsorted(bounds, np.maximum(end - 1, start), side="right") - 1
    owner = {"first": first, "last": last, "most": first.copy()}[rule]
    if rule == "most":
        ends = np.append(bounds[1:], end[-1] if len(end) else 0)
        for i in np.flatnonzero(last > first):
            sections = range(first[i], last[i] + 1)
            owner[i] = max(sections, key=lambda s: (min(end[i], ends[s]) - max(start[i], bounds[s]), -s))
    return np.bincount(owner, minlength=len(bounds)), int((last > first).sum())


def char_spans(sizes: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every token in code points; a token of part of a character spans the character."""
    first = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    place = np.cumsum(first, dtype=np.uint32) - 1  # the character of each byte
    end = np.cumsum(sizes)
    return place[end - sizes].astype(np.int64), place[end - 1].astype(np.int64) + 1


def section_bounds(text: bytes, mark: bytes = b"\n") -> np.ndarray:
    """First bytes of the lines of a text; a line break belongs to the line it ends."""
    at = np.flatnonzero(np.frombuffer(text, np.uint8) == mark[0]) + 1
    return np.concatenate([np.zeros(1, np.int64), at[at < len(text)]])


def token_counts(docs: DataFrame, fields: list[str], id_col: str = "doc_id", sep: str = "\n", rule: str = "first", vocabulary: str | None = None) -> DataFrame:
    """(id, n_tokens, field_tokens, n_sections, section_tokens, n_crossing) of every row.

    The document is the fields joined by ``sep``, a null field being empty, encoded
    once. field_tokens counts the tokens of each field, the separator being part of
    the field before it; section_tokens those of each line of the last field, and
    n_crossing the tokens across a boundary of fields or of these lines. Counts of
    fields add up to n_tokens. A document without bytes has no tokens, one section
    and zeros. Repeated rows are counted one by one.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"f{i}") for i, f in enumerate(fields)])
    n, joint = len(fields), sep.encode()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared)
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], []]
            for values in zip(*[batch.column(f"f{i}").to_pylist() for i in range(n)]):
                raw = [v.encode() for v in values]
                sizes = encoder.size[encoder.ids(sep.join(values))]
                starts = np.cumsum([0, *[len(r) + len(joint) for r in raw[:-1]]])
                per_field, _ = attribute(sizes, starts, rule)
                lines = section_bounds(raw[-1]) + starts[-1]
                bounds = np.unique(np.concatenate([starts, lines]))
                per_section, crossing = attribute(sizes, bounds, rule)
                for column, value in zip(out, (len(sizes), per_field, len(lines), per_section[len(bounds) - len(lines) :], crossing)):
                    column.append(value)
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, k) for c, k in zip(out, kinds)]], names=names)

    names = ["id", "n_tokens", "field_tokens", "n_sections", "section_tokens", "n_crossing"]
    kinds = T.StructType.fromDDL("n_tokens long, field_tokens array<long>, n_sections long, section_tokens array<long>, n_crossing long")
    return rows.mapInArrow(count, T.StructType([rows.schema["id"], *kinds.fields])).withColumnRenamed("id", id_col)


def token_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, tokens, starts, ends) of every row: the ids of the whole text and their spans in code points.

    Null and empty texts have empty arrays; repeated rows are encoded one by one.
    """
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared)
        for batch in slices(batches):
            out: list[list] = [[], [], []]
            for value in batch.column("t").to_pylist():
                ids = encoder.ids(value)
                for column, x in zip(out, (ids.astype(np.int64), *char_spans(encoder.size[ids], value.encode()))):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, pa.list_(pa.int64())) for c in out]], names=["id", "tokens", "starts", "ends"])

    kinds = T.StructType.fromDDL("tokens array<long>, starts array<long>, ends array<long>")
    return rows.mapInArrow(encode, T.StructType([rows.schema["id"], *kinds.fields])).withColumnRenamed("id", id_col)


def op4_token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_source, n_text, n_sections, section_tokens, n_crossing) of every document.

    The document is its source, a line break and its text; sections are the text's
    lines; a crossing token belongs where its first byte lies.
    """
    counted = token_counts(docs.select("doc_id", "source", "text"), ["source", "text"], vocabulary=vocabulary)
    return counted.select(
        "doc_id", "n_tokens", F.get("field_tokens", F.lit(0)).alias("n_source"), F.get("field_tokens", F.lit(1)).alias("n_text"), "n_sections", "section_tokens", "n_crossing"
    )

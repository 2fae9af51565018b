"""Source adapters as data: how a listing gives keys, and how a landed page gives a typed record.

A source is read in two steps from landed pages: keys by one pattern over listing
pages, fields by patterns over the record's page. An adapter is that pair of
patterns; adding a source adds an entry, not code.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import contact, text
from millrace.operators.link import first_filled


@dataclass(frozen=True)
class Adapter:
    """``listing`` captures keys on listing pages; ``fields`` maps a field to patterns, tried in order, with one group each."""

    name: str
    country: str
    listing: str
    fields: Mapping[str, tuple[str, ...]]
    constants: Mapping[str, str] = field(default_factory=dict)

    def keys(self, listings: DataFrame, html: str = "html") -> DataFrame:
        """(key, ord): the keys of all listing pages, each once."""
        found = listings.select(F.posexplode(F.regexp_extract_all(html, F.lit(self.listing), F.lit(1))).alias("ord", "key"))
        return found.groupBy("key").agg(F.min("ord").alias("ord"))

    def _field(self, html: Column, patterns: tuple[str, ...]) -> Column:
        return first_filled(*[text.plain_text(F.regexp_extract(html, p, 1)) for p in patterns])

    def records(self, pages: DataFrame, html: str = "html") -> DataFrame:
        """One typed record a page; a field that no pattern finds is empty, pages without a name give none."""
        h = F.col(html)
        columns = [self._field(h, p).alias(n) for n, p in self.fields.items()]
        fixed = [F.lit(v).alias(n) for n, v in {"fonte": self.name, "pais": self.country, **self.constants}.items() if n not in self.fields]
        mail = [] if "email" in self.fields else [F.coalesce(F.try_element_at(contact.useful(contact.found_in(text.plain_text(h))), F.lit(1)), F.lit("")).alias("email")]
        return pages.select("url", *fixed, *columns, *mail).where("trim(nome) <> ''")


def labelled(label: str) -> str:
    """A pattern for the value behind a label in a table row, a definition list or a bold prefix."""
    return rf"(?is)(?:<(?:t[hd]|dt|b|strong|span)[^>]*>\s*{label}\s*:?\s*</(?:t[hd]|dt|b|strong|span)>)\s*(?:</(?:t[hd]|dt)>\s*)?(?:<(?:td|dd|span)[^>]*>)?(.*?)(?:</(?:td|dd|tr|p|li|div|span)>|<br)"


def by_labels(name: str, country: str, listing: str, labels: Mapping[str, tuple[str, ...]], title: str = r"(?is)<h1[^>]*>(.*?)</h1>") -> Adapter:
    """An adapter for pages whose fields stand behind labels, in whatever languages."""
    fields = {"nome": (title,)} | {n: tuple(labelled(x) for x in words) for n, words in labels.items()}
    return Adapter(name, country, listing, fields)

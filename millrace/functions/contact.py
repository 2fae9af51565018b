"""E-mail addresses and telephone numbers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import deobfuscate

#: Providers of free mailboxes, of throw-away ones, and names of shared mailboxes.
FREE = (
    "gmail.com", "hotmail.com", "outlook.com", "yahoo.com", "yahoo.com.br", "bol.com.br", "uol.com.br", "terra.com.br", "ig.com.br", "live.com",
    "msn.com", "icloud.com", "globo.com", "aol.com", "protonmail.com", "hotmail.com.br", "outlook.com.br", "me.com", "gmail.com.br",
)
DISPOSABLE = (
    "mailinator.com", "10minutemail.com", "guerrillamail.com", "tempmail.com", "yopmail.com", "trashmail.com", "sharklasers.com",
    "throwawaymail.com", "temp-mail.org", "getnada.com",
)
ROLES = (
    "contato", "contact", "info", "sac", "atendimento", "comercial", "vendas", "financeiro", "adm", "administrativo", "suporte", "support",
    "faleconosco", "hello", "rh", "juridico", "compras", "marketing", "no-reply", "noreply", "postmaster", "abuse", "webmaster",
)
#: The form of an address, of one inside text, of an accountant's, and of addresses that are none.
SYNTAX = r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~.-]{1,64}@[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?(\.[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?)+$"
IN_TEXT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
ACCOUNTANT = "contab|contad|escritorio|assessoria.?cont"
JUNK = r"(?i)(\.(png|jpe?g|gif|svg|webp|css|js)$|example\.|sentry|wixpress|@2x|^(user|email|name|seu|your)@)"


def clean(email: Column) -> Column:
    return F.lower(F.trim(F.coalesce(email, F.lit(""))))


def domain_of(email: Column) -> Column:
    return F.substring_index(clean(email), "@", -1)


def found_in(text: Column) -> Column:
    """Distinct addresses of a text in their order, those written with (at) and (dot) included."""
    return F.array_distinct(F.regexp_extract_all(deobfuscate(text), F.lit(IN_TEXT), F.lit(0)))


def useful(emails: Column, domain: Column | None = None, prefixes: Iterable[str] = ("contato", "contact", "comercial", "info"), most: int = 6) -> Column:
    """The best addresses: own domain first, then preferred names, then alphabetically; junk out."""
    kept = F.filter(F.transform(emails, lambda e: F.lower(e)), lambda e: ~e.rlike(JUNK))
    own = (lambda e: (F.substring_index(e, "@", -1) != domain).cast("int")) if domain is not None else (lambda e: F.lit(0))
    named = "|".join(prefixes)
    ranked = F.array_sort(F.transform(F.array_distinct(kept), lambda e: F.struct(own(e).alias("a"), (~e.rlike(f"^({named})@")).cast("int").alias("b"), e.alias("e"))))
    return F.slice(F.transform(ranked, lambda x: x["e"]), 1, most)


def other_region(email: Column, regions: Iterable[str] = ("usa", "uk", "india", "spain", "espana", "mexico", "brasil", "peru", "colombia")) -> Column:
    """Whether the local part names another region."""
    return F.substring_index(clean(email), "@", 1).rlike(r"(^|[._-])(" + "|".join(regions) + r")($|[._-])")


def kind(email: Column) -> Column:
    """accountant's (contador), free (gratuito) or corporate (corporativo); empty for no address."""
    e = clean(email)
    return F.when(~F.contains(e, F.lit("@")), "").when(e.rlike(ACCOUNTANT), "contador").when(domain_of(email).isin(*FREE), "gratuito").otherwise("corporativo")


def reach(email: Column) -> Column:
    """A shared mailbox (funcao) or a person's (nominal); empty for no address."""
    e = clean(email)
    local = F.substring_index(F.substring_index(e, "@", 1), "+", 1)
    return F.when(~F.contains(e, F.lit("@")), "").when(local.isin(*ROLES), "funcao").otherwise("nominal")


def tier(email: Column, mx_ok: Column | None = None) -> Column:
    """A to E. Only a domain known to take no mail demotes; an unknown one doesn't."""
    e = clean(email)
    dead = F.coalesce(mx_ok == F.lit(False), F.lit(False)) if mx_ok is not None else F.lit(False)
    return (
        F.when(~F.contains(e, F.lit("@")) | dead, "E").when(kind(email) == "contador", "D").when(kind(email) == "gratuito", "C")
        .when(reach(email) == "nominal", "A").otherwise("B")
    )


def verdict(email: Column, mx: Column, smtp: Column) -> Column:
    """struct<verdict,reason,note> by the first rule that decides. mx: ok, sem_mx or anything else; smtp: aceito, recusado or else."""
    e = clean(email)
    says = lambda v, r: F.struct(F.lit(v).alias("v"), F.lit(r).alias("r"))
    out = (
        F.when(~e.rlike(SYNTAX), says("invalido", "sintaxe"))
        .when(domain_of(email).isin(*DISPOSABLE), says("invalido", "descartavel"))
        .when(mx == "sem_mx", says("invalido", "sem_mx"))
        .when(F.coalesce(mx, F.lit("")) != "ok", says("indeterminado", "mx"))
        .when(smtp == "recusado", says("invalido", "smtp"))
        .when(smtp == "aceito", says("valido", "smtp"))
        .otherwise(says("provavel", ""))
    )
    note = F.when(reach(email) == "funcao", "caixa de funcao").otherwise("")
    return F.struct(out["v"].alias("verdict"), out["r"].alias("reason"), note.alias("note"))


def phone(area: Column, number: Column) -> Column:
    """``(11) 1234-5678``; empty without a number."""
    digits = F.regexp_replace(F.coalesce(number, F.lit("")), r"\D", "")
    split = F.concat(F.substring(digits, F.lit(1), F.length(digits) - 4), F.lit("-"), F.right(digits, F.lit(4)))
    return F.when(digits == "", "").when(F.coalesce(area, F.lit("")) == "", split).otherwise(F.concat(F.lit("("), area, F.lit(") "), split))


def digits(number: Column) -> Column:
    return F.regexp_replace(F.coalesce(number, F.lit("")), r"\D", "")

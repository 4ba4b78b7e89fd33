"""Normal forms of names, texts, handles and ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import any_of, first_match


def norm_name(c: Column) -> Column:
    """Lower-case letters and digits of a name without its parentheses; null if none are left."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_replace(c, r"\([^)]*\)", "")), "[^a-z0-9]+", ""), F.lit(""))


def slug(c: Column) -> Column:
    """Words joined by single hyphens."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(""))


def _plain(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"^[\s#>*_\-]+", ""), r"\s+", " "))


def short_text(c: Column, n: int = 180, last_sentence: bool = True) -> Column:
    """At most n characters: whole sentences if they fill half of it, else whole words and an ellipsis.

    With ``last_sentence`` the cut is after the last sentence end from half on; otherwise the first sentence is kept whenever it fits.
    """
    t = _plain(c)
    head = F.substring(t, 1, n)
    if last_sentence:
        sentence = F.regexp_extract(head, r"^(.*[.!?])(?=\s|$)", 1)
        fits = F.length(sentence) * 2 >= n
    else:
        sentence = F.regexp_extract(t, r"^(.*?[.!?])(?=\s|$)", 1)
        fits = (sentence != "") & (F.length(sentence) <= n)
    words = F.regexp_extract(head, r"^(.*)\s", 1)
    at_word = F.when(F.length(words) * 2 >= n, words).otherwise(F.substring(t, 1, n - 1))
    return F.when(F.length(t) <= n, t).when(fits, sentence).otherwise(F.concat(F.trim(at_word), F.lit("…")))


def handle(c: Column, host: str = r"(?:twitter|x)\.com") -> Column:
    """A social handle from a URL, an @name or a bare name."""
    url = F.regexp_extract(c, rf"(?i)^(?:https?://)?(?:www\.|mobile\.)?{host}/@?([A-Za-z0-9_]+)", 1)
    bare = F.regexp_extract(F.trim(c), r"^@?([A-Za-z0-9_]{1,30})$", 1)
    return F.coalesce(F.nullif(url, F.lit("")), F.nullif(bare, F.lit("")))


def handle_url(c: Column, base: str = "https://x.com/") -> Column:
    return F.concat(F.lit(base), handle(c))


def tail_id(c: Column) -> Column:
    """The number at the end of a text, as text."""
    return F.nullif(F.regexp_extract(c, r"(\d+)\D*$", 1), F.lit(""))


def address(c: Column) -> Column:
    """The first 20-byte hexadecimal address of a text, lower-cased."""
    return F.lower(F.nullif(F.regexp_extract(c, r"(0x[0-9a-fA-F]{40})(?![0-9a-fA-F])", 1), F.lit("")))


def is_url(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^(?i)(https?|ipfs|ar)://[^\s/?#]+[^\s]*$"), F.lit(False))


def has_template(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\{[A-Za-z_]*\}|%[ds]|:id\b|<id>"), F.lit(False))


def expand_template(c: Column, value: Column) -> Column:
    """The template with each placeholder replaced by the value."""
    return F.regexp_replace(c, F.lit(r"\{[A-Za-z_]*\}|%[ds]|:id\b|<id>"), value.cast("string"))


def stable_id(cols: Sequence[Column], n: int = 16, sep: str = "|") -> Column:
    """The first n digits of a hash over the values; null counts as empty."""
    whole = F.concat_ws(sep, *(F.coalesce(c.cast("string"), F.lit("")) for c in cols))
    return F.substring(F.sha2(whole, 256), 1, n)


def lead_reason(c: Column, hints: Sequence[str]) -> Column:
    """The first hint that a text holds, or null."""
    low = F.lower(c)
    return first_match([(low.contains(h.lower()), h) for h in hints])


def is_lead(c: Column, hints: Sequence[str]) -> Column:
    return any_of([F.coalesce(F.lower(c).contains(h.lower()), F.lit(False)) for h in hints])


def clean_fragment(c: Column) -> Column:
    """Text of an HTML fragment."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def best_link(c: Column, own_host: Column, avoid: Sequence[str] = ("twitter.com", "x.com", "discord.gg", "t.me")) -> Column:
    """The first absolute link of a fragment that leaves the host and is not social."""
    links = F.regexp_extract_all(c, F.lit(r'href="(https?://[^"]+)"'), F.lit(1))
    fine = F.filter(links, lambda u: ~F.contains(u, own_host) & ~any_of([F.contains(u, F.lit(a)) for a in avoid]))
    return F.get(fine, F.lit(0))


def abi_signals(c: Column) -> Column:
    """Which of the functions of interest an ABI (a JSON array of entries with names) declares."""
    names = F.transform(F.from_json(c, "array<struct<type:string,name:string>>"), lambda e: F.lower(e["name"]))
    has = lambda *wanted: F.coalesce(F.exists(names, lambda n: n.isin(*wanted)), F.lit(False))
    return F.struct(has("tokenuri", "uri").alias("metadata"), has("totalsupply", "maxsupply", "max_supply").alias("supply"), has("mint", "publicmint", "safemint").alias("mint"))


def pointer(c: Column, patterns: Sequence[tuple[str, str]], word: str) -> Column:
    """(status, param, url) of the first pattern (param, regex with one group) that a text holds; 'mentions' if only the word is there."""
    urls = [(p, F.nullif(F.regexp_extract(c, r, 1), F.lit(""))) for p, r in patterns]
    param = first_match([(u.isNotNull(), p) for p, u in urls])
    status = F.when(param.isNotNull(), "pointer").when(F.lower(c).contains(word), "mentions").otherwise("none")
    return F.struct(status.alias("status"), param.alias("param"), F.coalesce(*(u for _, u in urls)).alias("url"))

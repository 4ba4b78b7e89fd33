"""Secret scanning: an Aho-Corasick pass finds keywords, anchored patterns run only at the hits, checksums confirm.

One automaton holds the words that secrets begin with. At each hit the patterns of that word are matched, anchored where
it starts; what they find with an embedded checksum is kept only if the checksum holds. Runs of hexadecimal digits have
no keyword that could announce them, so their pattern runs over the whole text. All positions count code points.

The scan is one pass over the rows, without a shuffle.

Defined cases: null is empty; an empty text has no spans and the hash of the empty string; repeated rows are scanned
each; a null doc_id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans of one start are listed: the three base kinds, then those that carry a checksum or a fixed frame.
KINDS = ("assign", "access", "hex", "checked_token", "signed_token", "private_key", "service_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")
_CHECKED = re.compile("(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_SIGNED = re.compile(r"(eyJ[A-Za-z0-9_-]{10,})\.(eyJ[A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{20,})")
_SIGNED_RUN = re.compile("[A-Za-z0-9_-]*")
_PRIVATE = re.compile("-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\\s]+-----END [A-Z ]{0,20}PRIVATE KEY-----")
_SERVICE = re.compile("sk_live_[A-Za-z0-9]{24,}|xox[abpr]-[A-Za-z0-9-]{20,}|AIza[A-Za-z0-9_-]{35}")
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Keywords, lower-cased, and the patterns that start with them.
_WORDS = {
    **dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign"),
    "akia": "access",
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"), "checked_token"),
    "eyj": "signed_token",
    "-----begin ": "private_key",
    **dict.fromkeys(("sk_live_", "xoxa-", "xoxb-", "xoxp-", "xoxr-", "aiza"), "service_key"),
}


def checksum_base62(body: str) -> str:
    """The six base-62 digits of a body's CRC-32 that end such tokens."""
    value, out = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        out = _DIGITS[digit] + out
    return out.rjust(6, "0")


def _json_object(part: str) -> bool:
    try:
        return base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)).lstrip()[:1] == b"{"
    except ValueError:
        return False


#: For each kind: its pattern, and what a match has to meet.
RULES: dict[str, tuple[re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (_ASSIGN, lambda m: len(m[2]) >= 12),
    "access": (_ACCESS, lambda m: len(m[0]) >= 18),
    "checked_token": (_CHECKED, lambda m: checksum_base62(m[1]) == m[2]),
    "signed_token": (_SIGNED, lambda m: _json_object(m[1]) and _json_object(m[2])),
    "private_key": (_PRIVATE, lambda m: True),
    "service_key": (_SERVICE, lambda m: True),
}


def scanner() -> Callable[[str], list[tuple[str, int, int]]]:
    """A function from a text to its spans (kind, start, end), by start and then by kind."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for word, kind in _WORDS.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    order = {k: i for i, k in enumerate(KINDS)}

    def scan(text: str) -> list[tuple[str, int, int]]:
        spans, over = [("hex", m.start(), m.end()) for m in _HEX.finditer(text)], {}
        low = text.lower() if text.isascii() else text.encode().lower().decode()
        hits = sorted((end - size + 1, kind) for end, (kind, size) in automaton.iter(low))
        for start, kind in hits:
            if start < over.get(kind, 0):
                continue
            pattern, holds = RULES[kind]
            m = pattern.match(text, start)
            if m:
                over[kind] = m.end()
                if holds(m):
                    spans.append((kind, start, m.end()))
            elif kind == "signed_token":  # its first part ends where that of any later start in the run ends
                over[kind] = _SIGNED_RUN.match(text, start).end()
        spans.sort(key=lambda s: (s[1], order[s[0]], s[2]))
        return spans

    return scan


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans, an array of (kind, start, end), of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """The documents with each stretch of overlapping or touching spans replaced by ``mark``; all columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        for batch in batches:
            at, out = batch.schema.names.index(text_col), []
            for value in batch.column(at):
                text = value.as_py()
                spans, done, parts = scan(text or ""), 0, []
                for _, a, b in spans:
                    if not parts or a > done:
                        parts.append(text[done:a])
                        parts.append(mark)
                    done = max(done, b)
                out.append("".join([*parts, text[done:]]) if spans else text)
            columns = list(batch.columns)
            columns[at] = pa.array(out, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def span_digests(found: DataFrame, base: tuple[str, ...] = KINDS[:3]) -> DataFrame:
    """Counts and digests of ``find_secrets``: n_assign, n_access, n_hex, base_sha256, spans."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [number(k).alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(joined(own).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()

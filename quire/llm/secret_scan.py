"""Secret scans: keyword prefilter, regular expressions anchored at the hits, checksums inside the tokens."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import OWN, with_columns

# The kinds of span, in the order in which they are listed at one start.
KINDS = ("assign", "access", "hex", "checked")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
# Prefixes of tokens that end in six base-62 digits of the CRC-32 of the thirty characters before them.
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: Hexadecimal characters become h, all others a dot: a run of 32 is then one word for the automaton's alphabet of two.
_TO_HEX = bytes(ord("h") if chr(i) in "0123456789abcdef" else ord(".") for i in range(256))
_LOWER = {i: i + 32 for i in range(65, 91)}


def keyword_automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for w in (*ASSIGN_WORDS, "akia", *CHECKED_PREFIXES):
        a.add_word(w, ("access" if w == "akia" else "assign" if w in ASSIGN_WORDS else "checked", len(w)))
    a.make_automaton()
    return a


def checksum_holds(body: str, check: str) -> bool:
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits == check


def _lower(text: str) -> str:
    """A-Z in lower case, each character in its place. Other letters may change too: what is found is matched again."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_LOWER)


def _hex_runs(text: str) -> list[tuple[int, int]]:
    marked, out, at = text.encode("latin-1", "replace").translate(_TO_HEX), [], 0
    while (at := marked.find(b"h" * HEX_LEAST, at)) >= 0:
        end = HEX.match(text, at).end()
        out.append((at, end))
        at = end
    return out


def find_spans(text: str | None, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of every secret, in order; code points, end exclusive."""
    if not text:
        return []
    hits: dict[str, list[int]] = {"assign": [], "access": [], "checked": []}
    for end, (kind, n) in automaton.iter(_lower(text)):
        hits[kind].append(end + 1 - n)
    out = [(a, 2, b) for a, b in _hex_runs(text)]
    for number, (kind, pattern) in enumerate((("assign", ASSIGN), ("access", ACCESS))):
        past = 0
        for at in sorted(hits[kind]):  # leftmost first, never inside what has matched
            if at >= past and (m := pattern.match(text, at)):
                past = m.end()
                if len(m[2]) >= ASSIGN_LEAST if number == 0 else m.end() - at >= ACCESS_LEAST:
                    out.append((at, number, past))
    for at in hits["checked"]:
        if (m := CHECKED.match(text, at)) and checksum_holds(m[1], m[2]):
            out.append((at, 3, m.end()))
    return sorted(out)


def secret_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row of docs with secrets, an array of (kind, start, end, value), ordered by start and then kind.

    One Aho-Corasick pass finds the keywords; each kind's regular expression is matched only where a keyword starts (hex
    has no keyword: it is found as a run of one symbol). Kind `checked` is a token whose embedded checksum holds. Whole
    texts are searched, in one pass and without a shuffle. Null and empty texts have no spans, repeated rows are rows like
    others, an empty table gives an empty result, and a column `secrets` of docs gives way.
    """
    kind = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"

    @F.pandas_udf(kind)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = keyword_automaton()
        for texts in batches:
            yield texts.map(lambda t: [(KINDS[k], a, b, t[a:b]) for a, k, b in find_spans(t, automaton)] if isinstance(t, str) else [])

    return with_columns(docs, {"secrets": find(F.col(f"`{text_col}`").cast("string"))})


def secret_digest(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans and list of all spans of every row of docs."""
    rows = secret_spans(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.col("secrets").alias(OWN + "s"))
    said = "concat(x.kind, ':', x.start, ':', x.end)"
    return rows.select(
        "doc_id",
        *(F.expr(f"cast(size(filter({OWN}s, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.expr(f"array_join(transform(filter({OWN}s, x -> x.kind <> 'checked'), x -> {said}), ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join(transform({OWN}s, x -> {said}), ',')").alias("spans"),
    )


__all__ = ["checksum_holds", "find_spans", "keyword_automaton", "secret_digest", "secret_spans"]

"""Secret scans: keyword prefilter, anchored expressions near hits, embedded checksums.

One Aho-Corasick pass over the lower-cased text finds where keywords start; each kind's expression is
then matched exactly there, never searched for. Runs of hexadecimal digits have no keyword: every
eighth character is looked at, and only where three of these in a row are digits can a run of 24 be,
so the expression is only tried there. Kinds with a checksum inside are kept only if it holds. A private key runs from its
BEGIN line through the END line, or through the base64 that follows where the END line is missing.

Defined results: a null text is an empty one and has no spans; overlapping kinds are all reported;
matches of one kind never overlap; repeated rows are scanned each; an empty table gives an empty
result; other columns are kept by ``with_secrets`` and ignored by ``find_secrets``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.llm.columns import text_slices

SPANS = "array<struct<kind:string,start:int,end:int>>"
BASE_KINDS = ("assign", "access", "hex")
MASK = "[secret]"

# Keywords and the expressions of the kinds that they start.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
HEX_SAMPLE = re.compile(r"[0-9a-f]{3,}")
CODE_TOKEN = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
WEB_TOKEN = re.compile(r"(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]{16,}+")
WEB_PART = re.compile(r"[A-Za-z0-9_-]+")
# What may stand between the pieces of a key: white space, as such or escaped, and signs of quoting.
KEY_GAP = r"""(?:[\s"'`,;+>#|*]|\\+[nrt]|<br\ ?/?>)"""
# From the BEGIN line through headers and body to the END line; without one, through whole pieces of
# base64 and a last short one that ends its line.
PRIVATE_KEY = re.compile(
    rf"""-----BEGIN\ (?:[A-Z]+\ )?PRIVATE\ KEY-----
    (?:{KEY_GAP}*+(?:Proc-Type|DEK-Info|Comment):(?:(?!\\+[nr]|-----)[^\n\r])*+)*+
    (?:(?:{KEY_GAP}|[A-Za-z0-9/=])*+-----END\ (?:[A-Z]+\ )?PRIVATE\ KEY-----
    |(?:{KEY_GAP}*+[A-Za-z0-9+/=]{{16,}}+)*+(?:{KEY_GAP}*+[A-Za-z0-9+/]++=*+(?=[\x20\t"'`,;]*+(?:[\r\n]|\\+[nr]|\Z))|))""",
    re.VERBOSE,
)
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_holds(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the 30 before them, in base 62."""
    value = 0
    for char in match[2]:
        value = value * 62 + BASE62.index(char)
    return value == zlib.crc32(match[1].encode())


def json_holds(match: re.Match) -> bool:
    """The header decodes to an object that names an algorithm."""
    try:
        head = json.loads(base64.urlsafe_b64decode(match[1] + "=" * (-len(match[1]) % 4)))
    except (binascii.Error, ValueError):
        return False
    return isinstance(head, dict) and "alg" in head


def always(match: re.Match) -> bool:
    return True


# Kind: keywords that start it, anchored expression, what a match must satisfy.
KINDS: dict[str, tuple[tuple[str, ...], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        ASSIGN,
        lambda m: m.end(2) - m.start(2) >= 6,
    ),
    "access": (("akia",), ACCESS, lambda m: m.end() - m.start() >= 20),
    "code_token": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"), CODE_TOKEN, crc_holds),
    "web_token": (("eyj",), WEB_TOKEN, json_holds),
    "private_key": (("-----begin",), PRIVATE_KEY, always),
}
ORDER = {kind: i for i, kind in enumerate((*BASE_KINDS, "code_token", "web_token", "private_key"))}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """All keywords; a hit names its kind and how far before the hit's end the keyword starts."""
    found = ahocorasick.Automaton()
    for kind, (words, _, _) in KINDS.items():
        for word in words:
            found.add_word(word, (kind, len(word) - 1))
    found.make_automaton()
    return found


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, by start and then kind."""
    if not text:
        return []
    # Lowering the bytes touches A-Z only, so places stay what they are.
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    spans, free = [], {}
    hits = sorted((end - back, kind) for end, (kind, back) in automaton().iter(low))
    for start, kind in hits:
        if start < free.get(kind, 0):
            continue
        _, pattern, holds = KINDS[kind]
        match = pattern.match(text, start)
        if match:
            free[kind] = match.end()
            if holds(match):
                spans.append((kind, start, match.end()))
        elif kind == "web_token":
            # What follows the first part is the same for every later start within it.
            part = WEB_PART.match(text, start)
            free[kind] = part.end() if part else start
    spans += [("hex", a, b) for a, b in hex_runs(text)]
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]]))


def hex_runs(text: str, step: int = 8) -> Iterator[tuple[int, int]]:
    """Runs of 24 digits or more: each holds three sampled places in a row."""
    for sample in HEX_SAMPLE.finditer(text[::step]):
        low, high = step * (sample.start() - 1) + 1, step * sample.end()
        for run in HEX.finditer(text, max(0, low), high):
            yield run.span()


def with_secrets(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the spans of its texts in the new column ``name``."""

    @F.arrow_udf(SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for part in (part for batch in batches for part in text_slices(batch)):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(text)] for text in part.to_pylist()]
            yield pa.array(found, kind)

    return docs.withColumn(name, spans(F.col("text")))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans of every document."""
    return with_secrets(docs.select("doc_id", "text"), "spans").select("doc_id", "spans")


def masked(text: str | None, mask: str = MASK) -> str | None:
    """``text`` with every span, overlapping ones as one, replaced by ``mask``."""
    if not text:
        return text
    out, at = [], 0
    for a, b in merged(scan(text)):
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def merged(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for _, a, b in spans:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in its texts; ``n_chars``, where there is one, is counted anew."""

    @F.arrow_udf("string")
    def mask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in (part for batch in batches for part in text_slices(batch)):
            yield pa.array([masked(t) for t in part.to_pylist()], pa.string())

    clean = docs.withColumn("text", mask(F.col("text")))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))

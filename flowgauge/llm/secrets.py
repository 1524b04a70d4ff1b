"""Secrets in texts: fixed patterns, and strings that a primed compressor cannot shorten.

The patterns find assignments to password-like names, access keys and long
hexadecimal strings. Beyond them, a string that follows a sensitive word is a
candidate, also right after the ``=`` of an unquoted assignment, after the
scheme of an Authorization header, the head of a private key and the user of a
URL. Its novelty is what it adds to the
compressed size of its surroundings: zstandard, primed with a dictionary of
common identifiers, compresses the text before it without and with the
candidate. Names, paths and repeated values add little; a key adds nearly its
own length.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, pairwise

import zstandard
from pyspark.sql import DataFrame

from flowgauge.llm.common import per_row, text_bytes

#: The order of kinds where spans start at one place.
KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_RUN = re.compile(r"[0-9a-f]{32}")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32

_NAMES = ("password", "passwd", "secret", "token", "api")

#: A run that holds candidates, an inner ``=`` with what follows it, and what stands before a candidate in a sensitive context.
_RUN = re.compile(r"[A-Za-z0-9+/_.=~$-]{12,}")
_INNER = re.compile(r"=+(?=[^=])")
_SENSITIVE = re.compile(
    r"(?:passphrase|pass|pwd|credentials?|private|secret|token|auth|bearer|signature|access|client|session|cookie|key|salt|hmac|jwt|oauth)"
    r"[A-Za-z0-9_]*[\"']?[\x20\t]*(?:[:=]|=>|\x20is\x20|[\x20\t])[\x20\t\"'`(\[]*(?:(?:basic|bearer|digest|token)\x20+)?$"
    r"|private\x20key-----\s+$|://[^\s:/@]+:$",
    re.ASCII | re.IGNORECASE,
)
_ASSIGNED = re.compile(r"[:=][\x20\t\"'`(\[]*$")
#: Characters of a candidate.
LEAST_CHARS = 12
#: Characters before a candidate in which the sensitive word must stand.
REACH = 48
#: Characters before a candidate that count as its surroundings.
SURROUNDINGS = 512
#: Share of its length that a candidate must add to the compressed surroundings.
NOVELTY = 0.65

#: Identifiers and code that configuration and programs are full of; a string made of them is not novel.
IDENTIFIERS = """
access_key access_token account accept action address admin allow api_key apiVersion application application/json
argument array assert async auth authentication authorization await backend base64 basic bearer binary boolean
bucket buffer build bytes cache callback certificate char charset class client client_id client_secret cluster
code column commit common component config configuration connect connection console const constructor container
content content-type context cookie count create credential credentials cursor data database datetime debug decode
default define delete deploy description dict digest directory docker document domain download element email enable
encode encoding endpoint environment error event example example.com except exception execute export extends false
field file filename filter final float folder format function gateway generate get global group handler hash header
headers host hostname html http https identifier image import include index init input insert install instance int
interface internal issuer iterator json key keyboard label lambda language length level library limit list listen
local localhost location log logger login logout main manager map master match message metadata method middleware
model module mongodb mysql name namespace network none null number object offset option options origin output
package page parameter parse parser passphrase password path payload permission placeholder plugin port postgres
prefix print private private_key process production profile program project property protected protocol provider
proxy public public_key query queue range raise read redis redirect reference refresh_token region register release
remote repository request require reset resource response result return role root route router schema scope script
search secret secret_key select self send sequence server service session session_id set setting signature socket
source sql stack staging state static status storage stream string struct subject submit success super suffix
switch system table target task template test thread throw time timeout timestamp token tokenizer true type undefined
union unique update upload url user user_id user_name username utf-8 utils uuid validate value variable vector version
virtual volume warning webhook window worker write xml yaml your_api_key your_password changeme xxxxxxxxxxxxxxxx
0123456789 1234567890 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789abcdef 00000000 ffffffff
"""
_TOOLS: list = []


def _compressor() -> zstandard.ZstdCompressor:
    """One compressor per Python worker, primed with the identifiers."""
    if not _TOOLS:
        primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        _TOOLS.append(zstandard.ZstdCompressor(level=9, dict_data=primed, write_checksum=False, write_content_size=False))
    return _TOOLS[0]


def _pair_bits() -> dict[str, float]:
    """Bits by which a pair of letters is likelier in identifiers than among 27 equal signs."""
    words = f" {' '.join(re.findall('[a-z]+', IDENTIFIERS.lower()))} "
    pairs, firsts = Counter(map("".join, pairwise(words))), Counter(words)
    signs = " abcdefghijklmnopqrstuvwxyz"
    return {a + b: math.log2((pairs[a + b] + 0.5) / (firsts[a] + 13.5) * 27) for a in signs for b in signs}


_PAIR_BITS = _pair_bits()
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z][a-z]{2})|[^A-Za-z]+")


def like_words(value: str) -> bool:
    """Whether the letter pairs of ``value`` are those of words rather than of equally likely letters."""
    said = f" {_CAMEL.sub(' ', value).strip().lower()} "
    return sum(_PAIR_BITS[a + b] for a, b in pairwise(said)) > 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns: leftmost matches that don't overlap, then those long enough."""
    low, found = text.lower(), []
    if any(name in low for name in _NAMES):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    if _HEX_RUN.search(text):
        found += [(*m.span(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= HEX_CHARS]
    return found


def novelty(before: str, candidate: str) -> float:
    """Bytes that ``candidate`` adds to the compressed text before it, per byte of its own."""
    compress = _compressor().compress
    context = before.encode("utf-8", "replace")
    return (len(compress(context + candidate.encode())) - len(compress(context))) / len(candidate)


def candidates(text: str, run_start: int, run_end: int) -> Iterator[tuple[int, int]]:
    """Parts of a run that follow a sensitive word, the longer ones of a start first.

    They begin at the run's start or after an inner ``=``. The first one goes to
    the run's end; all go up to the next one that follows a sensitive word, and
    up to the next ``=``. So a run is measured three times at most, however
    long it is and however many starts it has.
    """
    inner = [(m.start(), m.end()) for m in _INNER.finditer(text, run_start, run_end)]
    starts = [run_start] + [after for _, after in inner]
    ends = [at for at, _ in inner] + [run_end]
    led = [k for k, start in enumerate(starts) if _SENSITIVE.search(text, max(0, start - REACH), start)]
    for k, following in zip(led, [*led[1:], len(starts)]):
        for end in sorted({run_end if k == led[0] else ends[k], ends[following - 1], ends[k]}, reverse=True):
            if end - starts[k] >= LEAST_CHARS:
                yield starts[k], end


def readable(text: str, start: int, end: int) -> bool:
    """Whether a candidate is made of words, or of signs and digits other than an assigned number."""
    value = text[start:end]
    if not any(c.isalpha() for c in value):
        return not (value.isdigit() and _ASSIGNED.search(text, max(0, start - REACH), start))
    return not any(c.isdigit() for c in value) and like_words(value)


def novel_spans(text: str, taken: list[tuple[int, int, str]], least: float = NOVELTY) -> list[tuple[int, int, str]]:
    """Candidates after a sensitive word that lie outside ``taken`` and add ``least`` of their length."""
    found, taken = [], sorted(taken)
    starts, reach = [a for a, _, _ in taken], list(accumulate((b for _, b, _ in taken), max))
    for m in _RUN.finditer(text):
        done = m.start()
        for start, end in candidates(text, *m.span()):
            value = text[start:end]
            before = bisect_left(starts, end)  # of the spans that begin before the candidate's end, the farthest end
            if start < done or (before and reach[before - 1] > start) or readable(text, start, end):
                continue
            if novelty(text[max(0, start - SURROUNDINGS) : start], value) >= least:
                found.append((start, end, "novel"))
                done = end
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    """``kind:start:end`` by start, then by kind."""
    order = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in order)


def scan(text: str, least: float = NOVELTY) -> tuple[int, int, int, str, str]:
    """(n_assign, n_access, n_hex, digest of the base spans, all spans) of one text."""
    base = base_spans(text)
    counts = [sum(kind == k for _, _, kind in base) for k in KINDS[:3]]
    digest = hashlib.sha256(joined(base).encode()).hexdigest()
    return (*counts, digest, joined(base + novel_spans(text, base, least)))


def find_secrets(docs: DataFrame, least: float = NOVELTY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are ``kind:start:end`` in code points with the end exclusive,
    ordered by start and joined by commas; a span covers the whole match. NULL
    and empty texts have none. Each row is scanned by itself, so repeated rows
    give repeated rows. Other columns are not read.
    """

    def work(text):
        return scan(text.decode("utf-8"), least)

    schema = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return per_row(docs.select("doc_id", text_bytes().alias("text")), work, schema, ["doc_id"])

"""Secrets in texts: keyword automaton, anchored patterns near its hits, checksums last.

One Aho-Corasick pass over a text finds all keywords. A pattern is then tried only where one of its
keywords starts, so a text without keywords costs one linear pass. Runs of hexadecimal digits have
no keyword; one plain pattern looks for them. Tokens that carry a checksum are reported only if it
holds. Nulls are empty texts. Spans are in code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from callspark.llm.common import sliced

# --- fixed values: kinds, keywords and patterns --------------------------------------------------

BASE_KINDS = ("assign", "access", "hex")
CHECKED_KINDS = ("github", "npm")
KINDS = BASE_KINDS + CHECKED_KINDS

_KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"[0-9a-f]{24,}+")
_GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase

_ASSIGN_LEAST, _ACCESS_LEAST = 6, 20
_LOWER = {ord(c): ord(c.lower()) for c in string.ascii_uppercase}


def base62_crc(payload: str) -> str:
    """The six-digit checksum that such tokens end in: CRC-32 of the payload in base 62."""
    rest, digits = zlib.crc32(payload.encode("ascii")), ""
    while rest:
        rest, digit = divmod(rest, 62)
        digits = _BASE62[digit] + digits
    return digits.rjust(6, "0")


def automaton():
    """The keyword automaton; its values are pairs of kind and keyword length."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in _KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _pattern(kind: str, text: str, at: int) -> tuple[int, bool] | None:
    """End of the match of a kind at ``at`` and whether it counts, or None."""
    if kind == "assign":
        m = _ASSIGN.match(text, at)
        return m and (m.end(), len(m[2]) >= _ASSIGN_LEAST)
    if kind == "access":
        m = _ACCESS.match(text, at)
        return m and (m.end(), m.end() - at >= _ACCESS_LEAST)
    m = (_GITHUB if kind == "github" else _NPM).match(text, at)
    return m and (m.end(), base62_crc(m[1]) == m[2])


def scan(text: str | None, words) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind number, end), by start and kind.

    Matches of one kind don't overlap: the leftmost is taken, and a match that fails its test still
    uses up its characters.
    """
    if not text:
        return []
    lowered = text.lower()
    if len(lowered) != len(text):  # a letter that becomes two when lower-cased would move the hits
        lowered = text.translate(_LOWER)
    found: list[tuple[int, int, int]] = []
    hits: dict[str, list[int]] = {}
    for end, (kind, size) in words.iter(lowered):
        hits.setdefault(kind, []).append(end - size + 1)
    for kind, starts in hits.items():
        number, free = KINDS.index(kind), 0
        for start in sorted(starts):
            if start >= free and (match := _pattern(kind, text, start)):
                free = match[0]
                if match[1]:
                    found.append((start, number, free))
    found += [(m.start(), BASE_KINDS.index("hex"), m.end()) for m in _HEX.finditer(text)]
    found.sort()
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its id, the counts of the base kinds, their digest, and all spans.

    One row per input row, also for nulls, empty texts and repeated ids; other columns are left out.
    """
    source = documents.select(documents[doc_id].alias("doc_id"), documents[text].alias("text"))
    kind = dict(source.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in sliced(batches):
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for value in batch.column(1):
                all_spans = scan(value.as_py(), words)
                base = [s for s in all_spans if s[1] < len(BASE_KINDS)]
                for number, into in enumerate(counts):
                    into.append(sum(s[1] == number for s in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(all_spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return source.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")

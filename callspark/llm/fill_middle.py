"""Fill-in-the-middle transformation of texts, cut through a Fenwick tree over blocks.

A text is cut into fixed blocks of UTF-8 bytes. Two Fenwick trees over the blocks hold how many units
and how many code points begin in each. A cut after k units descends the tree of units by binary
lifting to the block where unit k begins; only that block is looked at to find the byte, and the
tree of code points with the same block tells how many code points lie before it. A unit is a code
point, or any pattern whose matches cover the text, such as words with the space behind them.

Everything that chance decides comes from a hash of the id, so a rerun makes the same rows: where the
two cuts fall, whether a text is left plain, and the order of its parts. A text that is empty or holds
a marker stays plain, so that :func:`restored` gives back every text exactly.

Null texts are empty. A null id is hashed as an empty string. Every input row gives one row, repeated
rows and ids included; other columns are left out, whatever their names. Work is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from callspark.llm.common import sliced

#: Bytes of a block.
BLOCK = 1024


@dataclass(frozen=True)
class Settings:
    """Markers, shares of the forms in per cent, the pattern of a unit (none: a code point) and the seed of the hash."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    transformed: int = 90
    suffix_first: int = 20
    unit: str | None = None
    seed: int = 1


@dataclass(frozen=True)
class Made:
    """One transformed text; ``prefix_chars`` and ``middle_chars`` are code points, none for a plain text."""

    n: int
    form: str
    output: str
    prefix_chars: int | None = None
    middle_chars: int | None = None


class Fenwick:
    """Sums over the first blocks of a list of counts, and the block in which a sum is reached."""

    def __init__(self, counts: np.ndarray):
        self.size = len(counts)
        before = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        ends = np.arange(1, self.size + 1)
        self.tree = [0, *(before[ends] - before[ends - (ends & -ends)]).tolist()]
        self.top = 1 << max(0, self.size.bit_length() - 1)

    def sum(self, blocks: int) -> int:
        """What the first ``blocks`` blocks hold."""
        total = 0
        while blocks:
            total += self.tree[blocks]
            blocks -= blocks & -blocks
        return total

    def descend(self, wanted: int) -> tuple[int, int]:
        """The most blocks, but not all, that hold at most ``wanted`` together, and what is left of it behind them."""
        at, step = 0, self.top
        while step:
            ahead = at + step
            if ahead < self.size and self.tree[ahead] <= wanted:
                at, wanted = ahead, wanted - self.tree[ahead]
            step >>= 1
        return at, wanted


class Cutter:
    """A text in blocks, ready to be cut after any number of units."""

    def __init__(self, text: str, unit: re.Pattern | None = None, block: int = BLOCK):
        self.data = text.encode("utf-8", "surrogatepass")
        self.block = block
        data = np.frombuffer(self.data, np.uint8)
        edges = np.arange(0, max(1, len(data)), block)
        self.code_points = points = (data & 0xC0) != 0x80  # bytes with which a code point begins
        self.points = Fenwick(self._counted(points, edges))
        if unit is None:
            self.begins, self.units = points, self.points
        else:
            at = np.fromiter((m.start() for m in unit.finditer(text)), np.int64)
            self.begins = np.zeros(len(data), bool)
            self.begins[np.flatnonzero(points)[at]] = True
            self.units = Fenwick(self._counted(self.begins, edges))
        self.n = self.units.sum(self.units.size)

    @staticmethod
    def _counted(begins: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.add.reduceat(begins, edges, dtype=np.int64) if len(begins) else np.zeros(1, np.int64)

    def cut(self, units: int) -> tuple[int, int]:
        """The byte behind the first ``units`` units, and the code points before it."""
        if not units:
            return 0, 0
        if units >= self.n:
            return len(self.data), self.points.sum(self.points.size)
        found, rest = self.units.descend(units)
        start = found * self.block
        local = int(np.flatnonzero(self.begins[start : start + self.block])[rest])
        return start + local, self.points.sum(found) + int(self.code_points[start : start + local].sum())


def draws(doc_id: object, seed: int = 1) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the id: two cuts, whether to transform, which form."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transform(doc_id: object, text: str | None, settings: Settings = Settings()) -> Made:
    """Cuts one text into prefix, middle and suffix, and joins them behind their markers."""
    text = text or ""
    h1, h2, h3, h4 = draws(doc_id, settings.seed)
    cutter = Cutter(text, re.compile(settings.unit, re.S) if settings.unit else None)
    n = cutter.n
    marked = any(m in text for m in (settings.prefix, settings.suffix, settings.middle))
    if not text or marked or h3 % 100 >= settings.transformed:
        return Made(n, "plain", text)
    (first, before), (second, until) = (cutter.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    parts = [cutter.data[:first], cutter.data[first:second], cutter.data[second:]]
    prefix, middle, suffix = (p.decode("utf-8", "surrogatepass") for p in parts)
    if h4 % 100 < settings.suffix_first:
        form, output = "spm", f"{settings.suffix}{suffix}{settings.prefix}{prefix}{settings.middle}{middle}"
    else:
        form, output = "psm", f"{settings.prefix}{prefix}{settings.suffix}{suffix}{settings.middle}{middle}"
    return Made(n, form, output, before, until - before)


def restored(form: str, output: str, settings: Settings = Settings()) -> str:
    """The text again, from its output and form alone; no part holds a marker."""
    if form == "plain":
        return output
    rest, middle = output.split(settings.middle, 1)
    if form == "spm":
        suffix, prefix = rest[len(settings.suffix) :].split(settings.prefix, 1)
    else:
        prefix, suffix = rest[len(settings.prefix) :].split(settings.suffix, 1)
    return prefix + middle + suffix


def transformed(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, n, form, prefix_chars, middle_chars, output and ``restored``, what the output gives back."""
    source = documents.select(documents["doc_id"].alias("doc_id"), documents["text"].alias("text"))
    kind = dict(source.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [transform(i, t, settings) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([m.n for m in made], pa.int64()),
                    pa.array([m.form for m in made], pa.string()),
                    pa.array([m.prefix_chars for m in made], pa.int64()),
                    pa.array([m.middle_chars for m in made], pa.int64()),
                    pa.array([m.output for m in made], pa.string()),
                    pa.array([restored(m.form, m.output, settings) for m in made], pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"],
            )

    return source.mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
    )

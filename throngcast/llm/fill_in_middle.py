"""Fill-in-middle: texts rearranged around a middle, cut by a sparse exception index.

A text is cut into lines (or code points), and two cuts drawn by a hash of its id part it into
prefix, middle and suffix. Texts are handled as UTF-8 bytes. The exception index of a text holds
only its multibyte characters: where each begins and how many bytes beyond one it and those before
it have. ``searchsorted`` turns a cut counted in bytes into one counted in code points or back;
between two exceptions, and in ASCII texts altogether, that is a subtraction.

Defined cases: a null text is the empty one. An empty text and one that holds a marker stay plain,
and so does a row without an id, which has no draw. Equal rows have equal results, and rows keep
their number. A text of one unit has an empty middle or two empty outer parts. An empty table gives
no rows. Other columns are ignored. A batch of outputs holds ``BATCH_BYTES`` and one text more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import doc_frame, table_of

# Markers of the three parts, and the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
NEWLINE = 10
BATCH_BYTES = 8 << 20

_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("output", pa.string()),
])
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class ExceptionIndex:
    """Code points and bytes of one UTF-8 text, told apart by its multibyte characters only."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        self.lead = np.flatnonzero(data >= 0xC0)
        first = data[self.lead]
        #: Bytes beyond one, of all exceptions up to each.
        self.excess = np.cumsum(1 + (first >= 0xE0) + (first >= 0xF0), dtype=np.int64)
        #: Number of code points before each exception.
        self.at_char = self.lead - np.concatenate([[0], self.excess[:-1]]) if len(self.lead) else self.lead

    def _beyond(self, passed: np.ndarray) -> np.ndarray:
        return np.where(passed > 0, self.excess[passed - 1], 0) if len(self.lead) else np.zeros_like(passed)

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each cut given in bytes; cuts lie between characters."""
        return cuts - self._beyond(np.searchsorted(self.lead, cuts))

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each cut given in code points."""
        return cuts + self._beyond(np.searchsorted(self.at_char, cuts))

    @property
    def length(self) -> int:
        """Code points of the text."""
        return self.size - int(self.excess[-1]) if len(self.lead) else self.size


def line_ends(data: np.ndarray) -> np.ndarray:
    """Byte after each line; a line ends with its line feed or with the text."""
    ends = np.flatnonzero(data == NEWLINE) + 1
    return ends if not len(data) or len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def draws(doc_id: int, seed: int) -> tuple[int, ...]:
    """Four unsigned 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def rearranged(doc_id: int | None, raw: bytes, unit: str, seed: int, percent: int, spm_percent: int) -> tuple:
    """Values of ``OUT`` for one text."""
    data = np.frombuffer(raw, np.uint8)
    index = ExceptionIndex(data)
    ends = line_ends(data) if unit == "line" else None
    n = index.length if ends is None else len(ends)
    if doc_id is None or not raw or PREFIX in raw or SUFFIX in raw or MIDDLE in raw:
        return doc_id, n, PLAIN, None, None, raw
    h1, h2, h3, h4 = draws(doc_id, seed)
    if h3 % 100 >= percent:
        return doc_id, n, PLAIN, None, None, raw
    units = np.sort(np.array([h1 % (n + 1), h2 % (n + 1)], np.int64))
    cuts = index.bytes(units) if ends is None else np.concatenate([[0], ends])[units]
    chars = index.chars(cuts)
    a, b = cuts.tolist()
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    spm = h4 % 100 < spm_percent
    outer = (SUFFIX, suffix, PREFIX, prefix) if spm else (PREFIX, prefix, SUFFIX, suffix)
    output = b"".join([*outer, MIDDLE, middle])
    return doc_id, n, SPM if spm else PSM, int(chars[0]), int(chars[1] - chars[0]), output


def transform(
    docs: DataFrame, *, unit: str = "line", seed: int = 7, percent: int = 100, spm_percent: int = 50
) -> DataFrame:
    """One row per document: ``OUT``.

    ``percent`` of the documents are rearranged, ``spm_percent`` of these with the suffix first.
    ``unit`` is ``line`` or ``char``. Rows are independent of each other: nothing is shuffled.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unit is line or char, not {unit!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["raw"]):
                rows.append(rearranged(doc_id, raw.as_py() or b"", unit, seed, percent, spm_percent))
                held += len(rows[-1][-1])
                if held > BATCH_BYTES:
                    yield from _batches(rows)
                    rows, held = [], 0
            yield from _batches(rows)

    return doc_frame(docs).mapInArrow(run, OUT)


def _batches(rows: list[tuple]) -> list[pa.RecordBatch]:
    return table_of(_OUT, **dict(zip(_OUT.names, zip(*rows)))).to_batches() if rows else []


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No marker can arise where a part meets a marker, so
    the output splits at exactly the three that were put in."""
    parts = F.split(output, "<[PSM]>", -1)
    prefix, suffix = F.when(form == PSM, parts[1]).otherwise(parts[2]), F.when(form == PSM, parts[2]).otherwise(parts[1])
    return F.when(form == PLAIN, output).otherwise(F.concat(prefix, parts[3], suffix))

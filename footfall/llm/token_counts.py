"""Token counts by offset-mapped attribution.

A document's fields are joined by ``separator`` and encoded once, as a whole, so every
token is the one that training would see. Sections are intervals of the same text: each
field is cut behind every match of ``section_end``. Token spans and section spans both
lie in order, so their interval join is a merge of two sorted lists, done where the
document is; nothing is shuffled.

A token that crosses a boundary is allocated by an explicit rule:

* ``first``    to the section of its first character (the default; whole counts);
* ``most``     to the section with most of its characters, the earlier one on a tie;
* ``shared``   to every section it touches, by characters.

By each rule a document's counts add up to its tokens. Tokens are byte sequences; a
character belongs to the token that holds its first byte, and a token without any first
byte counts where its character begins. A separator belongs to the field before it.

A null field is an empty one. A document always has at least one section, so null and
empty texts give one row with zero tokens. Repeated rows are counted one by one.
Other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from footfall.session import carry_to_workers

carry_to_workers(__name__)

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("first", "most", "shared")
PIECE = 1 << 20  # characters that are encoded at a time, cut where the pattern cuts


class Encoder:
    """Byte-level BPE with the byte length of every token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def token_ends(self, text: str) -> np.ndarray:
        """The byte behind each token of the whole text."""
        ids: list[int] = []
        for piece in _pieces(text):
            ids += self.encoding.encode_ordinary(piece)
        return np.cumsum(self.lengths[np.array(ids, np.int64)]) if ids else np.empty(0, np.int64)


def _pieces(text: str) -> Iterator[str]:
    """Cuts a very long text in front of a space between two letters, where no token of the
    pattern can reach across, so the tokens are those of the whole."""
    start = 0
    while len(text) - start > PIECE:
        cut = next((m.start() for m in _CUT.finditer(text, start + PIECE)), len(text))
        yield text[start:cut]
        start = cut
    yield text[start:]


_CUT = re.compile(r"(?<=[a-z]) (?=[a-z])")


def read_vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def sections(fields: list[str], separator: str, section_end: re.Pattern) -> tuple[str, list[tuple[int, int, int]]]:
    """The whole text and its sections ``(field, start, end)`` in characters; they touch."""
    text = separator.join(fields)
    spans, at = [], 0
    for i, value in enumerate(fields):
        stop = at + len(value) + (len(separator) if i + 1 < len(fields) else 0)
        start = at
        for m in section_end.finditer(value):
            if m.end() < len(value):
                spans.append((i, start, at + m.end()))
                start = at + m.end()
        spans.append((i, start, stop))
        at = stop
    return text, spans


def attribute(token_ends: np.ndarray, data: bytes, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of the tokens that touch it cross a boundary.
    ``ends`` are the characters behind the sections."""
    counts, crossing = np.zeros(len(ends)), np.zeros(len(ends), np.int64)
    if not len(token_ends):
        return counts, crossing
    lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80  # first bytes of characters
    before = np.concatenate(([0], np.cumsum(lead)))        # characters that begin before a byte
    starts = np.concatenate(([0], token_ends[:-1]))
    low, high = before[starts], before[token_ends]         # characters that begin inside
    low = np.where(low == high, low - 1, low)              # inside one character: where it begins
    first = np.searchsorted(ends, low, "right")
    last = np.searchsorted(ends, np.maximum(high - 1, low), "right")
    inside = first == last
    counts += np.bincount(first[inside], minlength=len(ends))
    section_starts = np.concatenate(([0], ends[:-1]))
    for t in np.flatnonzero(~inside):
        touched = np.arange(first[t], last[t] + 1)
        size = np.minimum(ends[touched], high[t]) - np.maximum(section_starts[touched], low[t])
        touched, size = touched[size > 0], size[size > 0]
        crossing[touched] += 1
        if rule == "first":
            counts[touched[0]] += 1
        elif rule == "most":
            counts[touched[np.argmax(size)]] += 1
        else:
            counts[touched] += size / size.sum()
    return counts, crossing


_COUNTS = ("field string, section long, start long, end long, tokens double, crossing long, doc_tokens long")
_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]


def count_tokens(docs: DataFrame, fields: tuple[str, ...] = ("text",), doc_id: str = "doc_id",
                 separator: str = "\n", section_end: str = r"\n+", rule: str = "first",
                 vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """One row per document and section: ``doc_id, field, section`` (from 0 in the document),
    ``start, end`` (characters of the joined text), ``tokens, crossing, doc_tokens``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names = list(fields)
    # The vocabulary is read where the session runs; its size is fixed by its file.
    carried = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, cut = Encoder(carried.value, pattern), re.compile(section_end)
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            columns = [batch.column(i + 1) for i in range(len(names))]
            for row, key in enumerate(batch.column(0).to_pylist()):
                text, spans = sections([c[row].as_py() or "" for c in columns], separator, cut)
                ends = np.array([stop for _, _, stop in spans], np.int64)
                token_ends = encoder.token_ends(text)
                counts, crossing = attribute(token_ends, text.encode("utf-8", "surrogatepass"), ends, rule)
                n = len(spans)
                for column, values in zip(out, (
                        [key] * n, [names[f] for f, _, _ in spans], range(n), [s for _, s, _ in spans],
                        [e for _, _, e in spans], counts, crossing, [len(token_ends)] * n)):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field(0).type), *(pa.array(c, k) for c, k in zip(out[1:], _KINDS))],
                ["doc_id", *(part.split()[0] for part in _COUNTS.split(", "))])

    return docs.select(docs[doc_id].alias("doc_id"), *(
        docs[f].cast("string").alias(f"field_{i}") for i, f in enumerate(names))).mapInArrow(
        run, f"doc_id {kind}, {_COUNTS}")

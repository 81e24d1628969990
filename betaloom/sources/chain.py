"""Chain files: alignments of one genome build to another, as the blocks that ``intervals.liftover`` reads.

A stanza is a header line and one line ``size dt dq`` per block (the last has the size only), closed by a blank line:

    chain score tName tSize tStrand tStart tEnd qName qSize qStrand qStart qEnd id

``t`` is the build mapped from, ``q`` the one mapped to; ``dt`` and ``dq`` are the gaps after a block in each. Places count from 0 and, on
a reverse strand, from the far end of the sequence. Blocks come back 1-based and closed, with the place of their lower end in ``q``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS = "chr string, start long, end long, to_chr string, to_start long, to_strand string"
MOST = 2**63 - 1

_blanks = re.compile("[ \\t\\n\\x0b\\f\\r]+")


def _number(text: str) -> int:
    if not (text.isdigit() and text.isascii()) or (number := int(text)) > MOST:
        raise ValueError(text)
    return number


def _numbers(line: str) -> list[int]:
    parts = line.split(" ")
    digits = "".join(parts)
    if len(line) < 19 and "" not in parts and digits.isdigit() and digits.isascii():
        return list(map(int, parts))
    return [_number(part) for part in _blanks.split(line)]


def _stanza_blocks(lines: list[str]) -> Iterator[tuple]:
    """Blocks of one stanza, a header and block lines; ``ValueError`` or ``IndexError`` if it isn't sound."""
    words = _blanks.split(lines[0])
    word, _, t_name, t_size, t_strand, t, t_end, q_name, q_size, q_strand, q, q_end = words[:12]
    if word != "chain" or t_strand != "+" or q_strand not in ("+", "-") or len(words) > 13 or len(lines) < 2:
        raise ValueError("header")
    _number(t_size)
    t, t_end, q_size, q, q_end = map(_number, (t, t_end, q_size, q, q_end))
    for at, line in enumerate(lines[1:], 2):
        parts = _numbers(line)
        if len(parts) != (1 if at == len(lines) else 3):
            raise ValueError("block")
        size = parts[0]
        if size:
            yield t_name, t + 1, t + size, q_name, q_size - q - size + 1 if q_strand == "-" else q + 1, q_strand
        t, q = t + size, q + size
        if at < len(lines):
            t, q = t + parts[1], q + parts[2]
    if (t, q) != (t_end, q_end):
        raise ValueError("ends")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("chr", "start", "end", "to_chr", "to_start", "to_strand")
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            found = []
            for stanza in batch.column(0).slice(at, 1000).to_pylist():
                lines = [line for line in (x.strip(" ") for x in stanza.replace("\r", "").split("\n")) if line and line[0] != "#"]
                if not lines:
                    continue
                try:
                    found.extend(_stanza_blocks(lines))
                except (ValueError, IndexError):
                    raise ValueError(f"malformed chain stanza: {lines[0]}") from None
            columns = zip(*found) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], list(names))


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    """Blocks ``(chr, start, end, to_chr, to_start, to_strand)`` of all stanzas of the files at ``path``.

    A stanza whose lines aren't numbers as above, whose mapped-from strand isn't ``+``, or whose blocks and gaps don't add up to the
    ends in its header fails the job with the header in the message. The reader cuts files at blank lines, so a file is split over tasks;
    a stanza is added up where it was read, and nothing is shuffled. Comments and blanks are passed over.
    """
    records = spark.read.text(path, lineSep="\n\n").select(F.explode(F.split("value", r"\n[ \t\r]*\n")).alias("stanza"))
    return records.mapInArrow(_blocks, BLOCKS)

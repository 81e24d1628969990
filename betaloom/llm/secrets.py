"""Secret scans over an incremental ledger of blobs.

A text is known by its SHA-256, its blob. The ledger holds, for each (blob, rule version) ever
scanned, the spans found in it; a run scans only blobs that the ledger lacks under the current rule
version, once each however many documents or versions of them hold it, adds the result as a new
folder of the ledger, and joins findings back to every row that holds the blob. A run that died
before its folder was complete is simply run again; a blob scanned twice counts once.

Null text counts as empty; empty texts have no findings. Repeated rows each get their findings. Null
ids are kept. Of the input only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm.tokens import tidy
from betaloom.llm.spans import packed, unpacked, without_spans
from betaloom.tables import checkpoint_root

# The three base kinds in order (pattern, group, least length of the group).
BASE = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
# A private key: from BEGIN to the next marker if that is the END of one; else BEGIN with the armor headers and the lines of
# base64 that follow. Line breaks may be written as \\n, and the body may stand on the line of BEGIN.
_LABEL = r"(?:[A-Z0-9]+\x20)*PRIVATE\x20KEY(?:\x20BLOCK)?-----"
_BREAK = r"[ \t]*+(?:\r\n?|\n|(?:\\r)?\\n)[ \t>]*+"
_HEADER = r"(?:Proc-Type|DEK-Info|Version|Comment|MessageID|Hash|Charset):[^\r\n\\]*"
_BODY = rf"(?:(?:{_BREAK})++{_HEADER})*+(?:(?:{_BREAK})*+[A-Za-z0-9+/=]++(?=[ \t]*(?:[\r\n\"',]|\\|\Z))|[ \t]++[A-Za-z0-9+/=]{{32,}}+)?+"
_BODY += rf"(?:{_BREAK}[A-Za-z0-9+/=]++(?=[ \t]*(?:[\r\n\"',]|\\|\Z))|[ \t]++[A-Za-z0-9+/=]{{32,}}+)*+"
_PRIVATE_KEY = rf"-----BEGIN\x20{_LABEL}(?:[^-]*+(?:-(?!----(?:BEGIN|END)\x20)[^-]*+)*+-----END\x20{_LABEL}|{_BODY})"

# Kinds that this method adds.
ADDED = (
    ("private_key", _PRIVATE_KEY, 0, 1),
    ("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
)
RULES = BASE + ADDED

FOUND = "blob string, rule_version string, spans array<struct<kind:string,start:int,end:int>>"


def rule_version(rules=RULES) -> str:
    """Changes with any change of a rule, so that all blobs are scanned anew then."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _compiled(rules):
    """Runs of one character class are searched with their least length at once: shorter runs can't match."""
    out = []
    for kind, pattern, group, least in rules:
        flags = re.ASCII | (re.IGNORECASE if kind == "assign" else 0)
        fast = {"hex": rf"[0-9a-f]{{{least},}}", "access": rf"AKIA[A-Z0-9]{{{least - 4},}}"}
        out.append((kind, re.compile(fast.get(kind, pattern), flags), group, least))
    return out


def spans_of(text: str, compiled) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then by the order of the kinds; ends are exclusive."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(compiled):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def scanned(blobs: DataFrame, rules=RULES) -> DataFrame:
    """Findings of (blob, text) rows."""
    version = rule_version(rules)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = _compiled(rules)
        for frame in frames:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t or "", compiled)] for t in frame["text"]]
            yield pd.DataFrame({"blob": frame["blob"], "rule_version": version, "spans": spans})

    return blobs.select("blob", "text").mapInPandas(tidy(run), FOUND)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the ledger; none if it isn't there yet."""
    try:
        return spark.read.schema(FOUND).parquet(f"{path}/run=*")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], FOUND)


def update_ledger(versions: DataFrame, path: str, rules=RULES) -> DataFrame:
    """Scan what the ledger lacks of ``versions`` (doc_id, text), add it, and return the ledger under this rule version."""
    spark, current = versions.sparkSession, F.col("rule_version") == rule_version(rules)
    known = read_ledger(spark, path).where(current).select("blob")
    held = versions.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"), "doc_id", "text")
    # One holder of each unseen blob: ids only are gathered, then the texts of the holders are scanned.
    holders = held.groupBy("blob").agg(F.min("doc_id").alias("holder")).join(known, "blob", "left_anti")
    texts = held.join(
        holders.withColumnRenamed("blob", "own"),
        (F.col("blob") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("holder")),
        "left_semi",
    )
    scanned(texts, rules).write.option("compression", "zstd").parquet(f"{path}/run={uuid.uuid4().hex}")
    return read_ledger(spark, path).where(current).groupBy("blob").agg(F.max("spans").alias("spans"))


def scan(docs: DataFrame, ledger: str | None = None, rules=RULES) -> DataFrame:
    """Findings of every row: doc_id, blob, spans (array of kind, start, end; empty if there are none).

    ``ledger`` is a folder that outlives the run; by default a new one beside the checkpoints.
    """
    path = ledger or f"{checkpoint_root(docs.sparkSession)}/betaloom/ledger-{uuid.uuid4().hex}"
    found = update_ledger(docs, path, rules).where(F.size("spans") > 0)
    rows = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return rows.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", empty).alias("spans"))


def redacted(docs: DataFrame, ledger: str | None = None, rules=RULES, mark: str = "[secret]") -> DataFrame:
    """All rows and columns of ``docs``; in ``text`` every span found, overlapping ones merged, gives way to ``mark``.

    Null texts stay null.
    """
    found = scan(docs, ledger, rules).where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    rows, names = packed(docs)
    joined = rows.join(found, F.sha2(rows["text"], 256) == found["blob"], "left")
    return unpacked(joined, names, without_spans(F.col("text"), F.col("spans"), mark))

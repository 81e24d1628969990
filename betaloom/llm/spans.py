"""Rows whose text is rewritten while all their other columns pass through, whatever these are named."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column's name as an expression, also with dots and back ticks in it."""
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame, drop: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """``doc_id``, ``text`` and ``rest`` (all columns but ``text`` and those of ``drop``), and the columns' names in order."""
    names = [c for c in docs.columns if c not in drop]
    rest = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names) if c != "text"]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("none"), *rest).alias("rest")), names


def unpacked(rows: DataFrame, names: list[str], text: Column, **added: Column) -> DataFrame:
    """The columns of ``names`` from ``rest`` with ``text`` in its place, then ``added``."""
    made = rows.select("rest", text.alias("text"), *[c.alias(f"added{i}") for i, c in enumerate(added.values())])
    return made.select(
        *[F.col("text") if c == "text" else F.col(f"rest.c{i}").alias(c) for i, c in enumerate(names)],
        *[F.col(f"added{i}").alias(name) for i, name in enumerate(added)],
    )


def without_spans(text: Column, spans: Column, mark: str = "") -> Column:
    """``text`` with every span (start, end; in order of starts) taken out and ``mark`` in its place; overlapping spans are one.

    Each text is sliced once, whatever its spans; texts whose ``spans`` are null stay as they are and aren't sent to Python.
    """

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        out = []
        for whole, low, high in zip(texts, starts, ends, strict=True):
            if not isinstance(whole, str) or low is None:
                out.append(None)
                continue
            pieces, upto = [], 0
            for a, b in zip(low.tolist(), high.tolist(), strict=True):
                if a >= upto:
                    pieces += [whole[upto:a], mark]
                upto = max(upto, b)
            out.append("".join([*pieces, whole[upto:]]))
        return pd.Series(out, dtype=object)

    some = F.when(spans.isNotNull(), text)
    # a filter on the new text must not cut it a second time below, in a second worker of the task
    return F.when(spans.isNull(), text).otherwise(cut.asNondeterministic()(some, spans.getField("start"), spans.getField("end")))

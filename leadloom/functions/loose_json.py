"""Loose JSON: engine parsing first, an Arrow UDF only for the rows where that failed."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PAIRS = {"{": "}", "[": "]"}


def mend(text: str | None) -> str | None:
    """JSON text out of a model's answer: without fences and words around it, commas before closing brackets and bare
    line ends, with quotes and brackets closed; null if there is nothing to mend."""
    if text is None:
        return None
    body = re.sub(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$", "", text.strip())
    first = re.search(r"[\[{]", body)
    if not first:
        return None
    body = body[first.start() :].replace("“", '"').replace("”", '"')
    out, open_, in_text, escaped = [], [], False, False
    for ch in body:
        if in_text:
            in_text = escaped or ch != '"'
            escaped = ch == "\\" and not escaped
            out.append("\\n" if ch == "\n" else ch)
            continue
        if ch == '"':
            in_text = True
        elif ch in _PAIRS:
            open_.append(_PAIRS[ch])
        elif ch in "]}":
            if not open_ or open_[-1] != ch:
                continue
            open_.pop()
        out.append(ch)
        if not open_ and ch in "]}":
            break
    tail = "".join(out) + ('"' if in_text else "")
    tail = re.sub(r"[,:]\s*$", "", tail) + "".join(reversed(open_))
    tail = re.sub(r",\s*([\]}])", r"\1", tail)
    try:
        return json.dumps(json.loads(tail), ensure_ascii=False)
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def mend_udf(texts: pd.Series) -> pd.Series:
    return texts.map(mend)


def parse(df: DataFrame, text: str, schema: str, name: str = "parsed") -> DataFrame:
    """Adds the parsed value; rows that the engine can't parse are mended and parsed again, others never reach Python."""
    wanted: Column = F.from_json(text, schema)
    good = F.try_parse_json(text).isNotNull()
    straight = df.where(good).withColumn(name, wanted)
    mended = df.where(~good & F.col(text).isNotNull()).withColumn("_m", mend_udf(text)).withColumn(name, F.from_json("_m", schema)).drop("_m")
    empty = df.where(F.col(text).isNull()).withColumn(name, F.from_json(text, schema))
    return straight.unionByName(mended).unionByName(empty)

"""Digests and content keys.

The canonical form of a value is JSON with sorted keys, items parted by ", " and keys from values by ": ", and of text only
quotes, backslashes and control characters escaped. These are fixed values of the format, so that keys agree
with those that other programs make of the same values.
"""

from __future__ import annotations

import json
import random

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

#: Control characters with an escape of their own; the others are written by their number.
_SHORT = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def _or_null(c: Column, form: Column) -> Column:
    return F.when(c.isNull(), F.lit("null")).otherwise(form)


def json_text(c: Column) -> Column:
    """A text, or what is cast to one."""
    own = F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escaped = own
    for code in range(32):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(_SHORT.get(chr(code), f"\\u{code:04x}")))
    return _or_null(c, F.concat(F.lit('"'), F.when(own.rlike(r"[\x00-\x1f]"), escaped).otherwise(own), F.lit('"')))


def json_whole(c: Column) -> Column:
    """An integer."""
    return _or_null(c, c.cast("string"))


def json_list(c: Column, item=json_text) -> Column:
    return _or_null(c, F.concat(F.lit("["), F.array_join(F.transform(c, item), ", "), F.lit("]")))


def json_map(c: Column, value=json_text) -> Column:
    """A map with text keys, in the order of their code points."""
    entries = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(json_text(e["key"]), F.lit(": "), value(e["value"])))
    return _or_null(c, F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}")))


def json_object(**forms: Column) -> Column:
    """Of values in canonical form, by name."""
    inner = [x for name in sorted(forms) for x in (F.lit(f"{json.dumps(name)}: "), forms[name], F.lit(", "))][:-1]
    return F.concat(F.lit("{"), *inner, F.lit("}"))


def json_of(value: object) -> Column:
    """A Python value."""
    return F.lit(json.dumps(value, ensure_ascii=False, sort_keys=True))


def json_array(*forms: Column) -> Column:
    """Of values in canonical form."""
    inner = [x for form in forms for x in (form, F.lit(", "))][:-1]
    return F.concat(F.lit("["), *inner, F.lit("]"))


def fingerprint(*forms: Column) -> Column:
    """SHA-256 of a list of values in canonical form."""
    return F.sha2(json_array(*forms).cast("binary"), 256)


def task_signature() -> Column:
    """Of a task row; a change of any of its nine fields changes it."""
    item = lambda x: json_object(item_id=json_text(x["item_id"]), criterion=json_text(x["criterion"]), score=json_whole(x["score"]))
    lists = {c: json_list(F.col(c)) for c in ("gold_urls", "gold_names", "reference_names", "reference_urls")}
    texts = {c: json_text(F.col(c)) for c in ("task_id", "occupation", "prompt")}
    return fingerprint(json_object(ordinal=json_whole(F.col("ordinal")), rubric=json_list(F.col("rubric"), item), **texts, **lists))


def cache_key(signature: Column, model: str, mode: str, provider: object, prompts: tuple[str, ...], *evidence: Column) -> Column:
    """Of a signature, the judge's settings and the evidence in canonical form. The provider is any value that JSON has."""
    return fingerprint(json_text(signature), json_of(model), json_of(mode), json_of(provider), *[json_of(x) for x in prompts], json_array(*evidence))


def coin(signature: Column) -> Column:
    """A fair coin of a hex digest: true in half of all cases, always the same for a digest."""
    return F.conv(F.substring(signature, 1, 1), 16, 10).cast("int") < 8


@F.pandas_udf(BooleanType())
def seeded_coin(signature: pd.Series) -> pd.Series:
    """The first draw of Python's generator seeded with a signature is below a half: the side that other programs give a task.
    Sequential by nature, so no column expression; one draw a task. Null stays null."""
    return signature.map(lambda s: None if s is None else random.Random(s).random() < 0.5).astype("boolean")

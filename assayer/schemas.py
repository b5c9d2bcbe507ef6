"""Explicit schemas: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


BANK = fields(
    task_id=_S, rubric_json=_S, occupation=_S, prompt=_S, deliverable_file_urls=T.ArrayType(_S), deliverable_files=T.ArrayType(_S),
    reference_files=T.ArrayType(_S), reference_file_urls=T.ArrayType(_S),
)
#: A rubric item as it stands in JSON: the score stays text, as both "3" and 2.7 occur.
RAW_ITEMS = T.ArrayType(fields(rubric_item_id=_S, criterion=_S, score=_S))
ITEM = fields(item_id=_S, criterion=_S, score=_L)
MANIFEST = fields(products=T.ArrayType(_S), tasks=T.ArrayType(fields(ordinal=_L, signature=_S, files=T.MapType(_S, _S))))
METRIC_FIELDS = ("product", "task", "status", "session", "elapsed_seconds", "tokens", "notes")
STATUSES = ("pending", "running", "completed", "failed")
VERDICT = fields(key=_S, seq=_L, met=_B, score=_D, a_side=_S, cost=_D)
REPLY = fields(text=_S, cost=_D, provider=_S, error=_S)
DELIVERABLE_SUFFIXES = ("xlsx", "docx", "pptx", "pdf")
#: Fixed values of the file and report formats.
NOTE_SEPARATOR = "；"
MAX_CHARS = 2_000_000
MAX_CELLS = 200_000
MAX_PDF_PAGES = 500

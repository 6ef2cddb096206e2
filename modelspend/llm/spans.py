"""Span strings as the contracts want them: kind:start:end by start, then kind as listed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spans as (start, rank of the kind, end), which sorts as the contracts want.
SPANS = "array<struct<start:int,kind:int,end:int>>"


def span_string(spans: Column, kinds: tuple[str, ...]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def of_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

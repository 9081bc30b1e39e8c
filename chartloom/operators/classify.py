"""Prose classification through a callable of the caller's; without one the columns are NULL."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLOOR = 0.6
#: What a reply may say.
ALLOWED = {"laterality": {"left", "right", "bilateral"}, "visit_type": {"new", "follow_up", "post_op"}}
FIELDS = ("body_region", "laterality", "visit_type", "hpi_summary")
COLUMNS = {f: "string" for f in FIELDS} | {"llm_confidence": "double", "classify_error": "string"}


def vetted(reply: str, regions: set[str] | None) -> dict:
    """Fields of a JSON reply: unknown values and 'none' are NULL; below the floor all are."""
    said = json.loads(reply)
    sure = float(said.get("confidence") or 0)
    if sure < FLOOR:
        return {f: None for f in FIELDS} | {"llm_confidence": sure}
    allowed = ALLOWED | ({"body_region": regions} if regions else {})
    out: dict = {"llm_confidence": sure}
    for field in FIELDS:
        value = said.get(field)
        value = None if value is None or str(value).strip().lower() in ("", "none") else str(value)
        out[field] = value if field not in allowed or value in allowed[field] else None
    return out


def classified(visits: DataFrame, text_column: str, model: Callable[[str], str] | None = None, regions: set[str] | None = None) -> DataFrame:
    """visits plus COLUMNS. Empty text is not asked about; any failure gives NULLs and an error."""
    names = list(COLUMNS)
    if model is None:
        return visits.withColumns({n: F.lit(None).cast(kind) for n, kind in COLUMNS.items()})

    def ask(text: str | None) -> dict:
        none = {n: None for n in names}
        if not text or not text.strip():
            return none
        try:
            return none | vetted(model(text), regions)
        except Exception as e:  # noqa: BLE001
            return none | {"classify_error": type(e).__name__}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = pd.DataFrame([ask(t) for t in pdf[text_column]], columns=names, index=pdf.index, dtype=object)
            found["llm_confidence"] = found["llm_confidence"].astype(float)
            yield pd.concat([pdf, found], axis=1)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in visits.schema)
    return visits.mapInPandas(run, f"{kinds}, {', '.join(f'{n} {kind}' for n, kind in COLUMNS.items())}")

"""Release rows to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fichario.functions import registry as R
from fichario.functions.text import clean_text
from fichario.schemas import AMOUNT_COLUMNS, DATE_COLUMNS, DATASETS


def clean_rows(raw: DataFrame, kind: str, competence: str | None = None) -> DataFrame:
    """Clean one dataset's raw rows: one projection, no shuffle.

    Extra input columns (file name, position) are kept. ``competence`` stamps fact rows (P6);
    without it an input column ``source_competence`` is kept as it is.
    """
    dataset = DATASETS[kind]
    cleaned = {}
    for name in dataset.columns:
        text = clean_text(F.col(name))
        if name in DATE_COLUMNS:
            cleaned[name] = R.parse_date(F.col(name))
        elif name in AMOUNT_COLUMNS:
            cleaned[name] = R.parse_amount(text)
        else:
            cleaned[name] = text
    typed = raw.withColumns(cleaned)
    if dataset.key == "cnpj":
        typed = typed.withColumn("cnpj", R.branch_key(*map(F.col, dataset.columns[:3])))
    elif dataset.key == "id":
        typed = typed.withColumn("id", R.content_hash([F.col(c) for c in dataset.columns]))
    if competence is not None and not dataset.is_lookup:
        typed = typed.withColumn("source_competence", F.lit(competence))
    return typed

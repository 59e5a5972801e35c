"""All queries of this subpackage and their SQL, by name."""

from __future__ import annotations

import corpus_pipeline
from plotweave.llm import (
    alignment,
    decontamination,
    id_files,
    licenses,
    near_duplicates,
    neighbours,
    packing,
    passages,
    pii,
    quality,
    repeats,
    toxicity,
    vector_codes,
)

_MODULES = [
    packing, licenses, decontamination, near_duplicates, toxicity, quality, id_files, pii, neighbours, repeats,
    alignment, vector_codes, passages,
]


def queries() -> dict:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}

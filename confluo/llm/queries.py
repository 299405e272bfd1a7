"""The subpackage's queries and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import sql
from .decontaminate import op4_decontamination
from .language import op1_language
from .lattice import op9_embedding_dedup
from .licenses import op6_licenses
from .lines import op10_line_dedup
from .mixing import op5_mixing
from .simhash import op8_simhash
from .tokens import op2_token_counts, op3_token_files
from .toxicity import op7_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language": op1_language,
        "op2_token_counts": op2_token_counts,
        "op3_token_files": op3_token_files,
        "op4_decontamination": op4_decontamination,
        "op5_mixing": op5_mixing,
        "op6_licenses": op6_licenses,
        "op7_toxicity": op7_toxicity,
        "op8_simhash": op8_simhash,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_line_dedup": op10_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_mixing": sql.MIXING, "op6_licenses": sql.licenses()}

"""Registered queries of this subpackage and, where SQL can say the same, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe_automaton import op7
from .decontaminate import op8
from .exact_dedup import op11
from .html_extract import op2
from .impact_search import op12
from .kn_quality import op9
from .license_scan import op5
from .maxscore import op4
from .minhash_dedup import op1
from .oracles import ALL
from .substring_dedup import op3
from .suffix_dedup import op10
from .token_counts import op6

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_minhash_dedup": op1,
        "op2_html_extract": op2,
        "op3_substring_dedup": op3,
        "op4_maxscore": op4,
        "op5_license_scan": op5,
        "op6_token_counts": op6,
        "op7_bpe_automaton": op7,
        "op8_decontaminate": op8,
        "op9_kn_quality": op9,
        "op10_suffix_dedup": op10,
        "op11_exact_dedup": op11,
        "op12_impact_search": op12,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ALL)

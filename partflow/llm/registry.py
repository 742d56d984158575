"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from partflow.llm import (
    decontaminate, embedding_dedup, html_extract, language_id, lexical_search, line_dedup, lm, matroska, mixing, near_dup, periodic_runs, substring_dedup, warc,
)


def queries() -> dict:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_substring_dedup": substring_dedup.op2_substring_dedup,
        "op3_matroska": matroska.op3_matroska,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_language_id": language_id.op5_language_id,
        "op6_lm_scoring": lm.op6_lm_scoring,
        "op7_warc": warc.op7_warc,
        "op10_near_dup": near_dup.op10_near_dup,
        "op9_html_extract": html_extract.op9_html_extract,
        "op8_mix_sources": mixing.op8_mix_sources,
        "op11_lexical_search": lexical_search.op11_lexical_search,
        "op12_periodic_runs": periodic_runs.op12_periodic_runs,
        "op13_embedding_dedup": embedding_dedup.op13_embedding_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.OP1_SQL,
        "op2_substring_dedup": substring_dedup.OP2_SQL,
        "op4_decontaminate": decontaminate.OP4_SQL,
        "op10_near_dup": near_dup.OP10_SQL,
        "op7_warc": warc.OP7_SQL,
        "op11_lexical_search": lexical_search.OP11_SQL,
        "op12_periodic_runs": periodic_runs.OP12_SQL,
        "op13_embedding_dedup": embedding_dedup.OP13_SQL,
    }

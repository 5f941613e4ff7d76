"""The queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidelog.llm import alignment, collocations, decontam, exact_dedup, hmm, language_id, licences, mixing, near_dedup, sharding, toxicity, url_filter, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": exact_dedup.op1,
        "op2_warc": warc.op2,
        "op3_decontam": decontam.op3,
        "op4_near_dedup": near_dedup.op4,
        "op5_language_id": language_id.op5,
        "op6_toxicity": toxicity.op6,
        "op7_mixing": mixing.op7,
        "op8_hmm": hmm.op8,
        "op9_url_filter": url_filter.op9,
        "op10_sharding": sharding.op10,
        "op11_collocations": collocations.op11,
        "op12_licences": licences.op12,
        "op13_alignment": alignment.op13,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": exact_dedup.OP1_SQL, "op2_warc": warc.OP2_SQL, "op3_decontam": decontam.OP3_SQL, "op4_near_dedup": near_dedup.OP4_SQL, "op7_mixing": mixing.OP7_SQL, "op11_collocations": collocations.OP11_SQL, "op12_licences": licences.OP12_SQL}

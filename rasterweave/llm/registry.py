"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rasterweave.llm.centroids import op13_centroids
from rasterweave.llm.decontamination import op10_decontamination
from rasterweave.llm.fingerprint import op1_fingerprint
from rasterweave.llm.lm_scoring import op2_lm_scoring
from rasterweave.llm.mixing import op9_mixing
from rasterweave.llm.ngram_join import op5_ngram_jaccard
from rasterweave.llm.pii import op3_pii
from rasterweave.llm.quality import op7_quality
from rasterweave.llm.sql import ORACLE
from rasterweave.llm.substring_dedup import op4_substring
from rasterweave.llm.suffix_dedup import op8_suffix_array
from rasterweave.llm.vector_codes import op11_vector_codes
from rasterweave.llm.vector_search import op12_top_k
from rasterweave.llm.warc import op6_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_fingerprint, op2_lm_scoring, op3_pii, op4_substring, op5_ngram_jaccard, op6_warc, op7_quality, op8_suffix_array, op9_mixing, op10_decontamination, op11_vector_codes, op12_top_k, op13_centroids)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

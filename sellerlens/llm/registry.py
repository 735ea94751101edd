"""The corpus operators as queries over a scale-factor folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sellerlens.llm.bpe import op5_bpe_codec
from sellerlens.llm.chat_format import OP13_SQL, op13_chat_format
from sellerlens.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from sellerlens.llm.fingerprint import op10_fingerprints
from sellerlens.llm.lang_id import op7_language_id
from sellerlens.llm.license_scan import op6_license_scan
from sellerlens.llm.ngram_join import OP8_SQL, op8_ngram_jaccard
from sellerlens.llm.packing import op4_best_fit_packing
from sellerlens.llm.secret_scan import op1_secret_scan
from sellerlens.llm.source_divergence import OP11_SQL, op11_source_divergence
from sellerlens.llm.spelling_variants import OP12_SQL, op12_spelling_variants
from sellerlens.llm.surrogates import op3_pii_surrogates
from sellerlens.llm.url_filter import op2_url_filter

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_url_filter": op2_url_filter,
        "op3_pii_surrogates": op3_pii_surrogates,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_bpe_codec": op5_bpe_codec,
        "op6_license_scan": op6_license_scan,
        "op7_language_id": op7_language_id,
        "op8_ngram_jaccard": op8_ngram_jaccard,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_fingerprints": op10_fingerprints,
        "op11_source_divergence": op11_source_divergence,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_chat_format": op13_chat_format,
        "pipeline": corpus_pipeline.run,
    }


def llm_sql() -> dict[str, str]:
    return {
        "op8_ngram_jaccard": OP8_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op11_source_divergence": OP11_SQL,
        "op12_spelling_variants": OP12_SQL,
        "op13_chat_format": OP13_SQL,
    }

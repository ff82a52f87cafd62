"""The registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from ledgerlens.llm.bpe import op5_byte_bpe
from ledgerlens.llm.common import ship_package
from ledgerlens.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from ledgerlens.llm.html_extract import op10_html_extract
from ledgerlens.llm.lexical import OP11_SQL, op11_lexical_search
from ledgerlens.llm.license_scan import op6_license_scan
from ledgerlens.llm.merkle import OP13_SQL, op13_merkle_manifest
from ledgerlens.llm.nearest import op3_nearest
from ledgerlens.llm.packing import op9_best_fit_packing
from ledgerlens.llm.secret_scan import op4_secret_scan
from ledgerlens.llm.sharding import op12_label_propagation_shards
from ledgerlens.llm.simhash import op7_simhash
from ledgerlens.llm.token_files import op8_token_files
from ledgerlens.llm.toxicity import op2_toxicity


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _shipped(query) for name, query in {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_nearest": op3_nearest,
    "op4_secret_scan": op4_secret_scan,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_license_scan": op6_license_scan,
    "op7_simhash": op7_simhash,
    "op8_token_files": op8_token_files,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_html_extract": op10_html_extract,
    "op11_lexical_search": op11_lexical_search,
    "op12_label_propagation_shards": op12_label_propagation_shards,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}.items()}

ORACLE_SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_merkle_manifest": OP13_SQL,
}

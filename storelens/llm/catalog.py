"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import sql
from .bpe import op1_bpe
from .centroids import op13_centroids
from .embeddings import op5_embedding_dedup
from .minhash import op6_minhash
from .packing import op9_packing
from .periodic import op11_periodic_runs
from .pii import op10_pii
from .ppm import op7_ppm
from .quality import op8_quality
from .repeats import op12_suffix_dedup
from .toxicity import op2_toxicity
from .urls import op3_url_filters
from .warc import op4_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_url_filters": op3_url_filters,
    "op4_warc": op4_warc,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_minhash": op6_minhash,
    "op7_ppm": op7_ppm,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_centroids": op13_centroids,
}

SQL: dict[str, str] = {
    "op3_url_filters": sql.url_filters(),
    "op5_embedding_dedup": sql.EMBEDDINGS,
    "op6_minhash": sql.MINHASH,
    "op13_centroids": sql.centroids(),
}

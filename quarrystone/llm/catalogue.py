"""Queries of this subpackage and the SQL that must agree with them, where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrystone.llm import queries_forest, queries_lines, queries_warc
from quarrystone.llm.queries_bpe import op5_bpe
from quarrystone.llm.queries_fingerprints import op7_fingerprints
from quarrystone.llm.queries_forest import op1_embedding_forest
from quarrystone.llm.queries_lines import op10_line_dedup
from quarrystone.llm.queries_mixing import op3_mixing
from quarrystone.llm.queries_paragraphs import op6_paragraph_dedup
from quarrystone.llm.queries_secrets import op2_secrets
from quarrystone.llm.queries_simhash import op9_simhash
from quarrystone.llm.queries_toxicity import op8_toxicity
from quarrystone.llm.queries_warc import op4_warc

_ALL = (op1_embedding_forest, op2_secrets, op3_mixing, op4_warc, op5_bpe, op6_paragraph_dedup, op7_fingerprints, op8_toxicity, op9_simhash, op10_line_dedup)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
ORACLES: dict[str, str] = {"op1_embedding_forest": queries_forest.SQL, "op4_warc": queries_warc.SQL, "op10_line_dedup": queries_lines.SQL}

"""The queries of this package over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm.bpe_codec import op8_bpe_codec
from pagemill.llm.chat_format import OP9_SQL, op9_chat_format
from pagemill.llm.decontaminate import OP5_SQL, op5_decontaminate
from pagemill.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from pagemill.llm.licenses import op2_license_scan, op2_sql
from pagemill.llm.merkle import OP13_SQL, op13_merkle_manifest
from pagemill.llm.ngram_join import OP1_SQL, op1_ngram_join
from pagemill.llm.quality import op6_quality_rules
from pagemill.llm.sentence_dedup import op7_sentence_dedup
from pagemill.llm.sharding import op10_sharding
from pagemill.llm.suffix_dedup import OP3_SQL, op3_suffix_dedup
from pagemill.llm.token_counts import op4_token_counts
from pagemill.llm.warc import OP11_SQL, op11_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_license_scan": op2_license_scan,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentence_dedup": op7_sentence_dedup,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_chat_format": op9_chat_format,
    "op10_sharding": op10_sharding,
    "op11_warc": op11_warc,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op1_ngram_join": OP1_SQL,
    "op2_license_scan": op2_sql(),
    "op3_suffix_dedup": OP3_SQL,
    "op5_decontaminate": OP5_SQL,
    "op9_chat_format": OP9_SQL,
    "op11_warc": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}

"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, chat_format, decontaminate, line_dedup, ngram_join, quality_rules, record_files, secret_scan, substring_index, zip_warc

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_record_files": record_files.op3_record_files,
    "op4_zip_warc": zip_warc.op4_zip_warc,
    "op5_ngram_join": ngram_join.op5_ngram_join,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_bpe": bpe.op7_bpe,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_chat_format": chat_format.op9_chat_format,
    "op10_substring_index": substring_index.op10_substring_index,
}

ORACLES = {
    "op1_line_dedup": line_dedup.SQL,
    "op2_quality_rules": quality_rules.SQL,
    "op5_ngram_join": ngram_join.SQL,
    "op6_decontaminate": decontaminate.SQL,
    "op8_secret_scan": secret_scan.SQL,
    "op9_chat_format": chat_format.SQL,
    "op10_substring_index": substring_index.SQL,
}

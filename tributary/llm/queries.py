"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import archives, decontamination, disclosure, imatch, language, licenses, line_dedup, packing, quality, simhash

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_imatch": imatch.op2_imatch,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_warc": archives.op4_warc,
    "op5_quality": quality.op5_quality,
    "op6_language": language.op6_language,
    "op7_licenses": licenses.op7_licenses,
    "op8_packing": packing.op8_packing,
    "op9_disclosure": disclosure.op9_disclosure,
    "op10_decontamination": decontamination.op10_decontamination,
}

ORACLE_SQL = {
    "op3_line_dedup": line_dedup.SQL,
    "op4_warc": archives.SQL,
    "op10_decontamination": decontamination.SQL,
}

"""Queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import bpe, decontaminate, fingerprint, langid, license_scan, near_dedup, pii, token_count, toxicity, url_filter

QUERIES = {
    "op1_license_scan": license_scan.query,
    "op2_langid": langid.query,
    "op3_bpe": bpe.query,
    "op4_decontaminate": decontaminate.query,
    "op5_pii": pii.query,
    "op6_url_filter": url_filter.query,
    "op7_token_count": token_count.query,
    "op8_fingerprint": fingerprint.query,
    "op9_toxicity": toxicity.query,
    "op10_near_dedup": near_dedup.query,
}
ORACLES = {"op4_decontaminate": decontaminate.ORACLE, "op6_url_filter": url_filter.ORACLE, "op10_near_dedup": near_dedup.ORACLE}

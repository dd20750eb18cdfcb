"""Queries of this subpackage and their SQL, keyed by name."""

from __future__ import annotations

from cardlens.llm import (decontaminate, fingerprint, html_extract, merkle, mixing, near_dedup, pii, quality, search,
                           sharding, tool_calls, url_filter, warc)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_pii": pii.op3_pii,
    "op4_fingerprint": fingerprint.op4_fingerprint,
    "op5_quality": quality.op5_quality,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_mix": mixing.op7_mix,
    "op8_tool_calls": tool_calls.op8_tool_calls,
    "op9_html_extract": html_extract.op9_html_extract,
    "op10_warc": warc.op10_warc,
    "op11_search": search.op11_search,
    "op12_sharding": sharding.op12_sharding,
    "op13_merkle": merkle.op13_merkle,
}

ORACLE_SQL = {
    "op1_url_filter": url_filter.OP1_SQL,
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op8_tool_calls": tool_calls.OP8_SQL,
    "op10_warc": warc.OP10_SQL,
    "op11_search": search.OP11_SQL,
    "op13_merkle": merkle.OP13_SQL,
}

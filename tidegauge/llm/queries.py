"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tidegauge.llm import ann, html, langid, licences, media, mixing, packing, quality, sharding, simhash, spelling, turns, urls


def queries() -> dict:
    return {
        "op1_license_scan": licences.op1_license_scan,
        "op2_simhash": simhash.op2_simhash,
        "op3_url_filter": urls.op3_url_filter,
        "op4_mixing": mixing.op4_mixing,
        "op5_sharding": sharding.op5_sharding,
        "op6_html_text": html.op6_html_text,
        "op7_language_id": langid.op7_language_id,
        "op8_packing": packing.op8_packing,
        "op9_media": media.op9_media,
        "op10_ann": ann.op10_ann,
        "op11_spelling_variants": spelling.op11_spelling_variants,
        "op12_quality": quality.op12_quality,
        "op13_turn_repair": turns.op13_turn_repair,
    }


def oracle_sql() -> dict:
    return {"op3_url_filter": urls.oracle_sql(), "op11_spelling_variants": spelling.oracle_sql()}

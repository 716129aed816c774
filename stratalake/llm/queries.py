"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from stratalake.llm import (
    byte_bpe, collocations, decontaminate, html_text, language, packing, quality, quality_rules, sharding, simhash, substrings, urls, variants)

QUERIES = {f.__name__: f for f in (
    quality_rules.op1_quality_rules, html_text.op2_html, sharding.op3_sharding, urls.op4_url_filter,
    decontaminate.op5_decontaminate, quality.op6_quality, substrings.op7_substrings, simhash.op8_simhash,
    packing.op9_packing, language.op10_language, collocations.op11_collocations, byte_bpe.op12_bpe, variants.op13_variants)}
ORACLES = decontaminate.SQL | substrings.SQL | collocations.SQL

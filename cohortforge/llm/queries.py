"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from cohortforge.llm import bpe, decontam, jaccard, jpeg, licences, lm, oracles, periodic, quality, rules, suffixdedup, toxicity, vectorcodes, warc

QUERIES = {
    "op1_suffix_dedup": suffixdedup.query,
    "op2_decontaminate": decontam.query,
    "op3_toxicity": toxicity.query,
    "op4_progressive_jpeg": jpeg.query,
    "op5_byte_bpe": bpe.query,
    "op6_jaccard_join": jaccard.query,
    "op7_quality": quality.query,
    "op8_warc_zip": warc.query,
    "op9_licence_scan": licences.query,
    "op10_lm_score": lm.query,
    "op11_periodic_runs": periodic.query,
    "op12_quality_rules": rules.query,
    "op13_vector_codes": vectorcodes.query,
}

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op2_decontaminate": oracles.DECONTAMINATE,
    "op6_jaccard_join": oracles.JACCARD,
    "op8_warc_zip": warc.ORACLE,
    "op11_periodic_runs": periodic.ORACLE,
    "op13_vector_codes": vectorcodes.ORACLE,
}

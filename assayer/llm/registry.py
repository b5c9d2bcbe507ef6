"""Queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from . import bpe, decontam, langid, lmscore, media, ngram, packing, periodic, quotes, sharding, simhash, spelling, toxicity


def queries() -> dict:
    return {
        "op1_bpe_forced_boundaries": bpe.op1_bpe_forced_boundaries,
        "op2_quotation_linking": quotes.op2_quotation_linking,
        "op3_lm_pseudo_likelihood": lmscore.op3_lm_pseudo_likelihood,
        "op4_decontamination": decontam.op4_decontamination,
        "op5_sharding": sharding.op5_sharding,
        "op6_quality_ngram": ngram.op6_quality_ngram,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_media_columns": media.op8_media_columns,
        "op9_language_id": langid.op9_language_id,
        "op10_simhash": simhash.op10_simhash,
        "op11_best_fit_packing": packing.op11_best_fit_packing,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_periodic_runs": periodic.op13_periodic_runs,
        "op2_quoted_replies": quotes.op2_quoted_replies,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quotation_linking": quotes.OP2_SQL, "op2_quoted_replies": quotes.OP2_QUOTED_SQL, "op4_decontamination": decontam.OP4_SQL}

"""Registered queries of the operators and their SQL counterparts."""

from readgrade.llm import (
    byte_cnn, conversations, exact_dedup, hard_negatives, kn_toxicity, language_id, latent_decontam, line_dedup, lm_scoring, mixing, simhash, token_counts,
    topk)

QUERIES = {
    "op1_lm_scoring": lm_scoring.op1_lm_scoring,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_language_profiles": language_id.op3_language_profiles,
    "op4_quality_cnn": byte_cnn.op4_quality_cnn,
    "op5_temperature_mixing": mixing.op5_temperature_mixing,
    "op6_toxicity_kneser_ney": kn_toxicity.op6_toxicity_kneser_ney,
    "op7_simhash": simhash.op7_simhash,
    "op8_site_lines": line_dedup.op8_site_lines,
    "op9_latent_decontamination": latent_decontam.op9_latent_decontamination,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_threshold_topk": topk.op12_threshold_topk,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLES = {"op5_temperature_mixing": mixing.OP5_SQL, "op8_site_lines": line_dedup.OP8_SQL,
           "op10_exact_dedup": exact_dedup.OP10_SQL,
           "op11_conversation_repair": conversations.OP11_SQL, "op12_threshold_topk": topk.OP12_SQL,
           "op13_hard_negatives": hard_negatives.OP13_SQL}

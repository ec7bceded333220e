"""The operators' queries by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from driftline.llm import conversations, decontaminate, exact_dedup, leaderboard, near_dedup, pieces, prefix_bpe, quality, repeats, secrets, token_files, toxicity, warc_fixity

QUERIES = {
    "op1_token_files": token_files.op1_token_files,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_warc_fixity": warc_fixity.op3_warc_fixity,
    "op4_suffix_dedup": repeats.op4_suffix_dedup,
    "op5_quality": quality.op5_quality,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_sentencepiece": pieces.op7_sentencepiece,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_prefix_bpe": prefix_bpe.op11_prefix_bpe,
    "op12_leaderboard": leaderboard.op12_leaderboard,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}

ORACLES = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op3_warc_fixity": warc_fixity.ORACLE,
    "op4_suffix_dedup": repeats.ORACLE,
    "op6_near_dedup": near_dedup.ORACLE,
    "op8_secret_scan": secrets.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op12_leaderboard": leaderboard.ORACLE,
    "op13_conversation_repair": conversations.ORACLE,
}

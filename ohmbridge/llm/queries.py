"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from ohmbridge.llm import bpe, gbdt, hmm, jpeg, langid, linededup, mixing, neardup, robust, secrets

QUERIES = {
    "op1_near_duplicates": neardup.op1_near_duplicates,
    "op2_mixing": mixing.op2_mixing,
    "op3_media": jpeg.op3_media,
    "op4_secrets": secrets.op4_secrets,
    "op5_quality": gbdt.op5_quality,
    "op6_language_model": hmm.op6_language_model,
    "op7_bpe": bpe.op7_bpe,
    "op8_language": langid.op8_language,
    "op9_line_dedup": linededup.op9_line_dedup,
    "op10_outliers": robust.op10_outliers,
}

ORACLE_SQL: dict[str, str] = {
    "op1_near_duplicates": neardup.OP1_SQL,
    "op2_mixing": mixing.OP2_SQL,
    "op9_line_dedup": linededup.OP9_SQL,
}

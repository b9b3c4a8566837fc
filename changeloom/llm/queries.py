"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, chat, fingerprints, jaccard, langid, licenses, mixing, quality, toxicity, transport


def queries() -> dict:
    return {
        "op1_transport_streams": transport.query,
        "op2_quality_classifier": quality.query,
        "op3_jaccard_join": jaccard.query,
        "op4_language_id": langid.query,
        "op5_toxicity": toxicity.query,
        "op6_license_scans": licenses.query,
        "op7_document_fingerprints": fingerprints.query,
        "op8_source_mixing": mixing.query,
        "op9_chat_formatting": chat.query,
        "op10_byte_bpe": bpe.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_jaccard_join": jaccard.ORACLE_SQL, "op8_source_mixing": mixing.ORACLE_SQL, "op9_chat_formatting": chat.ORACLE_SQL}

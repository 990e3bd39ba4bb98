"""The registered queries of this folder and their SQL twins."""

from __future__ import annotations

from tidemark.llm import (alignment, ann, bagminhash, bpe, collocations, decontam, langid, licenses,
                          pii, secrets, suffix_dedup, token_files, url_filter)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_near_duplicates": bagminhash.op2_near_duplicates,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_byte_bpe": bpe.op4_byte_bpe,
    "op5_decontamination": decontam.op5_decontamination,
    "op6_language_id": langid.op6_language_id,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_nearest_neighbours": ann.op10_nearest_neighbours,
    "op11_token_files": token_files.op11_token_files,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE: dict[str, str] = {
    "op5_decontamination": decontam.ORACLE,
    "op9_url_filter": url_filter.ORACLE,
    "op13_collocations": collocations.ORACLE,
}

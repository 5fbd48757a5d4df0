"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from . import ann, bpe, idcoder, language, neardup_vectors, packing, sharding, simhash, substrings, urls


def queries() -> dict:
    return {
        "op1_sharding": sharding.op1_sharding,
        "op2_urls": urls.op2_urls,
        "op3_packing": packing.op3_packing,
        "op4_vectors": neardup_vectors.op4_vectors,
        "op5_language": language.op5_language,
        "op6_substrings": substrings.op6_substrings,
        "op7_idcoder": idcoder.op7_idcoder,
        "op8_simhash": simhash.op8_simhash,
        "op9_ann": ann.op9_ann,
        "op10_bpe": bpe.op10_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {}

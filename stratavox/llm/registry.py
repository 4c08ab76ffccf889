"""The queries of this subpackage and the SQL that some of them can be held against."""

from __future__ import annotations

from stratavox.llm.centroids import OP12_SQL, op12_centroids
from stratavox.llm.chat import OP5_SQL, op5_chat
from stratavox.llm.digest import op9_fingerprints
from stratavox.llm.extract import op10_extraction
from stratavox.llm.jaccard import op6_jaccard
from stratavox.llm.media import op4_media
from stratavox.llm.minhash import op11_minhash
from stratavox.llm.mixing import op7_mixing
from stratavox.llm.packing import op8_packing
from stratavox.llm.personal import op3_personal
from stratavox.llm.quality import op1_quality
from stratavox.llm.repair import OP13_SQL, op13_repair
from stratavox.llm.suffix import op2_suffix_dedup


def queries() -> dict:
    return {
        "op1_quality": op1_quality,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_personal": op3_personal,
        "op4_media": op4_media,
        "op5_chat": op5_chat,
        "op6_jaccard": op6_jaccard,
        "op7_mixing": op7_mixing,
        "op8_packing": op8_packing,
        "op9_fingerprints": op9_fingerprints,
        "op10_extraction": op10_extraction,
        "op11_minhash": op11_minhash,
        "op12_centroids": op12_centroids,
        "op13_repair": op13_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_chat": OP5_SQL, "op12_centroids": OP12_SQL, "op13_repair": OP13_SQL}

"""The registered queries of this subpackage, and the SQL that gives the same rows where SQL can."""

from tablesync.llm.decontaminate import op7_decontamination
from tablesync.llm.language_id import op6_language_id
from tablesync.llm.license_scan import op1_license_scan
from tablesync.llm.near_dedup import OP9_SQL, op9_minhash_near_dedup
from tablesync.llm.packing import op10_best_fit_packing
from tablesync.llm.pii_terms import op4_pii_terms
from tablesync.llm.quality_gbt import op8_quality_gbt
from tablesync.llm.quality_rules import op3_quality_rules
from tablesync.llm.spelling import op13_spelling_variants
from tablesync.llm.substring_dedup import OP5_SQL, op5_substring_dedup
from tablesync.llm.toxicity import op12_toxicity
from tablesync.llm.vector_codes import OP11_SQL, op11_vector_codes
from tablesync.llm.warc_archive import OP2_SQL, op2_warc_archive

QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_warc_archive, op3_quality_rules, op4_pii_terms,
        op5_substring_dedup, op6_language_id, op7_decontamination, op8_quality_gbt,
        op9_minhash_near_dedup, op10_best_fit_packing,
        op11_vector_codes, op12_toxicity, op13_spelling_variants,
    )
}

ORACLES: dict[str, str] = {
    "op2_warc_archive": OP2_SQL, "op5_substring_dedup": OP5_SQL, "op9_minhash_near_dedup": OP9_SQL,
    "op11_vector_codes": OP11_SQL,
}

"""The registered queries of the subpackage, and SQL where SQL can express one."""

import corpus_pipeline
from gleaner.llm import chaining, decontaminate, fill_in_middle, hard_negatives, ivfpq, knn_quality, mixing, pii, pseudo_likelihood, quality_rules, simhash, suffix_dedup, warc

QUERIES = {
    "op1_pii": pii.op1,
    "op2_knn_quality": knn_quality.op2,
    "op3_chaining": chaining.op3,
    "op4_suffix_dedup": suffix_dedup.op4,
    "op5_warc": warc.op5,
    "op6_mixing": mixing.op6,
    "op7_simhash": simhash.op7,
    "op8_pseudo_likelihood": pseudo_likelihood.op8,
    "op9_quality_rules": quality_rules.op9,
    "op10_decontaminate": decontaminate.op10,
    "op11_hard_negatives": hard_negatives.op11,
    "op12_fill_in_middle": fill_in_middle.op12,
    "op13_ivfpq": ivfpq.op13,
    "pii_base_columns": pii.base_columns,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {"op5_warc": warc.OP5_SQL, "op6_mixing": mixing.OP6_SQL, "op9_quality_rules": quality_rules.OP9_SQL, "op10_decontaminate": decontaminate.OP10_SQL, "op11_hard_negatives": hard_negatives.OP11_SQL, "op12_fill_in_middle": fill_in_middle.OP12_SQL, "pii_base_columns": pii.BASE_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

"""The package's queries and their DuckDB equivalents, by name."""

from __future__ import annotations

from modelspend.llm.op01_benchmark_wand import op1_benchmark_wand
from modelspend.llm.op02_disclosive_terms import op2_disclosive_terms
from modelspend.llm.op03_simhash_bktree import op3_simhash_bktree
from modelspend.llm.op04_piece_sampling import op4_piece_sampling
from modelspend.llm.op05_license_templates import op5_license_templates
from modelspend.llm.op06_text_density import op6_text_density
from modelspend.llm.op07_kneser_ney import op7_kneser_ney
from modelspend.llm.op08_quality_outliers import op8_quality_outliers
from modelspend.llm.op09_reply_trees import op9_reply_trees
from modelspend.llm.op10_linked_credentials import op10_linked_credentials
from modelspend.llm.op11_lsh_forest import op11_lsh_forest
from modelspend.llm.op12_turn_repair import op12_turn_repair
from modelspend.llm.op13_ns_clustering import SQL as CLUSTERING_SQL
from modelspend.llm.op13_ns_clustering import op13_ns_clustering

QUERIES = {
    f.__name__: f
    for f in (
        op1_benchmark_wand,
        op2_disclosive_terms,
        op3_simhash_bktree,
        op4_piece_sampling,
        op5_license_templates,
        op6_text_density,
        op7_kneser_ney,
        op8_quality_outliers,
        op9_reply_trees,
        op10_linked_credentials,
        op11_lsh_forest,
        op12_turn_repair,
        op13_ns_clustering,
    )
}

ORACLE_SQL: dict[str, str] = {"op13_ns_clustering": CLUSTERING_SQL}

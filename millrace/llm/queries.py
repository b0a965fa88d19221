"""Queries over the operators of this subpackage, and DuckDB SQL where it can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.bpe import op6_bpe_codec
from millrace.llm.chat import op8_chat_formatting
from millrace.llm.hardneg import OP11_SQL, op11_hard_negatives
from millrace.llm.jumphash import op3_jump_sharding
from millrace.llm.ledger import OP9_SQL, op9_quality_rules
from millrace.llm.lineruns import OP4_SQL, op4_line_dedup
from millrace.llm.lmscore import op13_lm_scoring
from millrace.llm.oracles import OP1_SQL, OP2_SQL, OP5_SQL, OP8_SQL
from millrace.llm.periodic import OP12_SQL, op12_periodic_runs
from millrace.llm.recount import op10_token_counts
from millrace.llm.repeats import op1_substring_dedup
from millrace.llm.setsketch import op5_minhash_near_dedup
from millrace.llm.toxicity import op7_toxicity
from millrace.llm.winnowing import op2_benchmark_decontamination

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_benchmark_decontamination,
        op3_jump_sharding,
        op4_line_dedup,
        op5_minhash_near_dedup,
        op6_bpe_codec,
        op7_toxicity,
        op8_chat_formatting,
        op9_quality_rules,
        op10_token_counts,
        op11_hard_negatives,
        op12_periodic_runs,
        op13_lm_scoring,
    )
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_benchmark_decontamination": OP2_SQL,
    "op4_line_dedup": OP4_SQL,
    "op5_minhash_near_dedup": OP5_SQL,
    "op8_chat_formatting": OP8_SQL,
    "op9_quality_rules": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_periodic_runs": OP12_SQL,
}

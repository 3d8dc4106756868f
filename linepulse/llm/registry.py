"""The operators' queries, and SQL for those that SQL can express."""

from __future__ import annotations

from linepulse.llm.align import op13_align
from linepulse.llm.decontaminate import op8_decontaminate, op8_oracle_sql
from linepulse.llm.langid import op3_langid
from linepulse.llm.linededup import op6_line_dedup, op6_oracle_sql
from linepulse.llm.lmscore import op1_lm_score
from linepulse.llm.mixing import op12_mixing, op12_oracle_sql
from linepulse.llm.packing import op7_packing
from linepulse.llm.pii import op9_pii
from linepulse.llm.quality import op10_quality
from linepulse.llm.sharding import op4_sharding
from linepulse.llm.simhash import op5_simhash
from linepulse.llm.spelling import op11_spelling
from linepulse.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_toxicity": op2_toxicity,
    "op3_langid": op3_langid,
    "op4_sharding": op4_sharding,
    "op5_simhash": op5_simhash,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_decontaminate": op8_decontaminate,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op11_spelling": op11_spelling,
    "op12_mixing": op12_mixing,
    "op13_align": op13_align,
}

ORACLE_SQL = {
    "op6_line_dedup": op6_oracle_sql(),
    "op8_decontaminate": op8_oracle_sql(),
    "op12_mixing": op12_oracle_sql(),
}

"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from ledgerloom.llm.bpe import op4_bpe
from ledgerloom.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from ledgerloom.llm.fm_index import OP8_SQL, op8_decontamination
from ledgerloom.llm.importance import OP13_SQL, op13_importance
from ledgerloom.llm.license_scan import op5_license_scan
from ledgerloom.llm.line_dedup import op6_line_dedup
from ledgerloom.llm.minhash import op3_minhash
from ledgerloom.llm.mixing import op12_mixing
from ledgerloom.llm.substring_dedup import op7_substring_dedup
from ledgerloom.llm.sweep import OP11_SQL, op11_peak_concurrency
from ledgerloom.llm.toxicity import op10_toxicity
from ledgerloom.llm.url_filter import OP1_SQL, op1_url_filters
from ledgerloom.llm.warc import OP2_SQL, op2_warc_revisits

QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_minhash": op3_minhash,
    "op4_bpe": op4_bpe,
    "op5_license_scan": op5_license_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_peak_concurrency": op11_peak_concurrency,
    "op12_mixing": op12_mixing,
    "op13_importance": op13_importance,
}
ORACLE_SQL = {
    "op1_url_filters": OP1_SQL,
    "op2_warc_revisits": OP2_SQL,
    "op8_decontamination": OP8_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_peak_concurrency": OP11_SQL,
    "op13_importance": OP13_SQL,
}

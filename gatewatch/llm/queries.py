"""The registered queries of this subpackage and their DuckDB SQL, where SQL
can express them."""

from __future__ import annotations

from .chat import OP9_SQL, op9_chat_formatting
from .decontaminate import OP3_SQL, op3_benchmark_decontamination
from .html import op7_html_extraction
from .lattice import op4_embedding_near_dedup
from .licenses import op2_license_scan, op2_sql
from .packing import op1_best_fit_packing
from .pii import op5_pii
from .ranking import OP13_SQL, op13_ranked_search
from .repeats import op6_suffix_array_dedup
from .runs import OP11_SQL, op11_periodic_runs
from .secret_scan import op12_secret_scan
from .simhash import op8_simhash_near_dedup
from .toxicity import op10_toxicity

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_license_scan": op2_license_scan,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_pii": op5_pii,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_secret_scan": op12_secret_scan,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": op2_sql(),
    "op3_benchmark_decontamination": OP3_SQL,
    "op9_chat_formatting": OP9_SQL,
    "op11_periodic_runs": OP11_SQL,
    "op13_ranked_search": OP13_SQL,
}

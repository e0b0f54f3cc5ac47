"""The contract queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from wardloom.llm.best_fit_packing import best_fit_packing
from wardloom.llm.chat_windows import chat_windows
from wardloom.llm.filter_audit import ORACLE as AUDIT_SQL
from wardloom.llm.filter_audit import filter_audit
from wardloom.llm.hilbert_search import hilbert_search
from wardloom.llm.language_id import language_id
from wardloom.llm.license_scan import license_scan
from wardloom.llm.line_dedup import line_dedup
from wardloom.llm.ngram_join import ngram_jaccard_join
from wardloom.llm.quality_rules import quality_rules
from wardloom.llm.source_divergence import ORACLE as DIVERGENCE_SQL
from wardloom.llm.source_divergence import source_divergence
from wardloom.llm.source_mix import source_mix
from wardloom.llm.toxicity import toxicity
from wardloom.llm.warc_bundles import ORACLE as WARC_SQL
from wardloom.llm.warc_bundles import warc_bundles

QUERIES = {
    "op1_quality_rules": quality_rules,
    "op2_source_mix": source_mix,
    "op3_hilbert_search": hilbert_search,
    "op4_language_id": language_id,
    "op5_license_scan": license_scan,
    "op6_ngram_jaccard_join": ngram_jaccard_join,
    "op7_toxicity": toxicity,
    "op8_warc_bundles": warc_bundles,
    "op9_best_fit_packing": best_fit_packing,
    "op10_line_dedup": line_dedup,
    "op11_source_divergence": source_divergence,
    "op12_filter_audit": filter_audit,
    "op13_chat_windows": chat_windows,
}

ORACLE: dict[str, str] = {
    "op8_warc_bundles": WARC_SQL,
    "op11_source_divergence": DIVERGENCE_SQL,
    "op12_filter_audit": AUDIT_SQL,
}

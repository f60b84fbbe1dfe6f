"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat_format, chat_repair, decontaminate, filter_audit, html_extract, license_scan, line_rules, minhash_join, mixing, quality_fm, token_counts, toxicity, warc

QUERIES = {
    "op1_chat_rotation": chat_format.op1_chat_rotation,
    "op2_html_extract": html_extract.op2_html_extract,
    "op3_edit_counts": token_counts.op3_edit_counts,
    "op4_quality_fm": quality_fm.op4_quality_fm,
    "op5_warc_normalise": warc.op5_warc_normalise,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_minhash_join": minhash_join.op7_minhash_join,
    "op8_line_rules": line_rules.op8_line_rules,
    "op9_pareto_mix": mixing.op9_pareto_mix,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_chat_repair": chat_repair.op13_chat_repair,
}
SQL = {
    "op1_chat_rotation": chat_format.OP1_SQL,
    "op5_warc_normalise": warc.OP5_SQL,
    "op8_line_rules": line_rules.OP8_SQL,
    "op9_pareto_mix": mixing.OP9_SQL,
    "op10_decontaminate": decontaminate.OP10_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
}

"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from .decontaminate import op9_decontaminate
from .filter_audit import OP11_SQL, op11_filter_audit
from .language import op4_language
from .license import OP6_SQL, op6_license_scan
from .mixing import op2_mixing
from .multiset import op5_multiset_fingerprints
from .ngram import op8_language_model
from .pii import op1_pii
from .secret_scan import op12_secret_scan
from .simhash import op7_simhash_groups
from .substring import OP10_SQL, op10_substring_dedup
from .toxicity import op3_toxicity
from .whitening import op13_whitening

QUERIES = {f.__name__: f for f in (op1_pii, op2_mixing, op3_toxicity, op4_language, op5_multiset_fingerprints, op6_license_scan,
                                   op7_simhash_groups, op8_language_model, op9_decontaminate, op10_substring_dedup, op11_filter_audit,
                                   op12_secret_scan, op13_whitening)}
ORACLES = {"op6_license_scan": OP6_SQL, "op10_substring_dedup": OP10_SQL, "op11_filter_audit": OP11_SQL}

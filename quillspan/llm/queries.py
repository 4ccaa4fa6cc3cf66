"""The operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from .hpylm import op7_hpylm
from .media import op5_media
from .mixing import op9_mixing
from .ngram_join import op2_ngram_join
from .pieces import op10_sentencepiece
from .quality_rules import op3_quality_rules
from .rule_ensemble import op4_quality_classifier
from .secrets import op6_secret_scans
from .token_output import op1_token_output
from .warc import ORACLE as WARC_SQL
from .warc import op8_warc

QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_ngram_join": op2_ngram_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_media": op5_media,
    "op6_secret_scans": op6_secret_scans,
    "op7_hpylm": op7_hpylm,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_sentencepiece": op10_sentencepiece,
}

ORACLES: dict[str, str] = {
    "op8_warc": WARC_SQL,
}

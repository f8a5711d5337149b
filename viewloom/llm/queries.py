"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import ann, bpe, divergence, jaccard, licenses, lm, media, mixing, negatives, quality, suffix, toxicity, warc

QUERIES = {
    "op1_suffix": suffix.op1_suffix,
    "op2_warc": warc.op2_warc,
    "op3_bpe": bpe.op3_bpe,
    "op4_quality": quality.op4_quality,
    "op5_media": media.op5_media,
    "op6_mix": mixing.op6_mix,
    "op7_jaccard": jaccard.op7_jaccard,
    "op8_licenses": licenses.op8_licenses,
    "op9_neighbours": ann.op9_neighbours,
    "op10_lm": lm.op10_lm,
    "op11_negatives": negatives.op11_negatives,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_divergence": divergence.op13_divergence,
}

ORACLES = {
    "op1_suffix": suffix.OP1_SQL,
    "op2_warc": warc.OP2_SQL,
    "op6_mix": mixing.OP6_SQL,
    "op7_jaccard": jaccard.OP7_SQL,
    "op8_licenses": licenses.OP8_SQL,
    "op11_negatives": negatives.OP11_SQL,
    "op13_divergence": divergence.OP13_SQL,
}

"""The queries of this subpackage, and their SQL where SQL can express them."""

from tellerlake.llm.centroids import op12_centroids
from tellerlake.llm.centroids import oracle as op12_oracle
from tellerlake.llm.decontaminate import op8_decontamination
from tellerlake.llm.language import op5_language_id
from tellerlake.llm.licences import op1_licences
from tellerlake.llm.licences import oracle as op1_oracle
from tellerlake.llm.likelihood import op9_lm_scoring
from tellerlake.llm.lines import op4_line_dedup
from tellerlake.llm.merkle import op13_merkle
from tellerlake.llm.merkle import oracle as op13_oracle
from tellerlake.llm.mixing import op2_mixing
from tellerlake.llm.nearest import op10_nearest
from tellerlake.llm.pages import op11_html
from tellerlake.llm.quality import op6_quality
from tellerlake.llm.simhash import op3_simhash
from tellerlake.llm.toxicity import op7_toxicity

QUERIES = {
    "op1_licences": op1_licences,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_id": op5_language_id,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_nearest": op10_nearest,
    "op11_html": op11_html,
    "op12_centroids": op12_centroids,
    "op13_merkle": op13_merkle,
}

ORACLES = {
    "op1_licences": op1_oracle(),
    "op12_centroids": op12_oracle(),
    "op13_merkle": op13_oracle(),
}

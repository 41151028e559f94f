"""The package's queries by name, with the same as DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from waybill.llm import decontamination, mixing, negatives
from waybill.llm.alignment import op11_alignment
from waybill.llm.decontamination import op13_decontamination
from waybill.llm.language import op10_language
from waybill.llm.lm import op7_lm
from waybill.llm.mixing import op6_mixing
from waybill.llm.negatives import op12_negatives
from waybill.llm.neighbours import op4_neighbours
from waybill.llm.packing import op9_packing
from waybill.llm.quality import op1_quality
from waybill.llm.rules import op3_rules
from waybill.llm.sharding import op2_sharding
from waybill.llm.simhash import op5_simhash
from waybill.llm.substring import op8_substring


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_sharding": op2_sharding,
        "op3_rules": op3_rules,
        "op4_neighbours": op4_neighbours,
        "op5_simhash": op5_simhash,
        "op6_mixing": op6_mixing,
        "op7_lm": op7_lm,
        "op8_substring": op8_substring,
        "op9_packing": op9_packing,
        "op10_language": op10_language,
        "op11_alignment": op11_alignment,
        "op12_negatives": op12_negatives,
        "op13_decontamination": op13_decontamination,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_mixing": mixing.OP6_SQL,
        "op12_negatives": negatives.OP12_SQL,
        "op13_decontamination": decontamination.OP13_SQL,
    }
